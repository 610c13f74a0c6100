"""Imports every query module so that its ``@query`` registrations run."""

from oreflow.plans import q_timeseries  # noqa: F401
from oreflow.plans import q_timeseries2  # noqa: F401
from oreflow.plans import q_relational  # noqa: F401
from oreflow.plans import q_relational2  # noqa: F401
from oreflow.plans import q_documents  # noqa: F401
from oreflow.plans import q_quality  # noqa: F401
from oreflow.plans import q_warehouse  # noqa: F401
from oreflow.plans import q_graph  # noqa: F401
from oreflow.plans import q_vectors_text  # noqa: F401
from oreflow.plans import q_streaming  # noqa: F401
from oreflow.plans import q_reports  # noqa: F401
from oreflow.plans import q_roundtrip  # noqa: F401
