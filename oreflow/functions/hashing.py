"""Row and key hashes (staging row hash, vault hash keys, hash_diff)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every part of a hashed tuple carries its length, so ('a|b', 'c') and
# ('a', 'b|c') differ; a NULL part is a mark without a length, so that
# ('a', NULL) and (NULL, 'a') differ too (gotcha G4) and no text equals it.
NULL_MARK = "~"
SEP = "|"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_input(*cols, business: bool = False) -> Column:
    """The parts, each with its length; ``business`` keys are trimmed and upper-cased."""
    parts = []
    for c in cols:
        s = _c(c).cast("string")
        if business:
            s = F.upper(F.trim(s))
        parts.append(F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit(NULL_MARK)))
    return F.concat_ws(SEP, *parts)


def row_hash(*cols) -> Column:
    """MD5 of the string forms with their lengths (CHAR(32) hex)."""
    return F.md5(hash_input(*cols))


def hash_key(*business_keys) -> Column:
    """Data-vault hash key: MD5 over trimmed, upper-cased business keys."""
    return F.md5(hash_input(*business_keys, business=True))


def surrogate_key(*cols) -> Column:
    """Stable 64-bit surrogate key from business key columns (WH-03).

    Deterministic across reruns and partitionings, unlike
    ``monotonically_increasing_id``.
    """
    return F.xxhash64(*[_c(c) for c in cols])
