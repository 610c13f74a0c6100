"""oreflow — industrial and telemetry analytics as plain Spark jobs.

Every public function takes DataFrames (and parameters) and returns a
DataFrame.  Nothing here executes an action unless its name says so
(``write_*``, ``run_*``), so the same transformations run on batch and on
streaming DataFrames.
"""

__version__ = "0.1.0"
