"""strataframe — describe, stratify, resample and regress columns of large tables on Spark.

Every public function takes DataFrames (plus column names) and returns DataFrames, so it
chains with ``df.transform``.  Data-sized work is always a Spark plan (aggregates, joins,
windows); Python only ever sees one row of moments per group.
"""

from strataframe.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
