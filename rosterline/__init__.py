"""rosterline: keep managed tables in line with a source-of-truth roster, on Spark.

Everything is expressed as DataFrame / Spark SQL work so that Catalyst plans it:
anti-join inserts, join-based updates with an exact changed-row count,
retention deletes, match classification, match profiles, set-difference
reports, rule-driven report extraction, attendance summaries and an ordered,
switchable sync pipeline (batch or per micro-batch).
"""

from rosterline.params import SyncParams, DEFAULT_PARAMS
from rosterline.session import get_spark, checkpoint_dir

__all__ = ["SyncParams", "DEFAULT_PARAMS", "get_spark", "checkpoint_dir"]
