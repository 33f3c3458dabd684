"""Query families. Importing this package registers every query key."""

from rosterline.plans import (accounts, attendance, audits, credentials, groups, jobs,  # noqa: F401
                              links, logs, reports, sync)
from rosterline.plans.registry import REGISTRY, oracle_sql, queries

__all__ = ["REGISTRY", "queries", "oracle_sql"]
