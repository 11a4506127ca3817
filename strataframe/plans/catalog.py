"""All registered queries: importing the plan modules fills the registry."""

from strataframe.plans import basics, folds, models, nulls, roster, sampling  # noqa: F401
from strataframe.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
