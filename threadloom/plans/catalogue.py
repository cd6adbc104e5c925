"""All named queries over the driver tables, each with its DuckDB twin where SQL can express it."""

from threadloom.plans import checks, models, profiles, reads, texts, topics
from threadloom.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "checks", "models", "profiles", "reads", "texts", "topics"]
