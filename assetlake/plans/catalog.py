"""Imports every query module so that the registry is complete."""

from assetlake.plans import (  # noqa: F401
    queries_evaluation,
    queries_features,
    queries_learning,
    queries_monitoring,
    queries_rules,
    queries_store,
    queries_streaming,
    queries_tables,
)
from assetlake.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
