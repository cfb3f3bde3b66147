"""Registered queries on the star-schema tables, each with its SQL counterpart."""

from tidemark.queries.base import ORACLES, QUERIES
from tidemark.queries import (  # noqa: F401  (the modules register their queries)
    alerting,
    cleaning,
    evaluation,
    jobs,
    preparation,
    profiling,
    stability,
    stores,
    training,
)

__all__ = ["ORACLES", "QUERIES"]
