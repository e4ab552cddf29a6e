"""All registered queries."""

from hourweave.plans import queries_features, queries_io, queries_models, queries_panel  # noqa: F401  (register on import)
from hourweave.plans.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
