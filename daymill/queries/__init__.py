"""Every operator as a query on the given tables, each beside its SQL oracle."""

from daymill.queries import aggregates, daily_tables, filters, layouts, modelling, projections, sources, trims, upkeep
from daymill.queries.registry import REGISTRY

__all__ = [
    "REGISTRY",
    "aggregates",
    "daily_tables",
    "filters",
    "layouts",
    "modelling",
    "projections",
    "sources",
    "trims",
    "upkeep",
]
