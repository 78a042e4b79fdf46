"""Every operator as a query on the given tables, with its SQL counterpart."""

from meterfold.plans import (  # noqa: F401  (importing registers the queries)
    aggregations,
    clustering,
    functions,
    inputs,
    joins,
    ordering,
    projections,
    streams,
    windows,
)
from meterfold.plans.registry import oracles, runnables

__all__ = ["oracles", "runnables"]
