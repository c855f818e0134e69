"""Queries over the driver's tables: one per operator, each with its SQL twin where SQL can say it."""

from millstream.plans import (  # noqa: F401
    aggregates,
    alerts,
    cleaning,
    cycles,
    ingest,
    joins,
    observability,
    quality,
    sets,
    spc,
    streams,
    windows,
)
from millstream.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
