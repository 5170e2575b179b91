"""Every operator as a query over the given tables, most with an SQL equivalent."""

from kotomori.plans.catalogue import (  # noqa: F401  (each module registers its queries)
    evasion,
    features,
    labels,
    metrics,
    models,
    sources,
    streams,
    text,
    triage,
)
from kotomori.plans.catalogue.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
