"""The queries of this subpackage and their SQL equivalents."""

from kotomori.llm import (  # noqa: F401  (each module registers its queries)
    bestfit,
    chat,
    codes,
    fingerprints,
    middle,
    mixing,
    packing,
    quality,
    secrets,
    simhash,
    token_counts,
    topk,
    toxicity,
)
from kotomori.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
