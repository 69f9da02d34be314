"""All queries of this subpackage."""

from fieldledger.llm import exact, jaccard, packing, passages, perplexity, pieces, pii, ranked, repeats, runs, secret_scan, shards, urls  # noqa: F401
from fieldledger.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
