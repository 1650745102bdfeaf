"""Queries of this subpackage and their SQL, for the entry module."""

from tracewright.llm import leakage, mixture, neardup, oracles, pairs, rebuild, splits, tokens, toxicity, truncation

_MODULES = (tokens, neardup, rebuild, splits, leakage, mixture, truncation, pairs, toxicity)
QUERIES = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
ORACLES = oracles.ORACLES
