"""Queries of the operators in this package."""

from __future__ import annotations

from trackspark.llm import q_corpus, q_groups, q_nearest, q_reading

_PARTS = (q_nearest, q_groups, q_corpus, q_reading)
QUERIES = {n: f for m in _PARTS for n, f in m.QUERIES.items()}
ORACLES = {n: s for m in _PARTS for n, s in m.ORACLES.items()}
