"""Names of all core queries and their SQL."""

from __future__ import annotations

from corpusgraph.plans import corpus_queries, graph_queries

_ALL = corpus_queries.PAIRS | graph_queries.PAIRS
QUERIES = {name: fn for name, (fn, _) in _ALL.items()}
ORACLES = {name: sql for name, (_, sql) in _ALL.items() if sql}
