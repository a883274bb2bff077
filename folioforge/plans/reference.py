"""All queries of the document operators in one place."""

from __future__ import annotations

from folioforge.plans import block_queries, page_queries, scalar_queries, table_queries, window_queries

_PARTS = [scalar_queries, table_queries, window_queries, page_queries, block_queries]
QUERIES = {k: q for m in _PARTS for k, q in m.R.queries.items()}
ORACLE = {k: q for m in _PARTS for k, q in m.R.oracle.items()}
