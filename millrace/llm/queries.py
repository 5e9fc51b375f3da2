"""All queries of this package and their SQL."""

from __future__ import annotations

from millrace.llm import queries_chat, queries_corpus, queries_text, queries_tokens, queries_training  # noqa: F401  (importing registers them)
from millrace.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
