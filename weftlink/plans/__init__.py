"""Queries over the library's operators, and the SQL they are held against.

The tables hold no business records, so each operator runs on an analogue: documents
stand for records (language for country, doc_id divisible by 3 for the clean source,
words for tokens, equal texts for the truth), order lines for scored pairs."""

from __future__ import annotations

from . import audits, linkage, pairs, rerank, texts

PARTS = (linkage, pairs, rerank, audits, texts)


def queries() -> dict:
    return {k: v for m in PARTS for k, v in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v for m in PARTS for k, v in m.SQL.items()}
