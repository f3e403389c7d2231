"""The registered query of each operator, with the SQL that checks it where SQL can."""

from __future__ import annotations

from lumbre.llm import query_bpe, query_conversations, query_decontaminate, query_html, query_imatch, query_interactions, query_jaccard, query_pii, query_quality, query_records, query_repeats, query_secrets, query_shards

_MODULES = (query_quality, query_repeats, query_imatch, query_records, query_secrets, query_shards, query_decontaminate, query_jaccard, query_bpe, query_html, query_pii, query_conversations, query_interactions)
QUERIES = {name: fn for module in _MODULES for name, fn in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
