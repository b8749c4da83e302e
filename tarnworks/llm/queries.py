"""The queries of this subpackage and the SQL that DuckDB can run for them."""

from __future__ import annotations

import corpus_pipeline
from tarnworks.llm import alignment, chat, cotraining, embedding_dedup, exact_dedup, lm_scoring, mixing, near_dedup, pieces, pii, quality_rules, source_divergence, token_counts

MODULES = [exact_dedup, lm_scoring, pii, cotraining, chat, mixing, token_counts, quality_rules, pieces, near_dedup, embedding_dedup, source_divergence, alignment]


def queries() -> dict:
    return {**{m.QUERY: m.query for m in MODULES}, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    sql = {m.QUERY: m.ORACLE for m in MODULES if getattr(m, "ORACLE", None)}
    return sql | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
