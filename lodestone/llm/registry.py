"""The subpackage's named queries and their SQL."""

from __future__ import annotations

from lodestone.llm import queries as _q


def queries():
    import corpus_pipeline

    return dict(_q.QUERIES) | {"pipeline": corpus_pipeline.run}


def oracle_sql():
    import corpus_pipeline

    own = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return dict(_q.SQL) | own
