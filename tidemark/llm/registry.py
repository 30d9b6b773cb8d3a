"""The queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    ball_tree,
    chat,
    debruijn,
    decontamination,
    hard_negatives,
    packing,
    quality,
    quality_rules,
    simhash,
    suffix_dedup,
    token_store,
    toxicity,
    whitening,
)

ROOT = str(Path(__file__).resolve().parents[2])


def importable(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """A query whose Python workers find this package, wherever the session was started."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        environment = spark.sparkContext.environment
        known = [x for x in environment.get("PYTHONPATH", "").split(os.pathsep) if x]
        if ROOT not in known:
            environment["PYTHONPATH"] = os.pathsep.join([*known, ROOT])
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: importable(f)
    for f in (
        packing.op1_packing,
        debruijn.op2_debruijn_dedup,
        simhash.op3_simhash,
        suffix_dedup.op4_suffix_dedup,
        ball_tree.op5_top_k,
        chat.op6_chat_format,
        decontamination.op7_decontamination,
        token_store.op8_token_orc,
        quality.op9_quality,
        toxicity.op10_toxicity,
        whitening.op11_whitening,
        quality_rules.op12_quality_rules,
        hard_negatives.op13_hard_negatives,
    )
}


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = importable(pipeline)

ORACLE_SQL: dict[str, str] = {
    "op5_top_k": ball_tree.OP5_SQL,
    "op6_chat_format": chat.OP6_SQL,
    "op7_decontamination": decontamination.OP7_SQL,
    "op12_quality_rules": quality_rules.OP12_SQL,
    "op13_hard_negatives": hard_negatives.OP13_SQL,
}
