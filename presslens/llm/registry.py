"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from presslens.llm import alignment, bpe, chat, exact_dedup, intervals, lattice, mixing, near_dedup, oracles, pii, quality, secrets, sharding, substring_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": sharding.op1_sharding,
    "op2_bpe": bpe.op2_bpe,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_mixing": mixing.op4_mixing,
    "op5_secrets": secrets.op5_secrets,
    "op6_suffix_dedup": substring_dedup.op6_suffix_dedup,
    "op7_ngram_jaccard": near_dedup.op7_ngram_jaccard,
    "op8_quality": quality.op8_quality,
    "op9_pii": pii.op9_pii,
    "op10_chat": chat.op10_chat,
    "op11_alignment": alignment.op11_alignment,
    "op12_likelihood": lattice.op12_likelihood,
    "op13_intervals": intervals.op13_intervals,
}

ORACLE_SQL: dict[str, str] = oracles.SQL | {"op13_intervals": intervals.SQL}
