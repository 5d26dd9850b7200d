"""From raw documents to token ids: quality rules, exact dedup, near dedup, mixing, BPE."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presslens.llm.bpe import encode_documents
from presslens.llm.common import discard, materialise
from presslens.llm.exact_dedup import dedup_documents
from presslens.llm.mixing import mix_documents
from presslens.llm.near_dedup import dedup_near
from presslens.llm.quality import filter_documents


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops what the rules reject: texts without words (null ones too), repetitive ones, outliers of their source. Repeated rows are judged alike."""
    return filter_documents(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each normalised text stays, decided by row; null is the empty text."""
    return dedup_documents(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of similar texts stays, the least doc_id, null last; texts without words have no component."""
    return dedup_near(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document drawn twice by the mix is two rows."""
    return mix_documents(docs)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' columns but the text, and their ids."""
    return encode_documents(docs)


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage), ("mixing", mixing_stage), ("encoding", encoding_stage)]

#: Regular expressions over code points, hashing and merges are outside DuckDB's SQL; a test holds the pipeline against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn; each table goes once the stage after it is written, but the last, which the result reads."""
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
        if last is not None:
            discard(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
