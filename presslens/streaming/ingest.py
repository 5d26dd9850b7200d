"""Ingestion as micro-batches: a file stream, an anti-join with what was seen, an append or a merge into days."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.sources.store import DayStore
from presslens.streaming.seen import SeenState


def _run(rows: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None]) -> None:
    rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(batch).start().awaitTermination()


def ingest(spark: SparkSession, source: str, schema: str, target: str, seen: str, checkpoint: str, link: str, order: list[str], transform: Callable[[DataFrame], DataFrame] = lambda d: d, fmt: str = "parquet") -> None:
    """Append the rows whose link is new to ``target``, and their hashes to the state at ``seen``.

    Each batch is a partition by its number in both, so a repeated batch replaces itself. The new rows are found once and kept while
    both are written: hashes do not depend on ``transform``.
    """
    state = SeenState(spark, seen)

    def batch(rows: DataFrame, number: int) -> None:
        fresh = state.unseen(state.hashed(rows, link), link, [F.col(c) for c in order], number).persist(StorageLevel.DISK_ONLY)
        out = transform(fresh.drop("bucket")).withColumn("batch", F.lit(number).cast("long"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)
        state.add(fresh, number)
        fresh.unpersist()

    _run(spark.readStream.schema(schema).format(fmt).load(source), checkpoint, batch)


def day_batch(store: DayStore, state: SeenState, link: str, order: list[str], classify: Callable[[DataFrame], DataFrame], stream: str = "articles") -> Callable[[DataFrame, int], None]:
    """What a batch of articles goes through: links seen before go, the others are classified (``classify`` gives the archive's columns and the
    day) and merged into their days, late ones too; the days that changed are marked to be published in the same commit.

    A batch that is repeated changes nothing: the archive has its number, and the state counts earlier batches only.
    """

    def batch(rows: DataFrame, number: int) -> None:
        fresh = state.unseen(state.hashed(rows, link), link, [F.col(c) for c in order], number).persist(StorageLevel.DISK_ONLY)
        made = classify(fresh.drop("bucket")).persist(StorageLevel.DISK_ONLY)  # its days are looked at before its rows are merged
        store.add(made, [F.col(c) for c in order], stream, number)
        state.add(fresh, number)
        made.unpersist()
        fresh.unpersist()

    return batch


def _files(spark: SparkSession, source: str, schema: str, fmt: str, files_per_batch: int | None) -> DataFrame:
    """A stream of the files at ``source``; without a number all that are new make one batch."""
    found = spark.readStream.schema(schema).format(fmt)
    return (found.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else found).load(source)


def ingest_days(spark: SparkSession, source: str, schema: str, checkpoint: str, batch: Callable[[DataFrame, int], None], fmt: str = "parquet", files_per_batch: int | None = 1000) -> None:
    """Run ``day_batch`` on the files that are new at ``source``."""
    _run(_files(spark, source, schema, fmt, files_per_batch), checkpoint, batch)


def first_of_links(rows: DataFrame, stamp: str, link: str, late: str = "7 days") -> DataFrame:
    """The bounded variant, as a stream: a row goes if its link came within ``late`` of it before. The state store holds no link for longer
    than the watermark asks, so it does not grow with the history; a link that comes back later is new."""
    return rows.withWatermark(stamp, late).dropDuplicatesWithinWatermark([link])


def ingest_bounded(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, stamp: str, link: str, late: str = "7 days", fmt: str = "parquet", files_per_batch: int | None = 1) -> None:
    """Append what ``first_of_links`` lets through, in batches of so many files, in the order of the files' times."""
    rows = first_of_links(_files(spark, source, schema, fmt, files_per_batch), stamp, link, late)
    rows.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).format("parquet").option("path", target).start().awaitTermination()
