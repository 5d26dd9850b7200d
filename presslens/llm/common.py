"""Helpers shared by the corpus operators: shared storage, Arrow columns, prefix sums."""

from __future__ import annotations

import contextlib
import ctypes
import functools
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
#: Those six characters. ``bytes.split()`` without arguments splits on the same set.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and every executor see.

    ``spark.checkpoint.dir`` of the session if set. Where it is unset, a plain local session (tests) gets one temporary folder;
    any other session raises.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors see")
        path = "file://" + _local_dir()
    return path.rstrip("/")


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="presslens-")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage: a lost executor costs nothing that was written, and whatever was not deterministic (task
    numbers, say) is fixed by the committed files.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/presslens/{uuid.uuid4().hex}/{tag}"
    df.write.parquet(path)
    made = spark.read.schema(df.schema).parquet(path)
    made.stored_at = path
    return made


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``materialise`` that nothing will read again.

    Plans that the driver no longer holds are collected too, so that Spark's cleaner removes their shuffle files.
    """
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        gc.collect()
        trim()
        spark._jvm.System.gc()


#: Copies of one row that one row expands into.
COPY_CHUNK = 65536


def spread_copies(rows: DataFrame, copies: str, number: str) -> DataFrame:
    """Each row as often as ``copies`` says, with ``number`` from 0; a row with many is dealt out to other tasks in parts first."""
    of, chunk = F.col(copies), F.col("_chunk")
    few = rows.filter(of <= COPY_CHUNK).withColumn("_chunk", F.lit(0).cast("long"))
    many = rows.filter(of > COPY_CHUNK).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((of - 1) / COPY_CHUNK))))
    parts = few.unionByName(many.repartition(F.xxhash64(*[c for c, t in many.dtypes if "map<" not in t])))
    inside = F.explode(F.sequence(F.lit(0).cast("long"), F.least(F.lit(COPY_CHUNK).cast("long"), of - chunk * COPY_CHUNK) - 1))
    return parts.withColumn("_in_chunk", inside).withColumn(number, chunk * COPY_CHUNK + F.col("_in_chunk")).drop("_chunk", "_in_chunk")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.get(F.transform(F.array(value), body), 0)


def trim() -> None:
    """Give free memory back to the system: a Python worker lives on from stage to stage, and what it does not return counts all along."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def lean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; the memory of one that is done goes back to the system before the next."""
    for batch in batches:
        yield batch
        del batch
        trim()


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int):
    """Whatever runs inside hands Python at most so many rows at once: long texts by the 10,000 are tens of MB in the JVM and in the worker, for each task."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    most = int(before)
    spark.conf.set(key, str(min(rows, most) if most > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def thrifty(run):
    """A function of batches that leaves no free memory behind when its task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return wrapped


def text_bytes(batch: pa.RecordBatch, name: str = "text") -> Iterator[bytes]:
    """The UTF-8 bytes of each text, null as empty."""
    return bytes_of(batch.column(batch.schema.get_field_index(name)))


def bytes_of(column: pa.Array) -> Iterator[bytes]:
    if pa.types.is_string(column.type):
        column = column.cast(pa.binary())
    elif pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    for value in column:
        yield value.as_py() or b""


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) if not isinstance(c, pa.Array) else c.cast(f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def row_count(df: DataFrame) -> int:
    return df.count()
