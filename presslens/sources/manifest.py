"""Which stored files are to be published, which are out of date, and the listing of a remote store."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.operators.merge import key_union
from presslens.sources.files import load_or_empty

MANIFEST = "release string, file string"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    return load_or_empty(spark, path, MANIFEST)


def mark(pending: DataFrame, files: DataFrame) -> DataFrame:
    """The files to be published, those in ``files`` added; each once."""
    return key_union(pending.select("release", "file"), files.select("release", "file"))


def of_days(days: DataFrame, day: str = "day") -> DataFrame:
    """Release and file of days; rows without a date have a file of their own."""
    dated = F.col(day).cast("string").rlike(r"^\d{4}-\d{2}-\d{2}$")
    text = F.col(day).cast("string")
    return days.select(F.when(dated, F.concat(F.lit("data-"), F.substring(text, 1, 4))).otherwise("data-undated").alias("release"), F.when(dated, F.concat(text, F.lit(".parquet"))).otherwise("undated.parquet").alias("file"))


def split(pending: DataFrame, keep: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """What is published now, by the condition ``keep`` (all if None), and what stays pending."""
    if keep is None:
        return pending, pending.filter("false")
    chosen = F.coalesce(keep, F.lit(False))
    return pending.filter(chosen), pending.filter(~chosen)


def file_day(file: Column) -> Column:
    """The day that a file holds; null for the file of undated rows."""
    return F.try_to_date(F.nullif(F.regexp_extract(file, r"^(\d{4}-\d{2}-\d{2})\.parquet$", 1), F.lit("")), "yyyy-MM-dd")


def inventory(assets: DataFrame, year: int | None = None) -> DataFrame:
    """Of a remote listing (release, file, size, digest, state) the data files of a year, or of all; unfinished uploads are left out."""
    data = assets.filter(F.col("file").endswith(".parquet") & F.col("release").startswith("data-") & (F.coalesce("state", F.lit("uploaded")) == "uploaded"))
    return data.filter(F.col("release") == f"data-{year}") if year is not None else data


def local_files(spark: SparkSession, path: str) -> DataFrame:
    """file, size and SHA-256 of the Parquet files under ``path``; their bytes are read by the executors."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("length").alias("size"), F.sha2("content", 256).alias("digest"))


def stale(assets: DataFrame, local: DataFrame) -> DataFrame:
    """Remote files that are missing here, differ in size, or in SHA-256 where the listing has one."""
    here = local.select(F.col("file").alias("_file"), F.col("size").alias("_size"), F.col("digest").alias("_digest"))
    known = F.when(F.col("digest").startswith("sha256:"), F.substring("digest", 8, 64))
    fresh = F.col("_size").eqNullSafe(F.col("size")) & F.coalesce(known == F.col("_digest"), F.lit(True))
    return assets.join(here, F.col("file") == F.col("_file"), "left").filter(~fresh).select(*assets.columns)


def pages(first: str, get: Callable[[str], tuple[list, str | None]]) -> Iterator:
    """The items of a paged listing: ``get`` gives a page's items and its Link header, whose ``rel="next"`` is the page after it."""
    url: str | None = first
    while url:
        items, link = get(url)
        yield from items
        parts = [p.split(";") for p in (link or "").split(",")]
        url = next((p[0].strip().strip("<>") for p in parts if any(x.strip() == 'rel="next"' for x in p[1:])), None)
