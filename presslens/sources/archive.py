"""The day-partitioned archive and its exports."""

from __future__ import annotations

import sqlite3

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.dates import partition_key, stored_timestamp
from presslens.operators.merge import changed_days, dedup_first, merge
from presslens.sources.files import delete, exists

#: The archive's columns, in order. Texts but for the time of the article and the numbers.
COLUMNS = (
    "nom_du_media", "titre", "lien", "time_stamp", "country_headquarters", "country_article", "region",
    "sujet_article", "sujet_media", "official_rating", "indice_fiabilite", "notation",
    "fiabilité_calcul", "indice_interet_naval", "region_maritime", "fiabilité2",
    "intérêt marine calcul", "intérêt_par_fiabilité", "confiance_pays_article", "langue", "titre_vo",
)
NUMBERS = ("official_rating", "indice_fiabilite", "fiabilité_calcul", "indice_interet_naval", "fiabilité2", "intérêt marine calcul", "intérêt_par_fiabilité")
ARCHIVE = ", ".join(f"`{c}` {'timestamp_ntz' if c == 'time_stamp' else 'double' if c in NUMBERS else 'string'}" for c in COLUMNS)
#: The columns that a database export indexes.
INDEXED = ("time_stamp", "country_article", "sujet_article", "nom_du_media", "region")
FILE_ROWS = 1_000_000


def to_stored(rows: DataFrame) -> DataFrame:
    """Text columns as the archive stores them: times and numbers parsed, columns that are missing empty.

    What cannot be read, dates that do not exist included, is null.
    """
    made: list[Column] = []
    for name in COLUMNS:
        raw = F.col(f"`{name}`").cast("string") if name in rows.columns else F.lit(None).cast("string")
        if name == "time_stamp":
            value = stored_timestamp(F.trim(raw)).cast("timestamp_ntz")
        elif name in NUMBERS:
            value = F.nullif(F.trim(raw), F.lit("")).try_cast("double")
        else:
            made.append(raw.alias(name))
            continue
        made.append(value.alias(name))
    return rows.select(*made)


def value_type(name: str) -> str:
    return "timestamp_ntz" if name == "time_stamp" else "double" if name in NUMBERS else "string"


def to_text(rows: DataFrame) -> DataFrame:
    """Stored columns as texts: nulls empty, times to the minute, whole numbers without decimals."""

    def plain(name: str) -> Column:
        value = F.col(f"`{name}`")
        if name == "time_stamp":
            value = F.date_format(value, "yyyy-MM-dd HH:mm")
        elif name in NUMBERS:
            value = F.when((value == F.floor(value)) & (F.abs(value) < 1e15), value.cast("long").cast("string")).otherwise(value.cast("string"))
        return F.coalesce(value, F.lit("")).alias(name)

    return rows.select(*[plain(c) for c in COLUMNS])


def write_days(rows: DataFrame, path: str, day: str, order: list | None = None) -> None:
    """Replace the days that ``rows`` has; other days stay. Inside a file rows are sorted, by default newest first.

    Rows are dealt by range of day and order, so a large day is several files in order and no day is one task's.
    """
    order = [F.desc("time_stamp"), F.desc("lien")] if order is None else order
    (
        rows.repartitionByRange(F.col(day), *order)
        .sortWithinPartitions(day, *order)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("maxRecordsPerFile", FILE_ROWS)
        .partitionBy(day)
        .parquet(path)
    )


def update_days(rows: DataFrame, path: str, day: str, order: list | None = None) -> DataFrame:
    """Make the archive at ``path`` hold ``rows``: only days whose rows differ are written, days without rows any more are deleted.

    Returns those days, with ``emptied``; they are what a manifest lists as to be published. ``rows`` must not read from ``path``.
    """
    spark = rows.sparkSession
    if not exists(spark, path):
        write_days(rows, path, day, order)
        return rows.select(day).distinct().withColumn("emptied", F.lit(False))
    before = spark.read.schema(rows.schema).parquet(path)
    found = changed_days(before, rows, day).collect()  # a few fields for each day that changed
    changed = [r[day] for r in found if not r["emptied"]]
    if changed:
        write_days(rows.filter(F.col(day).isin(changed)), path, day, order)
    for r in found:
        if r["emptied"]:
            delete(spark, f"{path}/{day}={r[day]}")
    return spark.createDataFrame([(r[day], r["emptied"]) for r in found], rows.select(day).schema.add("emptied", "boolean"))


def merge_days(new: DataFrame, path: str, day: str = "day", link: str = "lien", order: list | None = None) -> None:
    """Add rows to their days, whatever their age: a link that one of these days has, or an earlier new row has, is not added again.

    ``order`` (upwards, plain columns) decides between rows of one link, those already stored before new ones.
    """
    spark = new.sparkSession
    order = order or [F.col("time_stamp"), F.col("titre")]
    days = [r[0] for r in new.select(day).distinct().collect()]  # a few fields
    held = new.filter("false")
    if exists(spark, path):
        held = spark.read.schema(new.schema).parquet(path).filter(F.col(day).isin([d for d in days if d is not None]) | (F.col(day).isNull() & F.lit(None in days)))
    write_days(merge(held, new, link, order), path, day, [F.desc_nulls_last(link)] if "time_stamp" not in new.columns else None)


def read_days(spark: SparkSession, path: str, schema: str = ARCHIVE, start: str | None = None, end: str | None = None, day: str = "day") -> DataFrame:
    """The archive, pruned to the days asked for; missing texts read as empty."""
    rows = spark.read.schema(f"{schema}, {day} date").parquet(path)
    if start:
        rows = rows.filter(F.col(day) >= F.lit(start).cast("date"))
    if end:
        rows = rows.filter(F.col(day) <= F.lit(end).cast("date"))
    return filled(rows)


def filled(rows: DataFrame) -> DataFrame:
    """Missing texts as empty ones."""
    return rows.select(*[F.coalesce(f"`{f.name}`", F.lit("")).alias(f.name) if f.dataType.typeName() == "string" else F.col(f"`{f.name}`") for f in rows.schema.fields])


def stored_bytes(spark: SparkSession, path: str, day: str = "day") -> DataFrame:
    """Bytes of the Parquet files of each day under ``path``; the files are listed, not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    return found.groupBy(F.regexp_extract("path", rf"/{day}=([^/]+)/", 1).alias(day)).agg(F.sum("length").alias("bytes"))


def migrate(rows: DataFrame, path: str, order: list, link: str = "lien", stamp: str = "time_stamp") -> DataFrame:
    """Split one table of texts into days, the first row of each link (an empty one counts too) kept; rows read back are counted.

    Returns year, days, articles per year (``undated`` for rows without a date). Raises if a row went missing.
    """
    kept = dedup_first(rows, link, order).withColumn("day", F.coalesce(partition_key(F.col(stamp)), F.lit("undated")))
    write_days(kept, path, "day", [F.desc(stamp), F.desc(link)])
    there = rows.sparkSession.read.schema(kept.schema).parquet(path)
    expected, found = kept.count(), there.count()
    if expected != found:
        raise RuntimeError(f"{found} rows read back, {expected} expected")
    return migration_summary(there)


def migration_summary(days: DataFrame, day: str = "day") -> DataFrame:
    year = F.when(F.col(day).cast("string").rlike(r"^\d{4}-"), F.substring(F.col(day).cast("string"), 1, 4)).otherwise("undated")
    return days.groupBy(year.alias("year")).agg(F.count_distinct(day).alias("days"), F.count(F.lit(1)).alias("articles"))


def export_csv(rows: DataFrame, path: str) -> None:
    """One file; only its writing is one task's, not what ``rows`` are made from."""
    rows.repartition(1).write.mode("overwrite").csv(path, sep=";", header=True, nullValue="", emptyValue="", escape='"')


def export_parquet(rows: DataFrame, path: str) -> None:
    """One file, cast to the archive's columns where ``rows`` has them."""
    kinds = {c: value_type(c) for c in COLUMNS}
    rows.select(*[F.col(f"`{c}`").cast(kinds.get(c, t)).alias(c) for c, t in rows.dtypes]).repartition(1).write.mode("overwrite").option("compression", "zstd").parquet(path)


def export_selection(rows: DataFrame, selection, path: str, kind: str = "csv") -> None:
    """What a selection (``explore.Selection``) leaves, as CSV or as the archive's Parquet."""
    chosen = selection.apply(rows)
    if kind == "csv":
        export_csv(chosen, path)
    elif kind == "parquet":
        export_parquet(chosen, path)
    else:
        raise ValueError(f"csv or parquet, not {kind}")


def export_sqlite(rows: DataFrame, path: str, table: str = "articles", indexes: tuple[str, ...] = (), batch: int = 20_000) -> int:
    """Numbers as REAL, all else as TEXT; rows stream through the driver one partition at a time."""
    kinds = {f.name: "REAL" if f.dataType.typeName() in ("double", "float", "long", "integer") else "TEXT" for f in rows.schema.fields}
    plain = rows.select(*[F.col(f"`{n}`").cast("double" if k == "REAL" else "string").alias(n) for n, k in kinds.items()])
    total = 0
    with sqlite3.connect(path) as db:
        db.execute(f"DROP TABLE IF EXISTS {table}")
        db.execute(f"CREATE TABLE {table} ({', '.join(f'{chr(34)}{n}{chr(34)} {k}' for n, k in kinds.items())})")
        held = []
        for row in plain.toLocalIterator():
            held.append(tuple(row))
            if len(held) >= batch:
                db.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(kinds))})", held)
                total, held = total + len(held), []
        db.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(kinds))})", held)
        for name in indexes:
            db.execute(f'CREATE INDEX "ix_{name}" ON {table} ("{name}")')
    return total + len(held)
