"""What the site shows: short records, one JSON folder per day, and figures about them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions.dates import site_window
from presslens.functions.scores import site_number

#: Key of the record, column of the archive.
KEYS = {
    "m": "nom_du_media", "t": "titre", "l": "lien", "d": "time_stamp", "ch": "country_headquarters", "ca": "country_article", "rg": "region",
    "sa": "sujet_article", "sm": "sujet_media", "or": "official_rating", "fi": "indice_fiabilite", "nv": "indice_interet_naval",
    "ip": "intérêt_par_fiabilité", "cf": "confiance_pays_article", "rm": "region_maritime", "lg": "langue", "tv": "titre_vo", "no": "notation",
}
_NUMBERS = ("or", "fi", "nv", "ip")
_DEFAULTS = {"lg": "en", "no": "F"}


def records(rows: DataFrame) -> DataFrame:
    """The archive's rows (as texts or as stored) under the site's 18 keys."""

    def made(key: str, name: str) -> Column:
        value = F.col(f"`{name}`")
        if key == "d":
            value = F.date_format(value, "yyyy-MM-dd HH:mm") if dict(rows.dtypes)[name].startswith("timestamp") else F.left(value, F.lit(16))
            return F.coalesce(value, F.lit("")).alias(key)
        if key in _NUMBERS:
            return (F.coalesce(site_number(value), F.lit(0.0)) if key == "nv" else site_number(value)).alias(key)
        return F.coalesce(F.nullif(value, F.lit("")), F.lit(_DEFAULTS.get(key, ""))).alias(key)

    return rows.select(*[made(k, n) for k, n in KEYS.items()])


def newest_first(shown: DataFrame) -> DataFrame:
    return shown.orderBy(F.desc_nulls_last("d"), "l")


def window(shown: DataFrame, reference: str, days: int = 7) -> DataFrame:
    """The records of the site's days, with ``day``."""
    day = F.try_to_date(F.left("d", F.lit(10)), "yyyy-MM-dd")
    return shown.withColumn("day", day).filter(site_window(F.col("day"), F.lit(reference).cast("date"), days))


def write_site(rows: DataFrame, path: str, reference: str, days: int = 7) -> None:
    """One folder of JSON per day, newest first; the folder is replaced whole, so days that left the window go."""
    shown = window(records(rows), reference, days)
    order = [F.desc("d"), F.col("l")]
    shown.repartitionByRange(F.col("day"), *order).sortWithinPartitions("day", *order).write.mode("overwrite").option("ignoreNullFields", "false").partitionBy("day").json(path)


def metadata(shown: DataFrame, added: int = 0, days: int = 7, generated: str | None = None, repo: str | None = None) -> DataFrame:
    """One row: count, added (never below 0), jours_site and the days with their file and count, newest first; when and where from, if given."""
    per = shown.groupBy("day").agg(F.count(F.lit(1)).alias("count"))
    listed = F.sort_array(F.collect_list(F.struct(F.col("day").cast("string").alias("jour"), F.concat(F.lit("data/"), F.col("day").cast("string"), F.lit(".json")).alias("fichier"), "count")), False)
    made = per.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("count"), listed.alias("jours")).select("count", F.lit(max(added, 0)).alias("added"), F.lit(days).alias("jours_site"), "jours")
    for name, value in (("generated", generated), ("repo", repo)):
        made = made.withColumn(name, F.lit(value)) if value is not None else made
    return made


def write_metadata(made: DataFrame, path: str) -> None:
    made.repartition(1).write.mode("overwrite").json(path)
