"""Command line: ``python -m presslens.cli COMMAND ...``; paths may be in any store that Spark reads."""

from __future__ import annotations

import argparse
import datetime
import importlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions import dates
from presslens.operators import classify, media, merge, rescan, translation
from presslens.operators.explore import Selection
from presslens.operators.matching import dictionary, parse_rule
from presslens.operators.translation import translate_rows, translator
from presslens.sources import archive, dictionaries, feeds, files, manifest, site
from presslens.sources.store import NO_DAY, DayStore


def _no_model():
    return lambda titles, code: [None] * len(titles)


def _model(name: str | None):
    """``module:function`` that returns a model; without a name titles stay as they are."""
    if not name:
        return translator(_no_model)
    module, _, function = name.partition(":")
    return translator(getattr(importlib.import_module(module), function))


class Setup:
    """The dictionary files of a folder, under fixed names."""

    def __init__(self, spark: SparkSession, folder: str):
        text = lambda name: dictionaries.whole_text(spark, f"{folder}/{name}")
        rules = tuple(r for r in map(parse_rule, text("rules.txt").splitlines()) if r)
        self.words = classify.Dictionaries(
            dictionary(dictionaries.classes(text("themes.txt"))), dictionary(dictionaries.classes(text("countries.txt"))),
            dictionary(dictionaries.scale(text("naval.txt"))), dictionary(dictionaries.zones(text("zones.txt"))), rules, dictionaries.json_map(text("regions.json")),
        )
        self.cards = dictionaries.cards(spark, text("media.csv"))
        self.bans = media.patterns(spark, dictionaries.bans(text("bans.txt")))
        self.aliases = media.patterns(spark, dictionaries.aliases(text("aliases.csv")))
        self.spoken = dictionaries.declared(spark, dictionaries.languages(text("languages.csv")))


def classified(log: DataFrame, setup: Setup, run=None) -> DataFrame:
    """A raw log (media, titre, lien, date) as archive rows, in texts."""
    kept = media.without_banned(log, setup.bans, "media")
    said = dictionaries.with_declared(kept, setup.spoken, "media").withColumns({"langue": F.lit(""), "titre_vo": F.lit("")})
    made = translate_rows(said, run or translator(_no_model), declared=F.col("declared"))
    named = media.canonical_names(made, setup.aliases, "media").withColumns({"nom_du_media": F.col("canonical"), "time_stamp": dates.norm_date(F.col("date"))})
    return classify.classify_rows(named, setup.words, setup.cards).select(*[F.col(f"`{c}`") for c in archive.COLUMNS])


def _texts(stored: DataFrame) -> DataFrame:
    """Stored articles with the times and ratings as texts, as the classifier and the rescan read them."""
    return stored.withColumns({"time_stamp": F.coalesce(F.date_format("time_stamp", "yyyy-MM-dd HH:mm"), F.lit("")), "official_rating": F.coalesce(F.col("official_rating").cast("string"), F.lit(""))})


def _dated(texts: DataFrame) -> DataFrame:
    return archive.to_stored(texts).withColumn("day", F.to_date("time_stamp"))


def collect(spark: SparkSession, a: argparse.Namespace) -> None:
    listed = feeds.feed_catalogue(spark.read.text(a.feeds, wholetext=True), a.max_feeds)
    known = feeds.read_seen(spark, a.seen) if files.exists(spark, a.seen) else spark.createDataFrame([], "hash string")
    # What was fetched is stored first: log and hashes are then made from the same rows, even if an executor is lost between them.
    staged = f"{a.out.rstrip('/')}.staged-{uuid.uuid4().hex}"
    feeds.collect(feeds.fetch_feeds(listed).filter("error IS NULL"), known).write.parquet(staged)
    new = spark.read.parquet(staged)
    feeds.append_log(new, a.out)
    new.select("hash").write.mode("append").text(a.seen)
    files.delete(spark, staged)


def classify_log(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = _dated(classified(feeds.read_log(spark, a.log), Setup(spark, a.dictionaries), _model(a.model)))
    print(len(DayStore(spark, a.archive).add(rows)), "days changed")


def rescan_archive(spark: SparkSession, a: argparse.Namespace) -> None:
    setup = Setup(spark, a.dictionaries)
    found, seen = rescan.observed(rescan.marked(_texts(archive.filled(DayStore(spark, a.archive).read())).drop("day"), setup.words, setup.cards, setup.aliases, setup.bans))
    kept = rescan.settled(found)
    done = _dated(classify.classify_rows(kept, setup.words, setup.cards) if a.everything else kept)
    changed = DayStore(spark, a.out).replace_with(done)
    print(seen.get, len(changed), "days changed")


def retry(spark: SparkSession, a: argparse.Namespace) -> None:
    setup, store = Setup(spark, a.dictionaries), DayStore(spark, a.archive)
    rows = _texts(archive.filled(store.read()))

    def again(tried: DataFrame) -> DataFrame:
        return classify.classify_rows(tried, setup.words, setup.cards)

    done = translation.retry(rows.drop("day"), _model(a.model), again)
    print(len(store.replace_with(_dated(done))), "days changed")


def publish(spark: SparkSession, a: argparse.Namespace) -> None:
    def put(day: str, rows: DataFrame) -> None:
        named = manifest.of_days(spark.createDataFrame([(None if day == NO_DAY else day,)], "day string")).first()
        archive.export_parquet(rows.drop("day"), f"{a.out}/{named['release']}/{named['file']}")

    print(len(DayStore(spark, a.archive).publish(put, a.until)), "days published")


def migrate(spark: SparkSession, a: argparse.Namespace) -> None:
    """One table of texts into days, the first row of each link kept; rows read back are counted."""
    rows = spark.read.csv(a.table, sep=";", header=True, quote='"', escape='"', multiLine=True)
    kept = merge.dedup_first(rows, "lien", [F.col("time_stamp"), F.col("titre")])
    store = DayStore(spark, a.archive)
    store.replace_with(_dated(kept))
    there = store.read()
    archive.migration_summary(there.withColumn("day", F.col("day").cast("string"))).show()
    archive.stored_bytes(spark, f"{a.archive}/data").agg(F.sum("bytes").alias("bytes")).show()


def show_site(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = archive.filled(DayStore(spark, a.archive).read())
    site.write_site(rows, f"{a.out}/data", a.date_ref, a.days)
    shown = site.window(site.records(rows), a.date_ref, a.days)
    stamp = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%d %H:%M UTC")
    site.write_metadata(site.metadata(shown, 0, a.days, stamp, a.repo), f"{a.out}/meta")


def export(spark: SparkSession, a: argparse.Namespace) -> None:
    facets = {column: tuple(values) for column, values in (("country_article", a.country), ("sujet_article", a.theme), ("nom_du_media", a.media)) if values}
    rows = Selection(facets, None, (a.search, ("titre", "nom_du_media"))).apply(archive.filled(DayStore(spark, a.archive).read(a.start, a.end))).drop("day")
    if a.command == "sqlite":
        print(archive.export_sqlite(rows, a.out, indexes=archive.INDEXED), "articles")
    else:
        {"parquet": archive.export_parquet, "csv": archive.export_csv}[a.command](rows, a.out)


def main(args: list[str] | None = None) -> None:
    top = argparse.ArgumentParser(prog="presslens", description=__doc__)
    commands = top.add_subparsers(dest="command", required=True)

    def command(name: str, run, *names: str) -> argparse.ArgumentParser:
        made = commands.add_parser(name)
        made.set_defaults(run=run)
        for n in names:
            made.add_argument(n)
        return made

    command("collect", collect, "feeds", "seen", "out").add_argument("--max-feeds", type=int, default=0)
    command("classify", classify_log, "log", "dictionaries", "archive").add_argument("--model")
    command("rescan", rescan_archive, "archive", "dictionaries", "out").add_argument("--everything", action="store_true")
    command("retry", retry, "archive", "dictionaries").add_argument("--model", required=True)
    command("publish", publish, "archive", "out").add_argument("--until")
    command("migrate", migrate, "table", "archive")
    command("vacuum", lambda spark, a: print(DayStore(spark, a.archive).vacuum(), "folders deleted"), "archive")
    for kind in ("parquet", "csv", "sqlite"):
        made = command(kind, export, "archive", "out")
        for name in ("--country", "--theme", "--media"):
            made.add_argument(name, action="append")
        for name in ("--start", "--end"):
            made.add_argument(name)
        made.add_argument("--search", default="")
    shown = command("site", show_site, "archive", "out")
    shown.add_argument("--days", type=int, default=7)
    shown.add_argument("--date-ref", default=datetime.datetime.now(datetime.timezone.utc).date().isoformat())
    shown.add_argument("--repo")
    a = top.parse_args(args)
    a.run(SparkSession.builder.appName("presslens").config("spark.sql.session.timeZone", "UTC").getOrCreate(), a)


if __name__ == "__main__":
    main()
