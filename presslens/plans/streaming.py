"""Queries on streams, the day store and SQL over it; each reads back what was stored."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from presslens.functions import sql
from presslens.operators import classify, explore, rescan
from presslens.plans import classifying
from presslens.plans.base import query, scratch, table
from presslens.sources import archive, dictionaries
from presslens.sources.store import DayStore
from presslens.streaming import ingest
from presslens.streaming.seen import SeenState

_DAY, _LINK = "DATE '2024-01-01' + (doc_id % 28)::INT", "nom_du_media || '/' || (doc_id % 97)"
ARTICLE = "doc_id long, titre string, nom_du_media string, lien string, day date"


def _dated(spark, d):
    """Articles with a day and a link that some share."""
    k = F.col("doc_id")
    return classifying._articles(spark, d).withColumns({"lien": F.concat("nom_du_media", F.lit("/"), (k % 97).cast("string")), "day": F.date_add(F.lit("2024-01-01").cast("date"), (k % 28).cast("int"))})


@query("stream_days", f"""SELECT doc_id, ({_DAY})::DATE AS day, sujet_article, country_article, true AS pending FROM {classifying._CLASSIFIED} QUALIFY row_number() OVER (PARTITION BY {_LINK} ORDER BY doc_id % 3 = 0, doc_id) = 1""")
def stream_days(spark, d):
    """Two batches: the second brings late days and what the first had; then the second comes again, as after a crash before its checkpoint."""
    base, rows = scratch(spark, "days"), _dated(spark, d)
    words, cards = classifying.words(), dictionaries.cards(spark, classifying.CARDS)
    made = classify.classify_rows(rows.limit(0), words, cards)
    store = DayStore(spark, f"{base}/archive", made.schema)
    batch = ingest.day_batch(store, SeenState(spark, f"{base}/seen"), "lien", ["doc_id"], lambda r: classify.classify_rows(r, words, cards))
    late = rows.filter("doc_id % 3 = 0 OR doc_id % 4 = 0")
    for part in (rows.filter("doc_id % 3 <> 0"), late):
        part.write.mode("append").parquet(f"{base}/in")
        ingest.ingest_days(spark, f"{base}/in", ARTICLE, f"{base}/state", batch, files_per_batch=None)
    batch(late, 1)
    marked = store.pending().select(F.substring("file", 1, 10).cast("date").alias("day"), F.lit(True).alias("pending"))
    return store.read().join(F.broadcast(marked), "day", "left").select("doc_id", "day", "sujet_article", "country_article", F.coalesce("pending", F.lit(False)).alias("pending"))


@query("stream_bounded", "SELECT event_id, ts FROM events UNION ALL SELECT -1, TIMESTAMP '2024-06-01' UNION ALL SELECT event_id, ts + INTERVAL 200 DAY FROM events")
def stream_bounded(spark, d):
    """Every event, again within the watermark (dropped), a beat that moves the watermark, and again far beyond it (new)."""
    base, events = scratch(spark, "bounded"), table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    beat = spark.range(1).select(F.lit(-1).cast("long").alias("event_id"), F.lit("2024-06-01").cast("timestamp").alias("ts"))
    for part in (events, events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 30 MINUTES")), beat, events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 200 DAYS"))):
        part.write.mode("append").parquet(f"{base}/in")
        ingest.ingest_bounded(spark, f"{base}/in", "event_id long, ts timestamp", f"{base}/out", f"{base}/state", "ts", "event_id", files_per_batch=None)
    return spark.read.parquet(f"{base}/out").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


def _daily(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "ts", F.col("ts").cast("date").alias("day"))


def _event_store(spark, d):
    rows = _daily(spark, d).withColumn("lien", F.col("event_id").cast("string"))
    return DayStore(spark, scratch(spark, "store"), rows.schema), rows


@query("store_days", """SELECT event_id, ts::DATE AS day, day IN (DATE '2024-01-07', DATE '2024-01-08') AS twice FROM (SELECT *, ts::DATE AS day FROM events) WHERE NOT (day = DATE '2024-01-08' AND event_id % 2 = 0) AND day <> DATE '2024-01-09'""")
def store_days(spark, d):
    """The archive replaced: one day loses half its rows, one all, one is rewritten with other rows of the same number; the rest keep their folders."""
    store, rows = _event_store(spark, d)
    order = [F.desc("ts"), F.desc("event_id")]
    store.replace_with(rows.withColumn("user_id", F.when(F.col("day") == F.lit("2024-01-07").cast("date"), F.col("user_id") + 1).otherwise(F.col("user_id"))), order)
    first = store.state()
    store.replace_with(rows.filter("NOT (day = DATE '2024-01-08' AND event_id % 2 = 0) AND day <> DATE '2024-01-09'"), order)
    now = store.state()
    moved = [x for x in now.days if now.days[x]["generation"] != first.days[x]["generation"]]
    return store.read(state=now).select("event_id", "day", F.col("day").cast("string").isin(moved).alias("twice"))


@query("archive_sql", "SELECT event_type, count(*) AS n, min(ts) AS first FROM events WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' GROUP BY event_type")
def archive_sql(spark, d):
    """SQL over the archive as a table of the catalog: the days outside the period are pruned."""
    store, rows = _event_store(spark, d)
    store.add(rows, [F.col("event_id")])
    name = f"articles_{uuid.uuid4().hex}"
    store.register(name)
    return spark.sql(f"SELECT event_type, count(*) AS n, min(ts) AS first FROM {name} WHERE day BETWEEN date'2024-01-05' AND date'2024-01-09' GROUP BY event_type")


@query("archive_glob", "SELECT user_id, count(*) AS n FROM events WHERE ts::DATE >= DATE '2024-01-20' GROUP BY user_id")
def archive_glob(spark, d):
    """The same over a pattern of paths, as a view."""
    path = scratch(spark, "days")
    archive.write_days(_daily(spark, d), path, "day", [F.desc("ts"), F.desc("event_id")])
    spark.read.option("basePath", path).parquet(f"{path}/day=2024-*").createOrReplaceTempView("archive_files")
    return spark.sql("SELECT user_id, count(*) AS n FROM archive_files WHERE day >= date'2024-01-20' GROUP BY user_id")


@query("export_selected", "SELECT event_id::VARCHAR AS event_id, event_type FROM events WHERE event_type IN ('click', 'view') AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'")
def export_selected(spark, d):
    path = scratch(spark, "selected")
    chosen = explore.Selection({"event_type": ("click", "view")}, ("ts", "2024-01-05", "2024-01-12"), ("", ("event_type",)))
    archive.export_selection(table(spark, d, "events").select("event_id", "event_type", "ts"), chosen, path)
    return spark.read.csv(path, sep=";", header=True).select("event_id", "event_type")


@query("measures", """SELECT coalesce(nullif(event_type, ''), '—') AS value, count(*) AS count, count(DISTINCT user_id) AS sources, round(sum(coalesce(value, 0)) / count(*), 6) AS naval, count(*) FILTER (WHERE value > 0) AS navcount
  FROM (SELECT user_id, CASE WHEN event_id % 50 = 0 THEN '' WHEN event_id % 50 = 1 THEN NULL ELSE event_type END AS event_type, CASE WHEN event_id % 7 > 0 THEN value END AS value FROM events) GROUP BY 1""")
def measures(spark, d):
    k = F.col("event_id")
    rows = table(spark, d, "events").select("user_id", F.when(k % 50 == 0, "").when(k % 50 == 1, None).otherwise(F.col("event_type")).alias("event_type"), F.when(k % 7 > 0, F.col("value")).alias("value"))
    return explore.measured(rows, "event_type", list(explore.MEASURES), "user_id", "value").withColumn("naval", F.round("naval", 6))


@query("rescan_observed", classifying.ORACLE_SQL["rescan_counters"])
def rescan_observed(spark, d):
    """The counters of a rescan from the pass that writes its rows."""
    found, seen = rescan.observed(rescan.marked(*classifying._rescanned(spark, d)))
    rescan.settled(found).write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([tuple(seen.get[n] for n in rescan.FLAGS.values())], ", ".join(f"{n} long" for n in rescan.FLAGS.values()))


_ITEMS = """SELECT page_id, 0 AS position, url AS link, 'T ' || page_id AS title FROM pages WHERE page_id % 3 <> 2 UNION ALL SELECT page_id, 1, url || '?b', 'U' FROM pages WHERE page_id % 3 = 0"""


@query("feed_lateral", _ITEMS)
def feed_lateral(spark, d):
    """Feeds read by the table function in SQL; a third of them is cut off."""
    sql.register(spark)
    url = F.replace("url", F.lit("&"), F.lit("&amp;"))
    first = F.concat(F.lit("<item><title> T "), F.col("page_id").cast("string"), F.lit("</title><link>"), url, F.lit("</link></item>"))
    second = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("<item><title>U</title><link>"), url, F.lit("?b</link></item>"))).otherwise("")
    whole = F.concat(F.lit("<rss><channel>"), first, second, F.when(F.col("page_id") % 3 == 2, "</chan").otherwise("</channel></rss>"))
    table(spark, d, "pages").select("page_id", whole.cast("binary").alias("content")).createOrReplaceTempView("fetched")
    return spark.sql("SELECT page_id, i.position, i.link, i.title FROM fetched, LATERAL feed_items(content) AS i")


@query("sql_scores", f"SELECT doc_id, ({classifying.total_sql(classifying.NAVAL)})::INT AS naval FROM (SELECT doc_id, {classifying.norm_sql('text')} AS t FROM documents)")
def sql_scores(spark, d):
    sql.register(spark, classifying.words().naval)
    return spark.sql("SELECT doc_id, naval_score(text) AS naval FROM {docs}", docs=table(spark, d, "documents"))
