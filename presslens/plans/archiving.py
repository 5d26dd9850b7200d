"""Queries on sources and sinks: what is written is read back, so the answer shows what was stored."""

from __future__ import annotations

import os
import sqlite3
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from presslens.functions import dates
from presslens.operators import classify, merge
from presslens.plans.base import query, scratch, table
from presslens.sources import archive, dictionaries, feeds, manifest, site
from presslens.sources.files import load_or_empty
from presslens.streaming import ingest


def _daily(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "ts", F.col("ts").cast("date").alias("day"))


@query("days_round_trip", "SELECT event_id, ts::DATE AS day, ts FROM events WHERE ts::DATE BETWEEN DATE '2024-01-05' AND DATE '2024-01-09'")
def days_round_trip(spark, d):
    path = scratch(spark, "days")
    archive.write_days(_daily(spark, d), path, "day", [F.desc("ts"), F.desc("event_id")])
    return archive.read_days(spark, path, "event_id long, user_id long, event_type string, ts timestamp_ntz", "2024-01-05", "2024-01-09").select("event_id", "day", "ts")


@query("days_updated", "SELECT event_id, ts::DATE AS day FROM events WHERE ts::DATE <> DATE '2024-01-07' AND NOT (ts::DATE = DATE '2024-01-08' AND event_id % 2 = 0)")
def days_updated(spark, d):
    path, rows = scratch(spark, "days"), _daily(spark, d)
    archive.update_days(rows, path, "day", [F.desc("ts"), F.desc("event_id")])
    archive.update_days(rows.filter("day <> DATE '2024-01-07' AND NOT (day = DATE '2024-01-08' AND event_id % 2 = 0)"), path, "day", [F.desc("ts"), F.desc("event_id")])
    return spark.read.schema(rows.schema).parquet(path).select("event_id", "day")


@query("days_changed", "SELECT * FROM (VALUES (DATE '2024-01-07', true), (DATE '2024-01-08', false)) AS t(day, emptied) WHERE day IN (SELECT ts::DATE FROM events)")
def days_changed(spark, d):
    path, rows = scratch(spark, "days"), _daily(spark, d)
    archive.update_days(rows, path, "day", [F.desc("ts"), F.desc("event_id")])
    return archive.update_days(rows.filter("day <> DATE '2024-01-07' AND NOT (day = DATE '2024-01-08' AND event_id % 2 = 0)"), path, "day", [F.desc("ts"), F.desc("event_id")])


@query("days_merged", "SELECT event_id, link FROM (SELECT event_id, event_id % 2 AS new, CASE WHEN user_id % 9 = 0 THEN '' ELSE user_id || event_type END AS link FROM events) WHERE link = '' OR true QUALIFY link = '' OR row_number() OVER (PARTITION BY link ORDER BY new, event_id) = 1")
def days_merged(spark, d):
    path = scratch(spark, "days")
    rows = _daily(spark, d).withColumn("link", F.when(F.col("user_id") % 9 == 0, "").otherwise(F.concat(F.col("user_id").cast("string"), "event_type"))).withColumn("day", F.lit("2024-01-01").cast("date"))
    order = [F.col("event_id")]
    archive.write_days(merge.dedup_first(rows.filter("event_id % 2 = 0"), "link", order, blank_exempt=True), path, "day", order)
    archive.merge_days(rows.filter("event_id % 2 = 1"), path, "day", "link", order)
    return spark.read.schema(rows.schema).parquet(path).select("event_id", "link")


@query("archive_order", "SELECT event_id, row_number() OVER (PARTITION BY ts::DATE ORDER BY ts DESC, event_id DESC) AS place FROM events")
def archive_order(spark, d):
    path = scratch(spark, "days")
    archive.write_days(_daily(spark, d), path, "day", [F.desc("ts"), F.desc("event_id")])
    # Places as they are in the files, which are read whole and in order.
    held = spark.read.parquet(path).select("event_id", "day", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"))
    return held.select("event_id", F.row_number().over(Window.partitionBy("day").orderBy("file", "n")).cast("long").alias("place"))


@query("migration", "SELECT year(ts)::VARCHAR AS year, count(DISTINCT ts::DATE) AS days, count(*) AS articles FROM (SELECT ts, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1) GROUP BY 1")
def migration(spark, d):
    rows = table(spark, d, "events").select("event_id", F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("lien"), F.date_format("ts", "yyyy-MM-dd HH:mm").alias("time_stamp"))
    return archive.migrate(rows, scratch(spark, "archive"), [F.col("event_id")])


@query("csv_round_trip", """SELECT doc_id::VARCHAR AS doc_id, source AS media, 'a;"b" ' || source AS titre FROM documents""")
def csv_round_trip(spark, d):
    path = scratch(spark, "csv")
    rows = table(spark, d, "documents").select(F.col("source").alias("media"), F.concat(F.lit('a;"b" '), "source").alias("titre"), F.col("doc_id").cast("string").alias("lien"), F.lit("").alias("date"))
    archive.export_csv(rows, path)
    return feeds.read_log(spark, path).select(F.col("lien").alias("doc_id"), "media", "titre")


@query("log_appended", "SELECT doc_id::VARCHAR AS lien, source AS media FROM documents WHERE doc_id % 4 IN (0, 1)")
def log_appended(spark, d):
    path = scratch(spark, "log")
    rows = table(spark, d, "documents").select(F.col("source").alias("media"), F.lit("t").alias("titre"), F.col("doc_id").cast("string").alias("lien"), F.lit("").alias("date"))
    feeds.append_log(rows.filter("lien % 4 = 0"), path)
    feeds.append_log(rows.filter("lien % 4 = 1").union(rows.filter("lien % 4 = 2").withColumn("titre", F.lit(""))), path)
    return feeds.read_log(spark, path).select("lien", "media")


@query("seen_state", "SELECT DISTINCT sha1(url) AS hash FROM pages ORDER BY 1")
def seen_state(spark, d):
    path = scratch(spark, "seen")
    feeds.write_seen(table(spark, d, "pages").select(F.sha1(F.col("url").cast("binary")).alias("hash")), path)
    return feeds.read_seen(spark, path)


@query("parquet_export", "SELECT doc_id, source AS nom_du_media, CASE doc_id % 3 WHEN 0 THEN NULL ELSE doc_id + 0.5 END::DOUBLE AS official_rating, TIMESTAMP '2026-07-08 10:30:00' AS time_stamp FROM documents")
def parquet_export(spark, d):
    path = scratch(spark, "one")
    k = F.col("doc_id")
    rows = table(spark, d, "documents").select(F.col("source").alias("nom_du_media"), k.cast("string").alias("lien"), F.when(k % 3 != 0, F.concat(k.cast("string"), F.lit(".5"))).otherwise("").alias("official_rating"), F.lit("2026-07-08 10:30").alias("time_stamp"))
    archive.export_parquet(archive.to_stored(rows), path)
    return spark.read.schema(archive.ARCHIVE).parquet(path).select(F.col("lien").cast("long").alias("doc_id"), "nom_du_media", "official_rating", "time_stamp")


@query("archive_texts", "SELECT doc_id::VARCHAR AS lien, CASE WHEN doc_id % 2 = 0 THEN doc_id || '.5' ELSE doc_id::VARCHAR END AS official_rating, '2026-07-08 10:30' AS time_stamp, '' AS langue FROM documents")
def archive_texts(spark, d):
    k = F.col("doc_id").cast("string")
    rows = table(spark, d, "documents").select(k.alias("lien"), F.when(F.col("doc_id") % 2 == 0, F.concat(k, F.lit(".5"))).otherwise(k).alias("official_rating"), F.lit(" 2026-07-08 10:30:59").alias("time_stamp"))
    return archive.to_text(archive.to_stored(rows)).select("lien", "official_rating", "time_stamp", "langue")


@query("sqlite_export", "SELECT n_nationkey::DOUBLE AS n_nationkey, n_name FROM nation")
def sqlite_export(spark, d):
    folder = tempfile.mkdtemp()  # SQLite needs a file on the driver
    archive.export_sqlite(table(spark, d, "nation").select("n_nationkey", "n_name"), f"{folder}/a.db", indexes=("n_name",), batch=7)
    with sqlite3.connect(f"{folder}/a.db") as db:
        rows = db.execute("SELECT n_nationkey, n_name FROM articles").fetchall()
    os.remove(f"{folder}/a.db")
    return spark.createDataFrame(rows, "n_nationkey double, n_name string")


@query("load_or_empty", "SELECT n_name FROM nation")
def load_or_empty_query(spark, d):
    there = load_or_empty(spark, f"{d}/nation.parquet", "n_name string")
    return there.unionByName(load_or_empty(spark, f"{d}/no_such_table.parquet", "n_name string"))


_RECORDS = """(SELECT doc_id, source AS m, 'T' || doc_id AS t, '2024-01-' || lpad((doc_id % 28 + 1)::VARCHAR, 2, '0') AS day, CASE doc_id % 3 WHEN 0 THEN NULL ELSE doc_id % 50 + 0.5 END::DOUBLE AS nv, CASE doc_id % 2 WHEN 0 THEN lang ELSE 'en' END AS lg FROM documents)"""


def _site_rows(spark, d):
    k = F.col("doc_id")
    day = F.concat(F.lit("2024-01-"), F.lpad((k % 28 + 1).cast("string"), 2, "0"))
    made = table(spark, d, "documents").select(F.col("source").alias("nom_du_media"), F.concat(F.lit("T"), k.cast("string")).alias("titre"), k.cast("string").alias("lien"), F.concat(day, F.lit(" 08:00")).alias("time_stamp"), F.when(k % 3 != 0, F.concat((k % 50).cast("string"), F.lit(",5"))).alias("indice_interet_naval"), F.when(k % 2 == 0, F.col("lang")).alias("langue"))
    return made.withColumns({c: F.lit("") for c in archive.COLUMNS if c not in made.columns})


@query("site_json", f"SELECT doc_id::VARCHAR AS l, m, t, day || ' 08:00' AS d, coalesce(nv, 0) AS nv, lg, 'F' AS no FROM {_RECORDS} WHERE day::DATE BETWEEN DATE '2024-01-09' AND DATE '2024-01-16'")
def site_json(spark, d):
    path = scratch(spark, "site")
    site.write_site(_site_rows(spark, d), path, "2024-01-25")
    site.write_site(_site_rows(spark, d), path, "2024-01-15")
    return spark.read.schema("l string, m string, t string, d string, nv double, lg string, no string").json(path).select("l", "m", "t", "d", "nv", "lg", "no")


@query("site_meta", f"SELECT sum(n)::BIGINT AS count, 0 AS added, 7 AS jours_site, count(*) AS days, max(day) AS newest FROM (SELECT day, count(*) AS n FROM {_RECORDS} WHERE day::DATE BETWEEN DATE '2024-01-09' AND DATE '2024-01-16' GROUP BY day)")
def site_meta(spark, d):
    made = site.metadata(site.window(site.records(_site_rows(spark, d)), "2024-01-15"), -3)
    return made.select("count", "added", "jours_site", F.size("jours").cast("long").alias("days"), F.get("jours", 0)["jour"].alias("newest"))


@query("site_order", f"SELECT doc_id::VARCHAR AS l FROM {_RECORDS} ORDER BY day DESC, l")
def site_order(spark, d):
    return site.newest_first(site.records(_site_rows(spark, d))).select("l")


def _files(spark, d):
    return manifest.of_days(table(spark, d, "events").select(F.when(F.col("event_id") % 7 != 0, F.col("ts").cast("date").cast("string")).otherwise("x").alias("day")).distinct())


_FILES = "(SELECT DISTINCT CASE WHEN event_id % 7 = 0 THEN 'data-undated' ELSE 'data-' || year(ts) END AS release, CASE WHEN event_id % 7 = 0 THEN 'undated.parquet' ELSE strftime(ts, '%Y-%m-%d') || '.parquet' END AS file FROM events)"


@query("manifest_marked", f"SELECT * FROM {_FILES}")
def manifest_marked(spark, d):
    path, files = scratch(spark, "manifest"), _files(spark, d)
    manifest.mark(manifest.read_manifest(spark, path), files.filter("file < '2024-01-20'")).write.parquet(path)
    return manifest.mark(manifest.read_manifest(spark, path), files.filter("file > '2024-01-10'"))


_OLD = "(NOT regexp_matches(file, '^\\d{4}') OR substr(file, 1, 10) < '2024-01-11')"


@query("publish_filter", f"SELECT *, true AS published FROM {_FILES} WHERE {_OLD} UNION ALL SELECT *, false FROM {_FILES} WHERE NOT {_OLD}")
def publish_filter(spark, d):
    old = dates.publishable(manifest.file_day(F.col("file")), F.lit("2024-01-20").cast("date"))
    now, later = manifest.split(_files(spark, d), old)
    return now.withColumn("published", F.lit(True)).unionByName(later.withColumn("published", F.lit(False)))


@query("inventory_year", "SELECT o_orderkey FROM orders WHERE o_orderpriority NOT LIKE '1%' AND year(o_orderdate) = 1997 AND o_orderstatus <> 'O'")
def inventory_year(spark, d):
    """Orders as a listing: the year is the release, the first priority has no data file, open ones are unfinished uploads."""
    status = F.col("o_orderstatus")
    suffix = F.when(F.col("o_orderpriority").startswith("1"), ".txt").otherwise(".parquet")
    listed = table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("data-"), F.year("o_orderdate").cast("string")).alias("release"), F.concat(F.col("o_orderkey").cast("string"), suffix).alias("file"), F.when(status == "O", "starter").when(status == "F", "uploaded").alias("state"))
    return manifest.inventory(listed, 1997).select("o_orderkey")


@query("stale_files", "SELECT n_name || '.parquet' AS file FROM nation WHERE n_nationkey % 4 <> 0")
def stale_files(spark, d):
    k, name = F.col("n_nationkey"), F.concat("n_name", F.lit(".parquet"))
    nation = table(spark, d, "nation")
    digest = F.sha2(F.col("n_name").cast("binary"), 256)
    listed = nation.select(name.alias("file"), F.lit(10).cast("long").alias("size"), F.when(k % 8 == 0, F.lit(None)).otherwise(F.concat(F.lit("sha256:"), digest)).alias("digest"))
    local = nation.filter(k % 4 != 1).select(name.alias("file"), F.when(k % 4 == 2, 9).otherwise(10).cast("long").alias("size"), F.when(k % 4 == 3, "0").when(k % 8 == 0, "other").otherwise(digest).alias("digest"))
    return manifest.stale(listed, local).select("file")


@query("feed_items", "SELECT page_id, source AS media, titre, date FROM (SELECT page_id, 'm' || page_id AS source, CASE WHEN page_id % 4 = 1 THEN 'Atom ' ELSE 'Rss ' END || page_id AS titre, CASE WHEN page_id % 4 = 1 THEN '2026-07-08 10:30' ELSE '2026-07-08 11:00' END AS date FROM pages) WHERE page_id % 4 IN (0, 1)")
def feed_items(spark, d):
    k = F.col("page_id").cast("string")
    rss = F.concat(F.lit("<rss><channel><title>c</title><item xmlns:media='urn:m'><media:title>no</media:title><title> Rss "), k, F.lit("</title><link>http://x/"), k, F.lit("</link><pubDate>Wed, 08 Jul 2026 11:00:00 GMT</pubDate></item><item><title>no link</title></item></channel></rss>"))
    atom = F.concat(F.lit("<feed xmlns='http://www.w3.org/2005/Atom'><entry><title>Atom "), k, F.lit("</title><link href='http://y/"), k, F.lit("'/><updated>2026-07-08T10:30:00Z</updated></entry></feed>"))
    content = F.when(F.col("page_id") % 4 == 0, rss).when(F.col("page_id") % 4 == 1, atom).when(F.col("page_id") % 4 == 2, "<rss><item>").otherwise("")
    pages = table(spark, d, "pages").select("page_id", F.concat(F.lit("m"), k).alias("media"), content.cast("binary").alias("content"))
    return feeds.read_feeds(pages).select(F.substring("media", 2, 20).cast("long").alias("page_id"), "media", "titre", "date")


_URL = "replace(url, chr(39), '')"


def _catalogues(spark, d):
    """A catalogue a page: its own feed, and one that others list as well; double quotes and addresses outside a call do not count."""
    k = F.col("page_id").cast("string")
    url = F.replace("url", F.lit("'"), F.lit(""))
    entry = F.concat(F.lit("{ name: 'p"), k, F.lit("',\n  url: rss('"), url, F.lit("') },\n{ name: 'n"), (F.col("page_id") % 10).cast("string"), F.lit("', url: rss( '"), url, F.lit("?n') }, { name: \"d"), k, F.lit("\", url: rss(\"x\") }, { name: 'q"), k, F.lit("', url: 'y' }"))
    return table(spark, d, "pages").select("page_id", entry.alias("value"))


@query("feed_catalogue", f"SELECT 'p' || page_id AS name, {_URL} AS url FROM pages UNION ALL SELECT 'n' || (page_id % 10), arg_min({_URL} || '?n', page_id) FROM pages GROUP BY 1")
def feed_catalogue(spark, d):
    return feeds.feed_catalogue(_catalogues(spark, d), order="page_id")


@query("prefix_limit", f"SELECT name, url FROM (SELECT 'p' || page_id AS name, {_URL} AS url, 2 * page_id AS place FROM pages UNION ALL SELECT 'n' || (page_id % 10), arg_min({_URL} || '?n', page_id), 2 * min(page_id) + 1 FROM pages GROUP BY 1) ORDER BY place LIMIT 5")
def prefix_limit(spark, d):
    return feeds.feed_catalogue(_catalogues(spark, d), 5, order="page_id")


def _dictionary_text(spark, d, line) -> str:
    """A dictionary file written from the tables and read back, a line per region."""
    path = scratch(spark, "dictionary")
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    named = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    word = F.concat(F.when(F.col("n_nationkey") % 3 == 0, "*").otherwise(""), "n_name")
    lines = named.groupBy("r_regionkey", "r_name").agg(F.array_join(F.sort_array(F.collect_list(word)), ", ").alias("words")).select(line.alias("value"))  # 25 nations
    lines.unionByName(spark.createDataFrame([("# a remark",), ("no colon",)], "value string")).repartition(1).write.text(path)
    return dictionaries.whole_text(spark, f"{path}/*.txt")


_NATIONS = "nation JOIN region ON n_regionkey = r_regionkey"


@query("dictionary_classes", f"SELECT r_name AS class, lower(n_name) AS kw, CASE WHEN n_nationkey % 3 = 0 THEN 2 ELSE 1 END AS weight FROM {_NATIONS}")
def dictionary_classes(spark, d):
    said = _dictionary_text(spark, d, F.concat("r_name", F.lit(": "), "words"))
    return spark.createDataFrame([(name, word, weight) for name, words in dictionaries.classes(said) for word, weight in words], "class string, kw string, weight int")


@query("dictionary_scale", f"SELECT lower(CASE WHEN n_nationkey % 3 = 0 THEN '*' ELSE '' END || n_name) AS kw, r_regionkey * 5 AS weight FROM {_NATIONS} WHERE r_regionkey > 0")
def dictionary_scale(spark, d):
    said = _dictionary_text(spark, d, F.concat(F.when(F.col("r_regionkey") > 0, (F.col("r_regionkey") * 5).cast("string")).otherwise("much"), F.lit(": "), "words"))
    return spark.createDataFrame([(word, weight) for _, words in dictionaries.scale(said) for word, weight in words], "kw string, weight int")


@query("dictionary_zones", f"SELECT r_name AS zone, lower(CASE WHEN n_nationkey % 3 = 0 THEN '*' ELSE '' END || n_name) AS kw FROM {_NATIONS} WHERE r_regionkey <> 2")
def dictionary_zones(spark, d):
    said = _dictionary_text(spark, d, F.concat("r_name", F.lit(" :"), F.when(F.col("r_regionkey") == 2, " , ").otherwise(F.col("words"))))
    return spark.createDataFrame([(zone, word) for zone, words in dictionaries.zones(said) for word, _ in words], "zone string, kw string")


@query("json_map", f"SELECT n_name, r_name AS region FROM {_NATIONS}")
def json_map(spark, d):
    """Regions by country from a JSON file that the tables made."""
    path = scratch(spark, "regions")
    nation, region = table(spark, d, "nation"), table(spark, d, "region")
    named = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    named.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("n_name", "r_name")))).alias("value")).write.text(path)  # 25 nations
    regions = dictionaries.json_map(dictionaries.whole_text(spark, f"{path}/*.txt"))
    return classify.with_region(nation.select("n_name"), regions, "n_name")


@query("stream_ingest", "SELECT page_id, sha1(url) AS hash FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id % 2, page_id) = 1")
def stream_ingest(spark, d):
    base, pages = scratch(spark, "stream"), table(spark, d, "pages").select("page_id", "url")
    for part in (0, 1):
        pages.filter(f"page_id % 2 = {part}").write.mode("append").parquet(f"{base}/in")
        ingest.ingest(spark, f"{base}/in", "page_id long, url string", f"{base}/out", f"{base}/seen", f"{base}/state", "url", ["page_id"], lambda r: r.drop("url"))
    return spark.read.parquet(f"{base}/out").select("page_id", "hash")
