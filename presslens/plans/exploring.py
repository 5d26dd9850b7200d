"""Queries of the explorer beyond its tables: maps, cards, options, pages, split series."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.operators import explore, merge
from presslens.plans.base import query, table


@query("ranking_covered", "SELECT count(*) FILTER (WHERE n > 0) AS covered FROM (SELECT event_type, count(*) FILTER (WHERE value > 90) AS n FROM events GROUP BY event_type)")
def ranking_covered(spark, d):
    return explore.covered(table(spark, d, "events").groupBy("event_type").agg(F.count_if(F.col("value") > 90).alias("n")), "n")


@query("map_shapes", "SELECT n_name, coalesce(n, 0) AS n, coalesce(n, 0) / greatest(max(coalesce(n, 0)) OVER (), 1) AS shade FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_nationkey % 3 = 0 GROUP BY 1) ON c_nationkey = n_nationkey")
def map_shapes(spark, d):
    nation = table(spark, d, "nation")
    counts = table(spark, d, "customer").filter("c_nationkey % 3 = 0").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))
    return explore.map_shapes(nation, counts, "n_name", "n")


@query("junk_options", "SELECT DISTINCT place FROM (SELECT CASE doc_id % 9 WHEN 0 THEN 'Undetermined' WHEN 1 THEN 'NATO' WHEN 2 THEN NULL ELSE source END AS place FROM documents) WHERE place NOT IN ('Undetermined', 'NATO') ORDER BY 1")
def junk_options(spark, d):
    k = F.col("doc_id") % 9
    return explore.options(table(spark, d, "documents").select(F.when(k == 0, "Undetermined").when(k == 1, "NATO").when(k != 2, F.col("source")).alias("place")), "place", ("NATO",))


@query("page_count", "SELECT count(*) AS n, greatest(1, ceil(count(*) / 50.0))::BIGINT AS pages FROM events WHERE event_type = 'click'")
def page_count(spark, d):
    return explore.page_count(table(spark, d, "events").filter("event_type = 'click'"), 50)


@query("page_count_empty", "SELECT 0::BIGINT AS n, 1::BIGINT AS pages")
def page_count_empty(spark, d):
    return explore.page_count(table(spark, d, "events").filter("event_type = 'no such type'"), 50)


@query("crosstab_split_top", """WITH r AS (SELECT strftime(o_orderdate, '%Y-%m') AS m, o_orderpriority AS p FROM orders), t AS (SELECT p FROM r GROUP BY p ORDER BY count(*) DESC, p LIMIT 3), l AS (SELECT m FROM r GROUP BY m ORDER BY m DESC LIMIT 12)
  SELECT m, p, count(r2.p) AS value FROM l CROSS JOIN t LEFT JOIN r r2 USING (m, p) GROUP BY m, p""")
def crosstab_split_top(spark, d):
    rows = table(spark, d, "orders").select(F.date_format("o_orderdate", "yyyy-MM").alias("m"), F.col("o_orderpriority").alias("p"))
    return explore.split_series(rows, "m", "p", F.count(F.lit(1)), 3, 12, by_date=True)


def _fixed(x: str) -> str:
    """Two places, rounded on the exact binary value, ties upwards."""
    return f"CASE WHEN {x} * 8 = floor({x} * 8) THEN floor({x} * 100 + 0.5) / 100 ELSE format('{{:.2f}}', {x})::DOUBLE END"


@query("media_card_rated", f"""WITH r AS (SELECT user_id, event_id, ts, floor(value) AS nv, CASE WHEN event_id % 3 = 0 THEN event_id % 5 END AS rated, (6.0::DOUBLE - 2.5) * floor(value) / 100 AS x FROM events)
  SELECT user_id, n, n_naval, {_fixed('a')} AS note, rating, latest FROM (
  SELECT user_id, count(*) AS n, count(*) FILTER (WHERE nv >= 1) AS n_naval, coalesce(avg(CASE WHEN nv >= 1 THEN {_fixed('x')} END), 0) AS a, arg_max(rated, (ts, event_id)) FILTER (WHERE rated IS NOT NULL) AS rating, arg_max(event_id, (ts, event_id)) AS latest FROM r GROUP BY user_id)""")
def media_card_rated(spark, d):
    rows = table(spark, d, "events").select("user_id", "event_id", "ts", F.floor("value").cast("double").alias("nv"), F.lit(2.5).alias("fi"), F.when(F.col("event_id") % 3 == 0, F.col("event_id") % 5).alias("rated"))
    made = explore.media_card(rows, "user_id", "fi", "nv", "rated", [F.col("ts"), F.col("event_id")])
    naval = rows.groupBy("user_id").agg(F.count_if(F.col("nv") >= 1).alias("n_naval"))
    return made.join(naval, "user_id").select("user_id", "n", "n_naval", "note", "rating", F.col("latest.event_id").alias("latest"))


@query("media_countries", "SELECT user_id, event_type, count(*) AS n FROM events WHERE event_type <> 'error' GROUP BY ALL")
def media_countries(spark, d):
    return explore.media_countries(table(spark, d, "events"), "user_id", "event_type", ("error",))


@query("date_desc_list", "SELECT event_id, ts FROM events WHERE user_id = (SELECT min(user_id) FROM events) ORDER BY ts DESC, event_id")
def date_desc_list(spark, d):
    events = table(spark, d, "events")
    first = events.agg(F.min("user_id")).first()[0]
    return events.filter(F.col("user_id") == first).select("event_id", "ts").orderBy(F.desc("ts"), "event_id")


@query("added_count", "SELECT count(*) FILTER (WHERE event_id % 2 = 0) - count(*) FILTER (WHERE event_id % 5 <> 0) AS added, greatest(0, count(*) FILTER (WHERE event_id % 2 = 0) - count(*) FILTER (WHERE event_id % 5 <> 0)) AS shown FROM events")
def added_count(spark, d):
    events = table(spark, d, "events")
    return merge.added(events.filter("event_id % 5 <> 0"), events.filter("event_id % 2 = 0"))


@query("key_union", "SELECT DISTINCT ts::DATE AS day FROM events WHERE event_id % 3 = 0 OR user_id % 7 = 0")
def key_union(spark, d):
    days = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    return merge.key_union(days.filter("event_id % 3 = 0").select("day"), days.filter("user_id % 7 = 0").select("day"))


@query("key_difference", "SELECT DISTINCT user_id, event_type FROM events WHERE (user_id, event_type) NOT IN (SELECT user_id, event_type FROM events WHERE value > 100)")
def key_difference(spark, d):
    events = table(spark, d, "events")
    return merge.key_difference(events.select("user_id", "event_type"), events.filter("value > 100").select("user_id", "event_type").distinct())
