"""The queries that the driver runs, and the SQL each must agree with."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.functions import dates, language, scores, text
from presslens.operators import explore, matching, media, merge
from presslens.plans import archiving, classifying, exploring, streaming  # noqa: F401  they register their queries
from presslens.plans.base import ORACLE_SQL, QUERIES, norm_sql, query, table  # noqa: F401


@query("facet_count_top20", "SELECT source AS facet, count(*) AS n FROM documents GROUP BY source ORDER BY n DESC, facet LIMIT 20")
def facet_count_top20(spark, d):
    return table(spark, d, "documents").groupBy(F.col("source").alias("facet")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "facet").limit(20)


@query("map_measures", """SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS n_media, round(sum(coalesce(floor(value), 0)) / count(*), 6) AS mean_interest,
  count(*) FILTER (WHERE floor(value) > 0) AS n_interest FROM events WHERE event_type IS NOT NULL GROUP BY event_type""")
def map_measures(spark, d):
    rows = table(spark, d, "events").withColumn("nv", F.floor("value").cast("double"))
    return explore.map_measures(rows, "event_type", "user_id", "nv").withColumn("mean_interest", F.round("mean_interest", 6))


_BY_NATION = "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"


def _orders_by_nation(spark, d):
    nation, customer, orders = (table(spark, d, t) for t in ("nation", "customer", "orders"))
    return orders.join(customer, orders.o_custkey == customer.c_custkey).join(nation, customer.c_nationkey == nation.n_nationkey)


@query("ranking_top25", f"SELECT n_name, count(*) AS n {_BY_NATION} GROUP BY n_name ORDER BY n DESC, n_name LIMIT 25")
def ranking_top25(spark, d):
    return explore.ranking(_orders_by_nation(spark, d).groupBy("n_name").agg(F.count(F.lit(1)).alias("n")), "n_name", "n")


STRAITS = {"north": ["the", "den"], "south": ["tion", "ando"], "east": ["zzzz"]}


_STRAITS_SQL = " UNION ALL ".join(f"SELECT '{n}' AS label, count(*) FILTER (WHERE {' OR '.join(f"contains(lower(text), '{t}')" for t in ts)}) AS n FROM documents" for n, ts in STRAITS.items())


@query("substring_multilabel", _STRAITS_SQL)
def substring_multilabel(spark, d):
    return matching.label_counts(table(spark, d, "documents"), STRAITS, "text")


_PAIRS_SQL = " UNION ALL ".join(f"SELECT doc_id, '{n}' AS label FROM documents WHERE {' OR '.join(f"contains(lower(text), '{t}')" for t in ts)}" for n, ts in STRAITS.items())


@query("substring_pairs", _PAIRS_SQL)
def substring_pairs(spark, d):
    return matching.substring_labels(table(spark, d, "documents"), STRAITS, "text").select("doc_id", "label")


_EDGES = """SELECT ns.n_name AS src, nc.n_name AS dst, count(*) AS w FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ns ON s_nationkey = ns.n_nationkey
  JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation nc ON c_nationkey = nc.n_nationkey WHERE ns.n_name <> nc.n_name GROUP BY ALL"""
_TOP = f"""WITH e AS ({_EDGES}), s AS (SELECT src FROM e GROUP BY src ORDER BY sum(w) DESC, src LIMIT 5), t AS (SELECT dst FROM e GROUP BY dst ORDER BY sum(w) DESC, dst LIMIT 5),
  k AS (SELECT * FROM e WHERE src IN (FROM s) AND dst IN (FROM t))"""


def _graph(spark, d):
    lineitem, supplier, nation, orders, customer = (table(spark, d, t) for t in ("lineitem", "supplier", "nation", "orders", "customer"))
    of_supplier = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select("s_suppkey", F.col("n_name").alias("sn"))
    of_customer = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select("c_custkey", F.col("n_name").alias("cn"))
    of_order = orders.join(of_customer, orders.o_custkey == of_customer.c_custkey).select("o_orderkey", "cn")
    rows = lineitem.select("l_orderkey", "l_suppkey").join(of_supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(of_order, F.col("l_orderkey") == F.col("o_orderkey"))
    return explore.edges(rows, "sn", "cn", same_dim=True)


@query("weighted_edges", _EDGES)
def weighted_edges(spark, d):
    return _graph(spark, d)


@query("edges_topn", f"{_TOP} SELECT * FROM k")
def edges_topn(spark, d):
    return explore.top_edges(_graph(spark, d), 5)


@query("graph_nodes", f"""{_TOP} SELECT id, sum(w)::BIGINT AS weight, CASE WHEN max(s) = 1 AND max(t) = 1 THEN 'both' WHEN max(s) = 1 THEN 'source' ELSE 'target' END AS role
  FROM (SELECT src AS id, w, 1 AS s, 0 AS t FROM k UNION ALL SELECT dst, w, 0, 1 FROM k) GROUP BY id""")
def graph_nodes(spark, d):
    return explore.nodes(explore.top_edges(_graph(spark, d), 5))


@query("node_neighbourhood", f"SELECT * FROM ({_EDGES}) WHERE src = (SELECT min(n_name) FROM nation) OR dst = (SELECT min(n_name) FROM nation)")
def node_neighbourhood(spark, d):
    first = table(spark, d, "nation").agg(F.min("n_name")).first()[0]
    return explore.neighbourhood(_graph(spark, d), first)


@query("crosstab_topn", "SELECT o_orderpriority, count(*) AS value FROM orders GROUP BY 1 ORDER BY value DESC, 1 LIMIT 3")
def crosstab_topn(spark, d):
    return explore.crosstab(table(spark, d, "orders"), "o_orderpriority", F.count(F.lit(1)), 3)


@query("crosstab_by_date", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS value FROM orders GROUP BY 1 ORDER BY 1 DESC LIMIT 12")
def crosstab_by_date(spark, d):
    rows = table(spark, d, "orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    return explore.crosstab(rows, "month", F.count(F.lit(1)), 12, by_date=True)


@query("crosstab_split8", """WITH r AS (SELECT year(o_orderdate)::VARCHAR AS y, o_orderpriority AS p FROM orders), t AS (SELECT p FROM r GROUP BY p ORDER BY count(*) DESC, p LIMIT 8)
  SELECT y, p, count(r2.p) AS value FROM (SELECT DISTINCT y FROM r) CROSS JOIN t LEFT JOIN r r2 USING (y, p) GROUP BY y, p""")
def crosstab_split8(spark, d):
    rows = table(spark, d, "orders").select(F.year("o_orderdate").cast("string").alias("y"), F.col("o_orderpriority").alias("p"))
    return explore.split_series(rows, "y", "p", F.count(F.lit(1)))


@query("excluded_total", "SELECT count(*) AS excluded FROM orders WHERE substr(o_orderpriority, 1, 1) NOT IN ('1', '2')")
def excluded_total(spark, d):
    rows = table(spark, d, "orders").withColumn("p", F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2"), F.col("o_orderpriority")).otherwise("Undetermined"))
    return explore.excluded(rows, "p", F.count(F.lit(1)))


@query("dim_day_month_year", "SELECT strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m') AS month, year(ts)::INT AS year, count(*) AS n FROM events GROUP BY ALL")
def dim_day_month_year(spark, d):
    return table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day"), F.date_format("ts", "yyyy-MM").alias("month"), F.year("ts").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query("media_card", """SELECT user_id, count(*) AS n, round(coalesce(avg(CASE WHEN value >= 1 THEN floor(value) END), 0), 6) AS mean_interest, arg_max(event_id, (ts, event_id)) AS latest
  FROM events GROUP BY user_id""")
def media_card(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.coalesce(F.avg(F.when(F.col("value") >= 1, F.floor("value"))), F.lit(0.0)), 6).alias("mean_interest"), F.max_by("event_id", F.struct("ts", "event_id")).alias("latest")
    )


@query("page_slice", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def page_slice(spark, d):
    return explore.page(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.col("o_orderkey")], 2, 50)


@query("table_sort_nulls", "SELECT o_orderkey, nullif(o_orderstatus, 'O') AS status FROM orders ORDER BY status ASC NULLS FIRST, o_orderkey")
def table_sort_nulls(spark, d):
    return explore.sort_table(table(spark, d, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("O")).alias("status")), "status", False, "o_orderkey")


@query("faceted_filter", """SELECT event_id, event_type, user_id FROM events WHERE event_type IN ('click', 'view', 'purchase') AND ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'
  AND contains(lower(concat_ws(' ', event_type, props)), 'k')""")
def faceted_filter(spark, d):
    chosen = explore.Selection({"event_type": ("click", "view", "purchase")}, ("ts", "2024-01-05", "2024-01-12"), ("K", ("event_type", "props")))
    return chosen.apply(table(spark, d, "events")).select("event_id", "event_type", "user_id")


@query("window_days", "SELECT ts::DATE AS day, count(*) AS n FROM events WHERE ts::DATE BETWEEN DATE '2024-01-09' AND DATE '2024-01-16' GROUP BY 1")
def window_days(spark, d):
    rows = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    return rows.filter(dates.site_window(F.col("day"), F.lit("2024-01-15").cast("date"))).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


@query("dedup_first_wins", "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1")
def dedup_first_wins(spark, d):
    return merge.dedup_first(table(spark, d, "documents"), "text", [F.col("doc_id")]).select("doc_id", "source")


@query("dedup_blank_exempt", """WITH r AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN '' ELSE user_id || '-' || event_type END AS link FROM events)
  SELECT * FROM r WHERE link = '' UNION ALL (SELECT * FROM r WHERE link <> '' QUALIFY row_number() OVER (PARTITION BY link ORDER BY event_id) = 1)""")
def dedup_blank_exempt(spark, d):
    rows = table(spark, d, "events").select("event_id", F.when(F.col("user_id") % 3 == 0, "").otherwise(F.concat_ws("-", F.col("user_id").cast("string"), "event_type")).alias("link"))
    return merge.dedup_first(rows, "link", [F.col("event_id")], blank_exempt=True)


@query("anti_seen_links", "SELECT page_id, sha1(url) AS hash FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0) QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1")
def anti_seen_links(spark, d):
    pages = table(spark, d, "pages")
    seen = pages.filter("page_id % 3 = 0").select(text.link_hash(F.col("url")).alias("hash"))
    return merge.unseen(pages, seen, "url", [F.col("page_id")]).select("page_id", "hash")


@query("link_hash", "SELECT page_id, sha1(url) AS hash FROM pages")
def link_hash(spark, d):
    return table(spark, d, "pages").select("page_id", text.link_hash(F.col("url")).alias("hash"))


@query("merge_late_partition", "SELECT event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id % 2, event_id) = 1")
def merge_late_partition(spark, d):
    rows = table(spark, d, "events").withColumn("link", F.concat_ws("|", F.col("user_id").cast("string"), "event_type"))
    return merge.merge(rows.filter("event_id % 2 = 0"), rows.filter("event_id % 2 = 1"), "link", [F.col("event_id")]).select("event_id", "event_type")


@query("changed_days", "SELECT ts::DATE AS day, count(*) FILTER (WHERE event_id % 100 <> 7) = 0 AS emptied FROM events GROUP BY 1 HAVING count(*) FILTER (WHERE event_id % 100 = 7) > 0")
def changed_days(spark, d):
    rows = table(spark, d, "events").withColumn("day", F.col("ts").cast("date"))
    return merge.changed_days(rows, rows.filter("event_id % 100 <> 7"), "day")


@query("partition_key", "SELECT event_id, nullif(regexp_extract(CASE WHEN event_id % 5 = 0 THEN 'undated' ELSE strftime(ts, '%Y-%m-%d %H:%M') END, '^(\\d{4}-\\d{2}-\\d{2})', 1), '') AS day FROM events")
def partition_key(spark, d):
    stamp = F.when(F.col("event_id") % 5 == 0, "undated").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm"))
    return table(spark, d, "events").select("event_id", dates.partition_key(stamp).alias("day"))


@query("norm_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 6 IN (2, 4) THEN strftime(o_orderdate, '%Y-%m-%d 00:00') ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M') END AS date FROM orders")
def norm_date(spark, d):
    at, k = F.col("o_orderdate"), F.col("o_orderkey") % 6
    written = (
        F.when(k == 0, F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(k == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'-05:00'"))
        .when(k == 2, F.date_format(at, "dd/MM/yyyy"))
        .when(k == 3, F.date_format(at, "yyyy/MM/dd HH:mm"))
        .when(k == 4, F.date_format(at, "MMMM d, yyyy"))
        .otherwise(F.date_format(at, "yyyy-MM-dd HH:mm"))
    )
    return table(spark, d, "orders").select("o_orderkey", dates.norm_date(written).alias("date"))


WORDS = [("north", [("the", 1), ("heat", 2), ("ties", 1)]), ("south", [("la", 1), ("les", 2), ("la", 1)]), ("east", [("die", 2), ("der", 1), ("und", 1)])]


def _pattern(word: str) -> str:
    return f"(^|[^\\p{{L}}\\p{{N}}_''’]){word}($|[^\\p{{L}}\\p{{N}}_])"


_HITS = f"WITH normed AS (SELECT doc_id, {norm_sql('text')} AS t FROM documents) " + " UNION ALL ".join(
    f"SELECT doc_id, {i} AS kw_id, '{c}' AS class, {o} AS ord, {w} AS weight, strlen(regexp_extract(t, '^((?s:.*?)){_pattern(k)}', 1)) AS pos FROM normed WHERE regexp_matches(t, '{_pattern(k)}')"
    for i, (c, o, k, w) in enumerate((c, o, k, w) for o, (c, ws) in enumerate(WORDS) for k, w in ws)
)


def _hits(spark, d):
    docs = table(spark, d, "documents").select("doc_id", text.norm(F.col("text")).alias("norm_text"))
    return matching.keyword_hits(docs, matching.dictionary(WORDS), key="doc_id")


@query("kw_hits", f"SELECT doc_id, kw_id, class, weight FROM ({_HITS})")
def kw_hits(spark, d):
    return _hits(spark, d).select("doc_id", "kw_id", "class", "weight")


_SCORES = f"(SELECT doc_id, class, ord, sum(weight) AS score, min(pos) AS pos FROM ({_HITS}) GROUP BY ALL)"


@query("kw_score_top1", f"SELECT doc_id, class, score::BIGINT AS score FROM {_SCORES} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos, ord) = 1")
def kw_score_top1(spark, d):
    return matching.top_class(matching.class_scores(_hits(spark, d), "doc_id"), "doc_id")


@query("naval_score", f"SELECT doc_id, least(sum(weight), 5)::BIGINT AS score FROM ({_HITS}) GROUP BY doc_id")
def naval_score(spark, d):
    return matching.total_score(_hits(spark, d), "doc_id", cap=5).withColumn("score", F.col("score").cast("long"))


@query("zone_best", f"SELECT doc_id, class AS zone FROM (SELECT doc_id, class, ord, count(*) AS n FROM ({_HITS}) GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, ord) = 1")
def zone_best(spark, d):
    return matching.best_zone(_hits(spark, d), "doc_id")


RULES = ["Wide: @pays + heat", "Names: the|la + !ties + @pays|und", "Rest: der"]


def _m(words: str) -> str:
    return f"regexp_matches(t, '{_pattern('(' + words + ')')}')"


_COUNTRIES = "(" + " + ".join(f"CASE WHEN {_m(w)} THEN 1 ELSE 0 END" for w in ("heat", "les", "die")) + ")"


@query("rule_first_match", f"""SELECT doc_id, CASE WHEN {_COUNTRIES} >= 1 AND {_m('heat')} THEN 'Wide' WHEN {_m('the|la')} AND NOT {_m('ties')} AND ({_m('und')} OR {_COUNTRIES} >= 1) THEN 'Names'
  WHEN {_m('der')} THEN 'Rest' END AS theme FROM (SELECT doc_id, {norm_sql('text')} AS t FROM documents)""")
def rule_first_match(spark, d):
    docs = table(spark, d, "documents").select("doc_id", text.norm(F.col("text")).alias("norm_text"))
    counted = docs.withColumn("countries", matching.countries_in(matching.hits_in(F.col("norm_text"), matching.dictionary(WORDS))))
    rules = [r for r in map(matching.parse_rule, RULES) if r]
    return counted.select("doc_id", matching.first_rule(F.col("norm_text"), F.col("countries"), rules).alias("theme"))


@query("country_confidence", f"""WITH b AS (SELECT doc_id, class, score FROM {_SCORES} QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, pos, ord) = 1)
  SELECT d.doc_id, CASE WHEN score >= 2 THEN class WHEN lang = 'es' THEN source ELSE 'Undetermined' END AS country,
  CASE WHEN score >= 3 THEN 'high' WHEN score = 2 THEN 'medium' WHEN lang = 'es' THEN 'media-default' ELSE 'none' END AS confidence FROM documents d LEFT JOIN b USING (doc_id)""")
def country_confidence(spark, d):
    docs = table(spark, d, "documents")
    top = matching.top_class(matching.class_scores(_hits(spark, d), "doc_id"), "doc_id")
    made = matching.country_confidence(F.col("score"), F.col("class"), F.col("source"), F.when(F.col("lang") == "es", "Politique").otherwise("Sport"))
    return docs.join(top, "doc_id", "left").withColumn("c", made).select("doc_id", F.col("c.country").alias("country"), F.col("c.confidence").alias("confidence"))


@query("alias_longest_prefix", """SELECT p_partkey, CASE WHEN p_name = 'red' THEN 'Red' WHEN p_name = 'red ink' OR starts_with(p_name, 'red ink ') THEN 'Red Ink' WHEN starts_with(p_name, 'red ') THEN 'Reds'
  WHEN starts_with(p_name, 'blue ') OR p_name = 'blue' THEN 'Blue' ELSE p_name END AS canonical FROM part""")
def alias_longest_prefix(spark, d):
    names = media.patterns(spark, [("red", "Red"), ("red *", "Reds"), ("red ink *", "Red Ink"), ("blue *", "Blue")])
    return media.canonical_names(table(spark, d, "part"), names, "p_name").select("p_partkey", "canonical")


@query("ban_anti", "SELECT doc_id FROM documents WHERE source NOT IN ('src1', 'src7')")
def ban_anti(spark, d):
    bans = media.patterns(spark, [("src1", ""), ("src7 *", "")])
    return media.without_banned(table(spark, d, "documents"), bans, "source").select("doc_id")


def _stop(code: str) -> str:
    listed = ", ".join(f"'{w}'" for w in language.STOP_WORDS[code])
    return f"len(list_filter(regexp_extract_all(lower(text), '{language.TOKEN.replace(chr(39), chr(39) * 2)}'), lambda x: x IN ({listed})))"


_CODES = list(language.STOP_WORDS)


@query("lang_stopwords", f"SELECT doc_id, {', '.join(f'{_stop(c)}::INT AS n_{c}' for c in _CODES)} FROM documents")
def lang_stopwords(spark, d):
    counted = table(spark, d, "documents").select("doc_id", language.stop_word_struct(F.col("text")).alias("n"))
    return counted.select("doc_id", *[F.col(f"n.{c}").alias(f"n_{c}") for c in language.STOP_WORDS])


_OTHER = [c for c in _CODES if c != "en"]
_COUNTED = ", ".join(f"{'CASE WHEN regexp_matches(text, ' + repr(language.HR_LETTERS) + ') THEN ' + _stop(c) + ' ELSE 0 END' if c == 'hr' else _stop(c)} AS n_{c}" for c in _CODES)
_BEST = f"greatest({', '.join('n_' + c for c in _OTHER)})"
_SCRIPT = " ".join(f"WHEN regexp_matches(text, '[{p}]') THEN '{c}'" for c, p in (("el", "\\x{0370}-\\x{03FF}\\x{1F00}-\\x{1FFF}"), ("ru", "\\x{0400}-\\x{04FF}"), ("ar", "\\x{0600}-\\x{06FF}"), ("he", "\\x{0590}-\\x{05FF}"), ("hi", "\\x{0900}-\\x{097F}"), ("th", "\\x{0E00}-\\x{0E7F}"), ("ko", "\\x{AC00}-\\x{D7AF}"), ("ja", "\\x{3040}-\\x{30FF}"), ("zh", "\\x{4E00}-\\x{9FFF}"))) + " WHEN len(regexp_extract_all(text, '[\\x{1EA0}-\\x{1EF9}ĂăĐđƠơƯư]')) >= 2 THEN 'vi'"
_DETECT = f"""(SELECT doc_id, lang, CASE {_SCRIPT} WHEN {_BEST} >= 2 AND {_BEST} > n_en THEN CASE {' '.join(f"WHEN n_{c} = {_BEST} THEN '{c}'" for c in _OTHER)} END WHEN n_en >= 1 THEN 'en'
  WHEN regexp_matches(text, '[\\x{{0100}}-\\x{{024F}}]') OR len(regexp_extract_all(text, '[à-ÿÀ-ß]')) >= 3 THEN 'xx' ELSE 'en' END AS detected
  FROM (SELECT doc_id, lang, text, {_COUNTED} FROM documents))"""


def _detected(spark, d):
    return table(spark, d, "documents").withColumn("detected", language.detect(F.col("text")))


@query("lang_detect", f"SELECT doc_id, detected FROM {_DETECT}")
def lang_detect(spark, d):
    return _detected(spark, d).select("doc_id", "detected")


@query("lang_eval_recall", f"SELECT lang, count(*) AS support, count(*) FILTER (WHERE lang = detected) AS hits, count(*) FILTER (WHERE lang = detected) / count(*) AS recall FROM {_DETECT} GROUP BY lang HAVING count(*) >= 20")
def lang_eval_recall(spark, d):
    return explore.recall(_detected(spark, d), "lang", "detected")


@query("lang_eval_confusion", f"SELECT lang, detected, count(*) AS n FROM {_DETECT} WHERE lang <> detected GROUP BY ALL ORDER BY n DESC, lang, detected LIMIT 8")
def lang_eval_confusion(spark, d):
    return explore.confusions(_detected(spark, d), "lang", "detected")


_PLANTED = "text || CASE doc_id % 12 WHEN 0 THEN ' мир' WHEN 1 THEN ' 日本の' WHEN 2 THEN ' 中国' WHEN 4 THEN ' ἀρχή' WHEN 5 THEN ' Ạ ả' WHEN 6 THEN ' 한국' WHEN 8 THEN ' سلام мир' ELSE '' END"


@query("lang_script", f"SELECT doc_id, CASE {_SCRIPT} END AS script FROM (SELECT doc_id, {_PLANTED} AS text FROM documents)")
def lang_script(spark, d):
    k = F.col("doc_id") % 12
    more = F.when(k == 0, " мир").when(k == 1, " 日本の").when(k == 2, " 中国").when(k == 4, " ἀρχή").when(k == 5, " Ạ ả").when(k == 6, " 한국").when(k == 8, " سلام мир").otherwise("")
    return table(spark, d, "documents").select("doc_id", language.script(F.concat("text", more)).alias("script"))


#: A fragment of L characters five times in a row is a run of 4 L places whose character comes again L places on.
_LOOPS = " OR ".join(f"contains(array_to_string(list_transform(range(1, len(c) - {n} + 1), lambda j: CASE WHEN c[j] = c[j + {n}] AND c[j] <> chr(10) THEN '1' ELSE '0' END), ''), repeat('1', {4 * n}))" for n in range(2, 21))
_BROKEN = f"""SELECT doc_id, CASE WHEN t = '' THEN true WHEN list_max(list_transform(regexp_split_to_array(t, '\\s+'), lambda w: length(w))) > 45 THEN true
  WHEN length(t) > 200 AND length(t) > 3 * length(o) + 40 THEN true WHEN length(t) > 60 AND len(list_distinct(c)) / length(t) < 0.15 THEN true ELSE ({_LOOPS}) END AS broken
  FROM (SELECT *, string_split(t, '') AS c FROM (SELECT doc_id, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t, regexp_replace(source, '^\\s+|\\s+$', '', 'g') AS o FROM documents))"""


@query("broken_text", _BROKEN)
def broken_text(spark, d):
    return table(spark, d, "documents").select("doc_id", language.broken_translation(F.col("text"), F.col("source")).alias("broken"))


_SHORT = _BROKEN.replace("SELECT doc_id, regexp_replace(text,", "SELECT p_partkey AS doc_id, regexp_replace(made,").replace("regexp_replace(source,", "regexp_replace(p_type,").replace(
    "FROM documents", "FROM (SELECT p_partkey, p_type, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN repeat(substr(p_name, 1, 4), 5) WHEN 2 THEN repeat('x y z w ', 9) || p_name WHEN 3 THEN replace(p_name || p_type || p_name || p_type || p_name, ' ', '') ELSE ' ' END AS made FROM part)"
)


@query("broken_short", _SHORT)
def broken_short(spark, d):
    k, name, kind = F.col("p_partkey") % 5, F.col("p_name"), F.col("p_type")
    made = F.when(k == 0, name).when(k == 1, F.repeat(F.substring(name, 1, 4), 5)).when(k == 2, F.concat(F.repeat(F.lit("x y z w "), 9), name)).when(k == 3, F.replace(F.concat(name, kind, name, kind, name), F.lit(" "), F.lit(""))).otherwise(" ")
    return table(spark, d, "part").select(F.col("p_partkey").alias("doc_id"), language.broken_translation(made, kind).alias("broken"))


@query("reliability_scores", """SELECT c_custkey, round(0.6 / fi, 4) AS reliability2, round(nv * 0.4 / 40, 4) AS marine, round(40.0 / fi, 4) AS reliability_score, round(round(0.6 / fi, 4) + round(nv * 0.4 / 40, 4), 4) AS composite
  FROM (SELECT c_custkey, coalesce(CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 1 + (c_custkey % 9) / 2.0 END, 4.5)::DOUBLE AS fi, (c_custkey % 60)::DOUBLE AS nv FROM customer)""")
def reliability_scores(spark, d):
    key = F.col("c_custkey")
    card = F.when(key % 9 == 0, F.lit("")).otherwise((1 + (key % 9) / 2.0).cast("string"))
    made = scores.score_columns(scores.reliability_index(card), (key % 60).cast("double"))
    return table(spark, d, "customer").select("c_custkey", *[c.alias(n) for n, c in made.items()])


@query("naval_bucket", "SELECT event_id, CASE WHEN coalesce(value, 0) <= 0 THEN 0 ELSE least(ceil(value / 10), 6) END::INT AS bucket FROM events")
def naval_bucket(spark, d):
    return table(spark, d, "events").select("event_id", scores.interest_bucket(F.col("value")).alias("bucket"))


@query("site_record", """SELECT doc_id AS k, source AS m, coalesce(nullif(lang, ''), 'en') AS lg, coalesce(quality, 0)::INT AS nv, CASE WHEN length(text) > 22 THEN substr(text, 1, 21) || '…' ELSE text END AS t
  FROM documents LEFT JOIN (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id) USING (doc_id)""")
def site_record(spark, d):
    labels = table(spark, d, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = table(spark, d, "documents").join(labels, "doc_id", "left")
    return rows.select(F.col("doc_id").alias("k"), F.col("source").alias("m"), F.coalesce(F.nullif("lang", F.lit("")), F.lit("en")).alias("lg"), F.coalesce("quality", F.lit(0)).cast("int").alias("nv"), text.short_label(F.col("text")).alias("t"))


@query("day_totals", "SELECT ts::DATE AS day, count(*) AS n FROM events GROUP BY ROLLUP (ts::DATE)")
def day_totals(spark, d):
    return table(spark, d, "events").withColumn("day", F.col("ts").cast("date")).rollup("day").agg(F.count(F.lit(1)).alias("n"))


@query("sql_top_by_country", f"SELECT n_name, count(*) AS n {_BY_NATION} GROUP BY 1 ORDER BY n DESC, n_name LIMIT 20")
def sql_top_by_country(spark, d):
    names = {t: table(spark, d, t) for t in ("orders", "customer", "nation")}
    return spark.sql("SELECT n_name, count(*) AS n FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY n DESC, n_name LIMIT 20", **names)


#: Translations of texts that are broken need the SQL of that test.
for _name in ("ensure_english", "translation_counts"):
    ORACLE_SQL[_name] = ORACLE_SQL[_name].replace("{0}", _BROKEN.replace("regexp_replace(text,", "regexp_replace('EN ' || text,").replace("regexp_replace(source,", "regexp_replace(text,"))
