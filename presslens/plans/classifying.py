"""Queries on keywords, languages, translation and the row classifier."""

from __future__ import annotations

from pyspark.sql import functions as F

from presslens.functions import dates, language, scores, text
from presslens.functions.text import strip
from presslens.operators import classify, explore, matching, media, rescan, translation
from presslens.plans.base import ORACLE_SQL, norm_sql, query, table  # noqa: F401
from presslens.sources import dictionaries, gold

THEMES = [("Sport", [("the", 1), ("heat", 2), ("ties", 1)]), ("Tech", [("la", 1), ("les", 2), ("la", 1)]), ("Guerre/violence", [("die", 2), ("ist", 1)])]
COUNTRIES = [("Aland", [("and", 1), ("of", 2)]), ("Borduria", [("les", 2), ("las", 2), ("que", 1)]), ("Syldavia", [("die", 2), ("und", 1), ("peru", 2)])]
NAVAL = [("20", [("heat", 20)]), ("5", [("of", 5), ("la", 5), ("die", 5)]), ("2", [("the", 2)])]
ZONES = [("North", [("the", 1), ("und", 1)]), ("South", [("la", 1), ("and", 1), ("of", 1)])]
RULES = ["Politics: @pays + @pays", "Markets: the|la + !and + @pays|ist"]
REGIONS = {"Aland": "Nordics", "Borduria": "Balkans"}
CARDS = """media;pays_siege;theme_media;note;indice_fiabilite;notation
src0;Lost;Tech;1;1;a
src0;Aland;Local/Régional;4;2.5;b
src1;;Tech;;;
 SRC2 ;Borduria;Politique;3;x;C
src4.gov;Syldavia;Sports;;3.5;d
src5;Aland;Sports;2;1;
"""
#: The same cards in SQL, one per outlet.
CARDS_SQL = """(VALUES ('src0', 'Aland', 'Local/Régional', '4', '2.5', 'b'), ('src1', '', 'Tech', '', '', ''), ('src2', 'Borduria', 'Politique', '3', 'x', 'C'),
  ('src4.gov', 'Syldavia', 'Sports', '', '3.5', 'd'), ('src5', 'Aland', 'Sports', '2', '1', '')) AS cards(media, pays_siege, theme_media, note, indice_fiabilite, notation)"""


def pattern_sql(word: str) -> str:
    return f"(^|[^\\p{{L}}\\p{{N}}_''’]){word}($|[^\\p{{L}}\\p{{N}}_])"


def has(word: str, t: str = "t") -> str:
    return f"regexp_matches({t}, '{pattern_sql(word)}')"


def top_sql(entries) -> str:
    """(score, -pos, -ord, class) structs of the classes of a text ``t``, as a list without nulls."""
    parts = []
    for o, (name, words) in enumerate(entries):
        score = " + ".join(f"CASE WHEN {has(k)} THEN {w} ELSE 0 END" for k, w in words)
        place = "least(" + ", ".join(f"CASE WHEN {has(k)} THEN strlen(regexp_extract(t, '^((?s:.*?)){pattern_sql(k)}', 1)) ELSE 1000000000 END" for k, _ in words) + ", 1000000000)"
        parts.append(f"{{'score': {score}, 'early': -({place}), 'first': -{o}, 'name': '{name}'}}")
    return f"list_max(list_filter([{', '.join(parts)}], lambda x: x.score > 0))"


def total_sql(entries) -> str:
    return " + ".join(f"CASE WHEN {has(k)} THEN {w} ELSE 0 END" for _, words in entries for k, w in words)


def zone_sql(entries) -> str:
    parts = [f"{{'n': {' + '.join(f'CASE WHEN {has(k)} THEN 1 ELSE 0 END' for k, _ in words)}, 'first': -{o}, 'name': '{name}'}}" for o, (name, words) in enumerate(entries)]
    return f"coalesce((list_max(list_filter([{', '.join(parts)}], lambda x: x.n > 0))).name, '')"


STRONG = " + ".join(f"CASE WHEN {' OR '.join(has(k) for k, w in words if w == 2)} THEN 1 ELSE 0 END" for _, words in COUNTRIES)
RULE = f"CASE WHEN {STRONG} >= 2 THEN 'Politics' WHEN {has('(the|la)')} AND NOT {has('and')} AND ({has('ist')} OR {STRONG} >= 1) THEN 'Markets' END"


def words() -> classify.Dictionaries:
    rules = tuple(r for r in map(matching.parse_rule, RULES) if r)
    return classify.Dictionaries(*[matching.dictionary(e) for e in (THEMES, COUNTRIES, NAVAL, ZONES)], rules, REGIONS)


_ARTICLES = "(SELECT doc_id, text || CASE doc_id % 11 WHEN 0 THEN ' Perú' ELSE '' END AS titre, CASE doc_id % 10 WHEN 0 THEN source || '.GOV' ELSE source END AS media FROM documents)"


def _articles(spark, d):
    k = F.col("doc_id")
    return table(spark, d, "documents").select("doc_id", F.concat("text", F.when(k % 11 == 0, " Perú").otherwise("")).alias("titre"), F.when(k % 10 == 0, F.concat("source", F.lit(".GOV"))).otherwise(F.col("source")).alias("nom_du_media"))


_CLASSIFIED = f"""(SELECT doc_id, titre, a.media AS nom_du_media, coalesce(pays_siege, 'Undetermined') AS country_headquarters,
  CASE WHEN c.score >= 2 THEN c.name WHEN CASE WHEN contains(lower(a.media), '.gov') THEN 'Politique' ELSE coalesce(theme_media, '') END IN ('Local/Régional', 'Politique') AND coalesce(pays_siege, '') <> '' THEN pays_siege ELSE 'Undetermined' END AS country_article,
  CASE WHEN c.score >= 3 THEN 'high' WHEN c.score = 2 THEN 'medium' WHEN CASE WHEN contains(lower(a.media), '.gov') THEN 'Politique' ELSE coalesce(theme_media, '') END IN ('Local/Régional', 'Politique') AND coalesce(pays_siege, '') <> '' THEN 'media-default' ELSE 'none' END AS "confiance_pays_article",
  coalesce(r, h.name, CASE theme_media WHEN 'Tech' THEN 'Tech' WHEN 'Business' THEN 'Markets and business' WHEN 'Sports' THEN 'Sports' ELSE 'Non déterminé' END) AS sujet_article,
  coalesce(theme_media, '') AS sujet_media, coalesce(note, '') AS official_rating, coalesce(TRY_CAST(nullif(indice_fiabilite, '') AS DOUBLE), 4.5::DOUBLE) AS fi, upper(trim(coalesce(nullif(notation, ''), 'F'))) AS notation, nv, z AS region_maritime
  FROM (SELECT doc_id, titre, media, {top_sql(THEMES)} AS h, {top_sql(COUNTRIES)} AS c, {RULE} AS r, ({total_sql(NAVAL)})::DOUBLE AS nv, {zone_sql(ZONES)} AS z FROM (SELECT *, {norm_sql('titre')} AS t FROM {_ARTICLES})) a LEFT JOIN {CARDS_SQL} ON lower(a.media) = cards.media)"""


@query("classify_rows", f"""SELECT doc_id, country_headquarters, country_article, CASE country_article WHEN 'Aland' THEN 'Nordics' WHEN 'Borduria' THEN 'Balkans' ELSE 'Undetermined' END AS region, sujet_article, sujet_media,
  official_rating, fi AS indice_fiabilite, notation, round(40.0::DOUBLE / fi, 4) AS "fiabilité_calcul", nv AS indice_interet_naval, region_maritime, round(0.6::DOUBLE / fi, 4) AS "fiabilité2", round(nv * 0.4::DOUBLE / 40, 4) AS "intérêt marine calcul",
  round(round(0.6::DOUBLE / fi, 4) + round(nv * 0.4::DOUBLE / 40, 4), 4) AS "intérêt_par_fiabilité", confiance_pays_article FROM {_CLASSIFIED}""")
def classify_rows(spark, d):
    made = classify.classify_rows(_articles(spark, d), words(), dictionaries.cards(spark, CARDS))
    return made.select("doc_id", *[F.col(f"`{c}`") for c in classify.MADE])


@query("kw_large_dictionary", f"SELECT doc_id, list_max(list_filter([{', '.join(f'CASE WHEN {has(k)} THEN {i} ELSE -1 END' for i, (k, _) in enumerate(kw for _, ws in COUNTRIES for kw in ws))}], lambda x: x >= 0)) AS last_kw FROM (SELECT doc_id, {norm_sql('titre')} AS t FROM {_ARTICLES}) WHERE last_kw IS NOT NULL")
def kw_large_dictionary(spark, d):
    docs = _articles(spark, d).select("doc_id", text.norm(F.col("titre")).alias("norm_text"))
    hits = matching.keyword_hits(docs, matching.dictionary(COUNTRIES), key="doc_id", literal_bytes=0)
    return hits.groupBy("doc_id").agg(F.max("kw_id").alias("last_kw"))


@query("norm_text", f"SELECT doc_id, md5({norm_sql('titre')}) AS normal FROM {_ARTICLES}")
def norm_text(spark, d):
    return _articles(spark, d).select("doc_id", F.md5(text.norm(F.col("titre")).cast("binary")).alias("normal"))


@query("theme_chain", f"""SELECT doc_id, coalesce({RULE}, ({top_sql(THEMES[:1])}).name, CASE lang WHEN 'es' THEN 'Tech' WHEN 'de' THEN 'Guerre/violence' ELSE 'Non déterminé' END) AS theme FROM (SELECT doc_id, lang, {norm_sql('text')} AS t FROM documents)""")
def theme_chain(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", text.norm(F.col("text")).alias("t"))
    w = words()
    found = docs.withColumns({"c": matching.countries_in(matching.hits_in(F.col("t"), w.countries)), "h": matching.top_in(matching.hits_in(F.col("t"), matching.dictionary(THEMES[:1])))["class"]})
    outlet = F.when(F.col("lang") == "es", "Tech").when(F.col("lang") == "de", "Tensions/guerre/violences/géopolitique").otherwise("Unknown")
    return found.select("doc_id", classify.theme_chain(matching.first_rule(F.col("t"), F.col("c"), list(w.rules)), F.col("h"), outlet).alias("theme"))


@query("gov_theme", "SELECT doc_id, CASE WHEN doc_id % 10 = 0 THEN 'Politique' WHEN doc_id % 3 = 0 THEN lang ELSE '' END AS theme FROM documents")
def gov_theme(spark, d):
    k = F.col("doc_id")
    named = table(spark, d, "documents").withColumn("m", F.when(k % 10 == 0, F.concat("source", F.lit(".Gov"))).otherwise(F.col("source")))
    return named.select("doc_id", classify.outlet_theme(F.col("m"), F.when(k % 3 == 0, F.col("lang"))).alias("theme"))


@query("region_lookup", "SELECT c_custkey, CASE n_name WHEN 'FRANCE' THEN 'EU' WHEN 'GERMANY' THEN 'EU' ELSE 'Undetermined' END AS region FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey")
def region_lookup(spark, d):
    nation = table(spark, d, "nation")
    rows = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return classify.with_region(rows, {"FRANCE": "EU", "GERMANY": "EU"}, "n_name").select("c_custkey", "region")


@query("media_cards", f"SELECT doc_id, cards.media, pays_siege, note FROM documents LEFT JOIN {CARDS_SQL} ON lower(source) = cards.media")
def media_cards(spark, d):
    rows = classify.with_cards(table(spark, d, "documents").select("doc_id", "source"), dictionaries.cards(spark, CARDS).withColumn("media_key", F.col("media")), "source")
    return rows.select("doc_id", F.col("_card.media_key").alias("media"), F.col("_card.pays_siege").alias("pays_siege"), F.col("_card.note").alias("note"))


_SPOKEN = "media;langue\n# outlets\nSRC1;DE\nsrc2 ; fr\nsrc2;hr\nbad line\n"


@query("declared_language", "SELECT doc_id, CASE source WHEN 'src1' THEN 'de' WHEN 'src2' THEN 'hr' END AS declared FROM documents")
def declared_language(spark, d):
    spoken = dictionaries.declared(spark, dictionaries.languages(_SPOKEN))
    return dictionaries.with_declared(table(spark, d, "documents").select("doc_id", F.concat(F.lit(" "), F.upper("source")).alias("m")), spoken, "m").select("doc_id", "declared")


@query("lang_declared", """SELECT page_id, CASE page_id % 6 WHEN 0 THEN 'fr' WHEN 1 THEN 'de' WHEN 2 THEN 'hr' WHEN 3 THEN 'en' WHEN 4 THEN 'xx' ELSE 'sv' END AS lang FROM pages""")
def lang_declared(spark, d):
    k = F.col("page_id") % 6
    title = F.when(k == 0, "dans la rue").when(k == 1, "the Berliner").when(k == 2, "kao ali što").when(k == 3, "the end of it").when(k == 4, "Łódź").otherwise("hade mycket the")
    said = F.when(k == 1, "de").when(k == 3, "it").when(k == 0, "de")
    return table(spark, d, "pages").select("page_id", language.detect(title, said).alias("lang"))


@query("lang_vietnamese", "SELECT doc_id, len(regexp_extract_all(t, '[\\x{1EA0}-\\x{1EF9}ĂăĐđƠơƯư]')) >= 2 AS vi FROM (SELECT doc_id, text || CASE doc_id % 4 WHEN 0 THEN 'ẠẢ' WHEN 1 THEN 'Ơ ư' WHEN 2 THEN 'ă' ELSE 'ãâ' END AS t FROM documents)")
def lang_vietnamese(spark, d):
    k = F.col("doc_id") % 4
    more = F.when(k == 0, "ẠẢ").when(k == 1, "Ơ ư").when(k == 2, "ă").otherwise("ãâ")
    return table(spark, d, "documents").select("doc_id", language.vietnamese(F.concat("text", more)).alias("vi"))


_TOKENS = f"regexp_extract_all(lower(text), '{language.TOKEN.replace(chr(39), chr(39) * 2)}')"
_N = {c: f"len(list_filter({_TOKENS}, lambda x: x IN ({', '.join(repr(w) for w in ws)})))" for c, ws in language.STOP_WORDS.items() if c != "hr"}


@query("looks_english", f"""SELECT doc_id, NOT (o >= 2 AND o > n_en OR ext >= 2 OR ext = 1 AND n_en = 0 OR n_en = 0 AND acc >= 3) AS english FROM (SELECT doc_id, {_N['en']} AS n_en, greatest({', '.join(n for c, n in _N.items() if c != 'en')}) AS o,
  len(regexp_extract_all(text, '[\\x{{0100}}-\\x{{024F}}]')) AS ext, len(regexp_extract_all(lower(text), '[à-ÿ]')) AS acc FROM documents)""")
def looks_english(spark, d):
    return table(spark, d, "documents").select("doc_id", language.looks_english(F.col("text")).alias("english"))


def _upper():
    return lambda titles, code: [None if t.startswith("De") else f"{code}: {t.upper()}" for t in titles]


def _broken_model():
    def run(titles, code):
        raise ValueError("no model")

    return run


@query("translate_plugin", "SELECT doc_id, CASE WHEN lang IN ('fr', 'de') AND NOT starts_with(text, 'De') THEN lang || ': ' || upper(text) END AS made, NULL::VARCHAR AS failed FROM (SELECT doc_id, lang, 'T' || doc_id || ' ' || source AS text FROM documents)")
def translate_plugin(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang", F.concat(F.lit("T"), F.col("doc_id").cast("string"), F.lit(" "), "source").alias("t"))
    made = translation.translator(_upper, ("fr", "de"), 32)(docs, "t", "lang").withColumnRenamed("_made", "made")
    return translation.translator(_broken_model)(made, "t", "lang").select("doc_id", "made", F.col("_made").alias("failed"))


_STATES = """(SELECT doc_id, 'Title ' || doc_id || ' ' || source AS titre, CASE doc_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'en' ELSE 'fr' END AS langue, CASE doc_id % 5 WHEN 3 THEN 'dans la rue ' || doc_id WHEN 4 THEN 'Titre' ELSE '' END AS titre_vo FROM documents)"""


def _states(spark, d):
    k, number = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    title = F.when(k == 3, F.repeat(F.lit("ab"), 8)).otherwise(F.concat(F.lit("Title "), number, F.lit(" "), "source"))
    return table(spark, d, "documents").select("doc_id", title.alias("titre"), F.when(k == 0, "").when(k == 1, "en").otherwise("fr").alias("langue"), F.when(k == 3, F.concat(F.lit("dans la rue "), number)).when(k == 4, "Titre").otherwise("").alias("titre_vo"))


@query("translation_counts", """SELECT count(*) FILTER (WHERE lang <> 'en' AND (lang = 'fr' OR trim(text) = '')) AS n_pending, count(*) FILTER (WHERE trim(text) <> '' AND (lang = 'es' OR lang = 'de' AND broken)) AS n_broken FROM documents JOIN ({0}) USING (doc_id)""")
def translation_counts(spark, d):
    """Whole texts as titles: French ones wait, German ones are translated (some of it broken), Spanish ones got a stuck translation."""
    code, said = F.col("lang"), F.col("text")
    title = F.when(code == "de", F.concat(F.lit("EN "), said)).when(code == "es", F.concat(F.repeat(F.lit("ab"), 9), said)).otherwise(said)
    original = F.when(code.isin("de", "es"), said).otherwise("")
    return translation.counts(table(spark, d, "documents").select(title.alias("titre"), original.alias("titre_vo"), code.alias("langue")))


@query("translation_retry", """SELECT doc_id, CASE WHEN doc_id % 5 = 3 THEN 'fr: DANS LA RUE ' || doc_id ELSE 'Title ' || doc_id || ' ' || source END AS titre, CASE doc_id % 5 WHEN 3 THEN 'dans la rue ' || doc_id WHEN 4 THEN 'Titre' ELSE '' END AS titre_vo,
  CASE doc_id % 5 WHEN 3 THEN 'fr' WHEN 4 THEN 'fr' ELSE 'en' END AS langue, doc_id % 5 = 3 AS again FROM documents""")
def translation_retry(spark, d):
    rows = _states(spark, d).withColumn("again", F.lit(False))
    return translation.retry(rows, translation.translator(_upper), lambda r: r.withColumn("again", F.lit(True)))


@query("ensure_english", """SELECT doc_id, CASE lang WHEN 'fr' THEN 'EN ' || text ELSE text END AS title, CASE WHEN lang IN ('fr', 'de') THEN text ELSE '' END AS original, lang AS language FROM (SELECT * FROM documents WHERE text IS NOT NULL AND lang <> 'fr'
  UNION ALL SELECT d.* FROM documents d JOIN ({0}) b USING (doc_id) WHERE d.lang = 'fr' AND NOT broken) UNION ALL SELECT doc_id, text, text, lang FROM documents d JOIN ({0}) b USING (doc_id) WHERE d.lang = 'fr' AND broken""")
def ensure_english(spark, d):
    """Whole texts as titles: English stays, French is translated (some of it broken), German gets a stuck translation, Spanish waits."""
    docs = table(spark, d, "documents").filter("text IS NOT NULL")
    said = F.when(F.col("lang") == "fr", F.concat(F.lit("EN "), "text")).when(F.col("lang") == "de", F.concat(F.repeat(F.lit("ab"), 9), "text"))
    return docs.select("doc_id", language.ensure_english(F.col("text"), said, F.col("lang")).alias("m")).select("doc_id", "m.*")


def _counted():
    """A model that says how many titles its batch has, and turns them about."""
    return lambda titles, code: [f"{len(titles)} {t[::-1]}" for t in titles]


@query("translate_batches", "SELECT lang, count(*) AS n, true AS small, true AS turned FROM documents WHERE lang IN ('fr', 'de') AND text <> '' GROUP BY lang")
def translate_batches(spark, d):
    """No batch has more than 16 titles, and every title comes back to its own row."""
    docs = table(spark, d, "documents").filter("lang IN ('fr', 'de') AND text <> ''").select("doc_id", "lang", "text")
    made = translation.translator(_counted, ("fr", "de"), 16)(docs, "text", "lang").withColumn("size", F.split("_made", " ")[0].cast("int"))
    turned = strip(F.concat(F.col("size").cast("string"), F.lit(" "), F.reverse("text"))) == F.col("_made")
    return made.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), ((F.max("size") <= 16) & (F.min("size") >= 1)).alias("small"), F.every(turned).alias("turned"))


@query("batch_counters", f"""SELECT count(*) AS n_read, count(*) FILTER (WHERE nom_du_media IN ('src1', 'src7')) AS n_banned, count(*) FILTER (WHERE nom_du_media NOT IN ('src1', 'src7') AND doc_id % 3 = 0) AS n_translated,
  count(*) FILTER (WHERE nom_du_media NOT IN ('src1', 'src7') AND sujet_article <> 'Non déterminé') AS n_theme, count(*) FILTER (WHERE nom_du_media NOT IN ('src1', 'src7') AND country_article <> 'Undetermined') AS n_country FROM {_CLASSIFIED}""")
def batch_counters(spark, d):
    made = classify.classify_rows(_articles(spark, d), words(), dictionaries.cards(spark, CARDS))
    return classify.batch_counters(made.withColumn("titre_vo", F.when(F.col("doc_id") % 3 == 0, "x").otherwise("")), F.col("nom_du_media").isin("src1", "src7"))


_BEFORE = f"""(SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'old ' || source WHEN 1 THEN 'spam daily' ELSE source END AS media, titre, CASE doc_id % 3 WHEN 0 THEN '08/07/2026' WHEN 1 THEN '2026-07-08 10:30' ELSE 'x' END AS time_stamp,
  CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN 'None' ELSE 'Freedonia' END AS hq, CASE doc_id % 5 WHEN 0 THEN '' ELSE 'Old theme' END AS theme, CASE doc_id % 7 WHEN 0 THEN ' ' ELSE '9' END AS note, (doc_id % 2 * 4.5)::DOUBLE AS fi, (doc_id % 3 * 2)::DOUBLE AS nv FROM (SELECT doc_id, titre, source FROM {_ARTICLES} JOIN documents USING (doc_id)))"""
_RESCANNED = f"""(SELECT b.doc_id, m AS nom_du_media, m <> b.media AS merged, banned, CASE doc_id % 3 WHEN 0 THEN '2026-07-08 00:00' WHEN 1 THEN '2026-07-08 10:30' ELSE '' END AS time_stamp, doc_id % 3 <> 1 AS dated,
  CASE WHEN m <> b.media THEN coalesce(nullif(pays_siege, ''), hq) ELSE hq END AS hq1, nullif(pays_siege, '') AS seat, CASE WHEN m <> b.media OR theme = '' THEN coalesce(nullif(theme_media, ''), theme) ELSE theme END AS sujet_media,
  CASE WHEN m <> b.media OR trim(b.note) = '' THEN coalesce(nullif(cards.note, ''), b.note) ELSE b.note END AS official_rating, upper(trim(coalesce(nullif(notation, ''), 'F'))) AS notation, coalesce(TRY_CAST(nullif(indice_fiabilite, '') AS DOUBLE), 4.5::DOUBLE) AS fi1, b.fi, b.nv, nv1, z AS region_maritime
  FROM (SELECT *, CASE WHEN doc_id % 6 = 0 THEN source ELSE media END AS m, media = 'spam daily' AS banned FROM (SELECT x.*, source, ({total_sql(NAVAL)})::DOUBLE AS nv1, {zone_sql(ZONES)} AS z FROM (SELECT *, {norm_sql('titre')} AS t FROM {_BEFORE}) x JOIN documents USING (doc_id))) b LEFT JOIN {CARDS_SQL} ON lower(m) = cards.media)"""
_STALE = "(fi <> fi1 OR round(nv * 0.01::DOUBLE, 4) <> round(nv1 * 0.4::DOUBLE / 40, 4))"


def _rescanned(spark, d):
    k = F.col("doc_id")
    docs = _articles(spark, d).drop("nom_du_media").join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    nv = (k % 3 * 2).cast("double")
    rows = docs.select(
        "doc_id", F.when(k % 6 == 0, F.concat(F.lit("old "), "source")).when(k % 6 == 1, "spam daily").otherwise(F.col("source")).alias("nom_du_media"), "titre",
        F.when(k % 3 == 0, "08/07/2026").when(k % 3 == 1, "2026-07-08 10:30").otherwise("x").alias("time_stamp"), F.when(k % 4 == 0, "").when(k % 4 == 1, "None").otherwise("Freedonia").alias("country_headquarters"),
        F.when(k % 5 == 0, "").otherwise("Old theme").alias("sujet_media"), F.when(k % 7 == 0, " ").otherwise("9").alias("official_rating"), (k % 2 * 4.5).alias("indice_fiabilite"), nv.alias("indice_interet_naval"),
        F.lit(1.0).alias("fiabilité_calcul"), F.lit(1.0).alias("fiabilité2"), (nv * 0.01).alias("intérêt marine calcul"), F.lit(1.0).alias("intérêt_par_fiabilité"),
    )
    aliases = media.patterns(spark, dictionaries.aliases("alias;canonique\n" + "\n".join(f"old src{i};src{i}" for i in range(20))))
    bans = media.patterns(spark, dictionaries.bans("# none\nspam *\n"))
    return rows, words(), dictionaries.cards(spark, CARDS), aliases, bans


@query("rescan", f"""SELECT doc_id, nom_du_media, time_stamp, CASE WHEN seat IS NOT NULL AND hq1 IN ('', 'Undetermined', 'None') THEN seat ELSE hq1 END AS country_headquarters, sujet_media, official_rating, CASE WHEN {_STALE} THEN fi1 ELSE fi END AS indice_fiabilite, nv1 AS indice_interet_naval,
  CASE WHEN {_STALE} THEN round(40.0::DOUBLE / fi1, 4) ELSE 1 END AS "fiabilité_calcul", CASE WHEN {_STALE} THEN round(0.6::DOUBLE / fi1, 4) ELSE 1 END AS "fiabilité2", CASE WHEN {_STALE} THEN round(nv1 * 0.4::DOUBLE / 40, 4) ELSE nv * 0.01::DOUBLE END AS "intérêt marine calcul",
  CASE WHEN {_STALE} THEN round(0.6::DOUBLE / fi1 + nv1 * 0.4::DOUBLE / 40, 4) ELSE 1 END AS "intérêt_par_fiabilité", notation, region_maritime FROM {_RESCANNED} WHERE NOT banned""")
def rescan_rows(spark, d):
    return rescan.rescan(*_rescanned(spark, d)).drop("titre")


@query("rescan_counters", f"""SELECT count(*) FILTER (WHERE banned) AS n_banned, count(*) FILTER (WHERE NOT banned AND dated) AS n_dates, count(*) FILTER (WHERE NOT banned AND merged) AS n_merged, count(*) FILTER (WHERE NOT banned AND {_STALE}) AS n_scores,
  count(*) FILTER (WHERE NOT banned AND seat IS NOT NULL AND hq1 IN ('', 'Undetermined', 'None')) AS n_seats, count(*) FILTER (WHERE NOT banned AND nv <> nv1) AS n_naval FROM {_RESCANNED}""")
def rescan_counters(spark, d):
    return rescan.counters(rescan.marked(*_rescanned(spark, d)))


_GOLD = "(SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'Inclassable/Non pertinent' ELSE lang END AS gold, CASE doc_id % 3 WHEN 0 THEN 'en' ELSE 'de' END AS made, CASE doc_id % 5 WHEN 0 THEN 'Hong-Kong' WHEN 1 THEN 'None' ELSE source END AS place FROM documents)"


def _gold(spark, d):
    k = F.col("doc_id")
    return table(spark, d, "documents").select(
        "doc_id", F.when(k % 7 == 0, "").when(k % 7 == 1, "Inclassable/Non pertinent").otherwise(F.col("lang")).alias("sujet_article"), F.when(k % 3 == 0, "en").otherwise("de").alias("theme"),
        F.when(k % 5 == 0, "Hong-Kong").when(k % 5 == 1, "None").otherwise(F.col("source")).alias("country_article"), F.lit("Hong Kong").alias("country"),
    )


_EVAL = "SELECT '{0}' AS what, count(*) FILTER (WHERE {1}) AS total, count(*) FILTER (WHERE {1} AND {2}) AS hits, count(*) FILTER (WHERE {1} AND {2}) / count(*) FILTER (WHERE {1}) AS accuracy FROM " + _GOLD


@query("eval_accuracy", _EVAL.format("theme", "gold NOT IN ('', 'Inclassable/Non pertinent')", "gold = made") + " UNION ALL " + _EVAL.format("country", "place <> 'None'", "place = 'Hong-Kong'"))
def eval_accuracy(spark, d):
    return gold.report(_gold(spark, d))[0]


@query("eval_recall_by_support", f"SELECT gold AS sujet_article, count(*) AS support, count(*) FILTER (WHERE gold = made) AS hits, count(*) FILTER (WHERE gold = made) / count(*) AS recall FROM {_GOLD} WHERE gold NOT IN ('', 'Inclassable/Non pertinent') GROUP BY gold HAVING count(*) >= 20 ORDER BY support DESC, gold")
def eval_recall_by_support(spark, d):
    return gold.report(_gold(spark, d))[1]


@query("gold_eligible", f"SELECT doc_id FROM {_GOLD} WHERE gold NOT IN ('', 'Inclassable/Non pertinent') OR place <> 'None'")
def gold_eligible(spark, d):
    return gold.eligible(_gold(spark, d)).select("doc_id")


@query("gold_first_seen", "SELECT lower(source) || CASE WHEN source = 'src3' THEN '.gov' ELSE '' END AS media, coalesce(lang, '') AS hq, CASE WHEN source = 'src3' THEN 'Politique' ELSE lang END AS theme FROM documents QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) = 1")
def gold_first_seen(spark, d):
    named = table(spark, d, "documents").withColumn("m", F.concat(F.upper("source"), F.when(F.col("source") == "src3", ".gov ").otherwise(" ")))
    return explore.first_seen(named, "m", "lang", "lang", [F.col("doc_id")])


@query("security_score", """SELECT c_custkey, CASE WHEN x * 8 = floor(x * 8) THEN floor(x * 100 + 0.5) / 100 ELSE format('{:.2f}', x)::DOUBLE END AS security FROM (SELECT c_custkey,
  (6.0::DOUBLE - coalesce(CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE 1 + (c_custkey % 9) / 2.0 END, 5)::DOUBLE) * (CASE WHEN c_custkey % 13 = 0 THEN 0 ELSE c_custkey % 61 END)::DOUBLE / 100 AS x FROM customer)""")
def security_score(spark, d):
    k = F.col("c_custkey")
    index = F.when(k % 11 != 0, (1 + (k % 9) / 2.0).cast("double"))
    return table(spark, d, "customer").select("c_custkey", scores.security(index, F.when(k % 13 != 0, (k % 61).cast("double"))).alias("security"))


@query("composite_whole", "SELECT c_custkey, round(0.6::DOUBLE / (1 + (c_custkey % 9) / 2.0)::DOUBLE + (c_custkey % 60)::DOUBLE * 0.4::DOUBLE / 40, 4) AS composite FROM customer")
def composite_whole(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select("c_custkey", scores.whole_composite((1 + (k % 9) / 2.0).cast("double"), (k % 60).cast("double")).alias("composite"))


@query("rating_default", "SELECT client_id, CASE WHEN coalesce(segment, '') = '' THEN 'F' ELSE upper(trim(segment)) END AS rating FROM clients")
def rating_default(spark, d):
    return table(spark, d, "clients").select("client_id", scores.rating(F.col("segment")).alias("rating"))


@query("site_number", """SELECT 'client' AS held, client_id AS id, balance AS n FROM clients UNION ALL SELECT 'customer', c_custkey, CASE c_custkey % 3 WHEN 0 THEN NULL WHEN 1 THEN c_custkey + 0.25 ELSE c_custkey END::DOUBLE FROM customer
  UNION ALL SELECT 'account', c_custkey, c_acctbal FROM customer""")
def site_number(spark, d):
    """Balances of all clients and customers, and of each customer a word, a number with a comma, or a whole number."""
    def comma(value: str):
        return F.replace(F.col(value).cast("decimal(20,4)").cast("string"), F.lit("."), F.lit(","))

    k, customers = F.col("c_custkey"), table(spark, d, "customer")
    written = F.when(k % 3 == 0, "none").when(k % 3 == 1, F.concat(k.cast("string"), F.lit(",25"))).otherwise(k.cast("string"))
    rows = table(spark, d, "clients").select(F.lit("client").alias("held"), F.col("client_id").alias("id"), comma("balance").alias("written"))
    rows = rows.unionAll(customers.select(F.lit("customer"), k, written)).unionAll(customers.select(F.lit("account"), k, comma("c_acctbal")))
    return rows.select("held", "id", scores.site_number(F.col("written")).alias("n"))


@query("percent_of_max", "SELECT source, n, round(100.0::DOUBLE * n / max(n) OVER ()) AS percent FROM (SELECT source, count(*) AS n FROM documents GROUP BY source)")
def percent_of_max(spark, d):
    counts = table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", scores.percent_of_max(F.col("n")))


@query("escape_html", """SELECT page_id, md5(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')) AS escaped FROM pages""")
def escape_html(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(text.escape_html(F.col("html")).cast("binary")).alias("escaped"))


@query("to_iso", "SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M') WHEN 2 THEN 'yesterday or the' WHEN 3 THEN strftime(o_orderdate, '%d/%m/%Y') ELSE '' END AS date FROM orders")
def to_iso(spark, d):
    at, k = F.col("o_orderdate"), F.col("o_orderkey") % 5
    written = F.when(k == 0, F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss 'GMT'")).when(k == 1, F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")).when(k == 2, " yesterday or the day before").when(k == 3, F.date_format(at, "dd/MM/yyyy")).otherwise("  ")
    return table(spark, d, "orders").select("o_orderkey", dates.to_iso(written).alias("date"))


@query("norm_date_week", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 2 THEN strftime(date_trunc('week', o_orderdate), '%Y-%m-%d 00:00') WHEN o_orderkey % 4 = 3 THEN strftime(o_orderdate, '%Y-%m-%d 10:30') ELSE strftime(o_orderdate, '%Y-%m-%d 00:00') END AS date FROM orders")
def norm_date_week(spark, d):
    at, k = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 4
    year, week, day = F.extract(F.lit("YEAROFWEEK"), at).cast("string"), F.lpad(F.weekofyear(at).cast("string"), 2, "0"), (F.weekday(at) + 1).cast("string")
    written = F.when(k == 0, F.concat_ws("-", year, F.concat(F.lit("W"), week), day)).when(k == 1, F.concat(year, F.lit("W"), week, day)).when(k == 2, F.concat(year, F.lit("-W"), week)).otherwise(F.concat(year, F.lit("-W"), week, F.lit("-"), day, F.lit("T10:30:00Z")))
    return table(spark, d, "orders").select("o_orderkey", dates.norm_date(written).alias("date"))


@query("stored_timestamp", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M') WHEN 1 THEN strftime(ts, '%Y-%m-%d 00:00') END AS stored FROM events")
def stored_timestamp(spark, d):
    k = F.col("event_id") % 3
    written = F.when(k == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).when(k == 1, F.date_format("ts", "yyyy-MM-dd'x'")).otherwise("soon")
    return table(spark, d, "events").select("event_id", F.date_format(dates.stored_timestamp(written), "yyyy-MM-dd HH:mm").alias("stored"))


@query("day_of_record", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN '' ELSE strftime(ts, '%Y-%m-%d') END AS day, CASE event_id % 4 WHEN 0 THEN '' ELSE strftime(ts, '%d/%m/%Y') END AS shown FROM events")
def day_of_record(spark, d):
    stamp = F.when(F.col("event_id") % 4 != 0, F.date_format("ts", "yyyy-MM-dd HH:mm"))
    return table(spark, d, "events").select("event_id", dates.day_of(stamp).alias("day"), dates.day_month_year(stamp).alias("shown"))
