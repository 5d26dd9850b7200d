"""Keyword matching against one pattern per keyword, with large dictionaries and odd signs; lookups in long and short lists."""

import random
import re

from pyspark.sql import functions as F

from presslens.functions import language, sql, text
from presslens.operators import lookup, matching, media

WORDS = [
    "peru", "us", "hormuz", "strait of hormuz", "strait", "u.s.", "c++", "north-sea", "l'aquila", "a", "of", "the sea", "sea", "mer  rouge", "x.y", "3 d", "e_f", "été", "ete", "東京", "東", "peru", "us army", "a b c d e",
]


def brute(said, entries):
    return {i: m.start() + 1 for i, w in enumerate(entries) if (m := re.search(r"(?<![^\W])(?<!['’])" + re.escape(w) + r"(?![^\W])", said))}


def texts_of(rng, words, n):
    signs = [" ", "  ", "-", "'", "’", ".", ",", "", "_", " a ", "\n", "+", "̀"]
    return ["".join(rng.choice(words) + rng.choice(signs) for _ in range(rng.randrange(9))) for _ in range(n)]


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.id, {})[r.kw_id] = r.pos
    return out


def test_keywords_as_patterns_would(spark):
    rng = random.Random(5)
    said = texts_of(rng, WORDS, 400) + [None, "", "’us is", "anti-peru's", "us_x", "bus", "strait-of hormuz", "c++ c+++", "u.s.a u.s. u.s."]
    frame = spark.createDataFrame(list(enumerate(said)), "id int, norm_text string")
    book = matching.dictionary([("one", [(w, 1) for w in WORDS[:12]]), ("two", [(w, 2) for w in WORDS[12:]])])
    want = {i: b for i, t in enumerate(said) if t and (b := brute(t, WORDS))}
    assert found(matching.keyword_hits(frame, book)) == want
    assert found(matching.keyword_hits(frame, book, literal_bytes=0)) == want
    assert found(matching.keyword_hits(frame, book, literal_bytes=0, part_bytes=20)) == want
    assert matching.keyword_hits(frame, matching.dictionary([])).count() == 0


def test_many_keywords_and_several_books(spark):
    rng = random.Random(6)
    many = [f"w{i}" + (f" w{i + 1}" if i % 3 == 0 else "") for i in range(1300)]
    said = texts_of(rng, many, 200)
    frame = spark.createDataFrame(list(enumerate(said)), "id int, norm_text string")
    book, other = matching.dictionary([("all", [(w, 1) for w in many])]), matching.dictionary([("few", [(w, 1) for w in many[:9]])])
    assert found(matching.keyword_hits(frame, book)) == {i: b for i, t in enumerate(said) if (b := brute(t, many))}
    got = frame.select("id", matching.hits_by(F.col("norm_text"), {"a": book, "b": other, "none": matching.dictionary([])}).alias("h")).collect()
    for r in got:
        assert {h.pos for h in r.h.b} == {h.pos for h in r.h.a if h.kw in many[:9]} and r.h.none == []


def test_long_lists_are_joined_short_ones_are_literals(spark):
    rows = spark.createDataFrame([("X",), ("X News",), ("Xtra",), (" X  Two ",), (None,), ("Y",), ("X Old Y",)], "media string")
    listed = media.patterns(spark, [("X *", "Ex"), ("X News", "Exact"), ("X  Two*", "Two"), ("X Old*", "Old"), ("X Old *", "Later")])
    short, long = media.canonical_names(rows, listed), media.canonical_names(rows, listed, most=0)
    assert sorted(short.collect(), key=repr) == sorted(long.collect(), key=repr)
    assert {r.media: r.canonical for r in short.collect()}["X Old Y"] == "Old"
    assert sorted(media.without_banned(rows, listed).collect(), key=repr) == sorted(media.without_banned(rows, listed, most=0).collect(), key=repr)
    plan = short._jdf.queryExecution().executedPlan().toString() + media.without_banned(rows, listed)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert lookup.in_map(F.col("media"), {"a": "b" * 50}, most=10) is None


def test_no_article_is_exchanged(spark):
    """The plans of the classifier and the rescan move no article."""
    from presslens.operators import rescan
    from presslens.plans import classifying
    from presslens.plans.registry import QUERIES

    d = "/root/testdata/sf0.001"
    for df in (QUERIES["classify_rows"](spark, d), QUERIES["media_cards"](spark, d), QUERIES["declared_language"](spark, d), QUERIES["ban_anti"](spark, d), QUERIES["alias_longest_prefix"](spark, d)):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and not re.search(r"Exchange hashpartitioning\(lower", plan)
    rows, *setup = classifying._rescanned(spark, d)
    flagged = rescan.marked(rows, *setup)
    flagged.collect()
    plan = flagged._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\((lower\()?nom_du_media|Exchange hashpartitioning\(lower", plan)


def test_stuck_fragments():
    rng = random.Random(7)
    pattern = re.compile(r"(.{2,20}?)\1{4,}")
    for _ in range(3000):
        piece = "".join(rng.choices("ab\n😀 c", k=rng.randrange(1, 22)))
        said = "".join(rng.choices("abc \n", k=rng.randrange(12))) + piece * rng.randrange(1, 7) + "".join(rng.choices("abc", k=rng.randrange(5)))
        assert language.stuck(said) == bool(pattern.search(said)), said


def test_sql_functions(spark):
    book = matching.dictionary([("20", [("strait of hormuz", 20)]), ("5", [("peru", 5), ("u.s.", 5)])])
    sql.register(spark, book)
    frame = spark.createDataFrame([("The Strait of Hormuz and Perú",), ("les chats dans la rue",), ("ali kao č",), (None,), ("мир",), ("it's the U.S. of peru's",)], "t string")
    frame.createOrReplaceTempView("said")
    got = spark.sql("SELECT lang_detect(t) AS l, naval_score(t) AS n FROM said").collect()
    want = frame.select(language.detect(F.col("t")).alias("l"), F.coalesce(matching.total_in(matching.hits_in(text.norm(F.col("t")), book)), F.lit(0)).alias("n")).collect()
    assert got == want and [r.n for r in got] == [25, 0, 0, 0, 0, 10]
