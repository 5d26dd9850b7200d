"""Functions for SQL: scalar ones by name, and a table function that reads feeds."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from presslens.functions import language, text
from presslens.operators.matching import Dictionary


def _listed(words: tuple[str, ...]) -> str:
    return ", ".join("'" + w.replace("'", "\\'") + "'" for w in words)


def _pattern(said: str) -> str:
    return "'" + said.replace("\\", "\\\\").replace("'", "\\'") + "'"


def detect_body(words: dict[str, tuple[str, ...]] | None = None) -> str:
    """The decision of ``language.detect`` for a text ``t`` without a declared language, as SQL."""
    words = words or language.STOP_WORDS
    scripts = " ".join(f"WHEN t RLIKE {_pattern(p)} THEN '{code}'" for code, p in language.SCRIPTS)
    tokens = f"regexp_extract_all(lower(t), {_pattern('(' + language.TOKEN + ')')}, 1)"

    def count(code: str) -> str:
        n = f"size(filter(found, w -> w IN ({_listed(words[code])})))"
        return f"CASE WHEN t RLIKE {_pattern(language.HR_LETTERS)} THEN {n} ELSE 0 END" if code == "hr" else n

    others = [c for c in words if c != "en"]
    best = "array_max(array(" + ", ".join(f"struct({count(c)} AS n, {-i} AS at, '{c}' AS code)" for i, c in enumerate(others)) + "))"
    by_words = f"""transform(array(struct({best} AS best, {count('en')} AS en)), x -> CASE WHEN x.best.n >= 2 AND x.best.n > x.en THEN x.best.code WHEN x.en >= 1 THEN 'en'
      WHEN t RLIKE '[\\\\u0100-\\\\u024F]' OR regexp_count(t, '[à-ÿÀ-ß]') >= 3 THEN 'xx' ELSE 'en' END)[0]"""
    every = tuple(sorted({w for own in words.values() for w in own}))
    return f"""CASE WHEN t IS NULL THEN 'en' {scripts} WHEN regexp_count(t, {_pattern(language.VIETNAMESE)}) >= 2 THEN 'vi'
      ELSE transform(array(filter({tokens}, w -> w IN ({_listed(every)}))), found -> {by_words})[0] END"""


def naval_body(scale: Dictionary, cap: int | None = None) -> str:
    """The score of a text ``t`` by a scale of keywords: each pattern is a constant, compiled once."""
    total = " + ".join(f"CASE WHEN n RLIKE {_pattern(text.keyword_pattern(row[3]))} THEN {row[4]} ELSE 0 END" for row in scale.rows) or "0"
    score = f"least({total}, {cap})" if cap is not None else total
    return f"transform(array(norm_text(coalesce(t, ''))), n -> cast({score} AS INT))[0]"


def feed_function():
    """``feed_items(content)``: a row of position, title, link and date for each item of a feed document; malformed XML has none."""

    @F.udtf(returnType="position int, title string, link string, date string")
    class FeedItems:
        def eval(self, content: bytes) -> Iterator[tuple]:
            from presslens.sources.feeds import parse_feed

            for i, item in enumerate(parse_feed(content)):
                yield i, item["title"], item["link"], item["date"]

    return FeedItems


def register(spark: SparkSession, scale: Dictionary | None = None, words: dict[str, tuple[str, ...]] | None = None) -> None:
    """Make all of them known to SQL: norm_text, lang_detect, link_hash, partition_day, naval_bucket, is_broken_translation, the table
    function feed_items and, with a scale of keywords, naval_score."""
    text.nfkd_function(spark)
    spark.udf.register("degenerate_text", F.arrow_udf(language._degenerate, "boolean"))
    for name, (parameters, kind, body) in text.SQL_BODIES.items():
        text.sql_function(spark, name, parameters, kind, body)
    text.sql_function(spark, "lang_detect", "t STRING", "STRING", detect_body(words))
    if scale is not None:
        text.sql_function(spark, "naval_score", "t STRING", "INT", naval_body(scale))
    spark.udtf.register("feed_items", feed_function())
