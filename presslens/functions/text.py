"""Scalar functions on texts: normalisation, keyword patterns, escaping, hashes."""

from __future__ import annotations

import ctypes
import re
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: What counts as part of a word. ``(?U)\\w`` would also count combining marks, which must not continue a word.
TOKEN = r"[\p{L}\p{N}_]+"
BEFORE, AFTER = r"(?<![\p{L}\p{N}_'’])", r"(?![\p{L}\p{N}_])"


def trim() -> None:
    """Give free memory back to the system, so that a Python worker does not keep what its last batch took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def _nfkd(text: pa.Array) -> pa.Array:
    trim()
    return pc.utf8_normalize(text, form="NFKD")


def norm(text: Column) -> Column:
    """NFKD, then lower case. Of ASCII texts only a null goes to the Arrow kernel."""
    return F.lower(F.coalesce(F.arrow_udf(_nfkd, "string")(F.when(text.rlike(r"[^\x00-\x7F]"), text)), text))


def norm_word(word: str) -> str:
    """The same for one word on the driver."""
    return unicodedata.normalize("NFKD", word).lower()


def keyword_pattern(keyword: str) -> str:
    """A literal keyword, not after a word character or apostrophe and not before a word character."""
    return f"{BEFORE}{re.escape(keyword)}{AFTER}"


def head_token(keyword: str) -> str | None:
    """The leading word characters of a keyword; None if it starts otherwise."""
    m = re.match(r"[^\W]+", keyword)
    return m.group() if m else None


def once(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row."""
    return F.get(F.transform(F.array(value), body), 0)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({TOKEN})"), F.lit(1))


def strip(text: Column) -> Column:
    """Without white space at both ends, not only spaces."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def escape_html(text: Column) -> Column:
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def short_label(text: Column, most: int = 22) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 1), F.lit("…"))).otherwise(text)


def link_hash(link: Column) -> Column:
    return F.sha1(link.cast("binary"))


_MADE, _SOURCE = (rf"regexp_replace(coalesce({c}, ''), '(?U)^\\s+|\\s+$', '')" for c in ("made", "source"))
#: Functions for SQL with a body in SQL: parameters, type of the result, body.
SQL_BODIES = {
    "link_hash": ("link STRING", "STRING", "sha1(cast(link AS BINARY))"),
    "partition_day": ("stamp STRING", "STRING", "nullif(regexp_extract(coalesce(stamp, ''), '^([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), '')"),
    "naval_bucket": ("nv DOUBLE", "INT", "CASE WHEN coalesce(nv, 0) <= 0 THEN 0 ELSE cast(least(ceil(nv / 10), 6) AS INT) END"),
    "is_broken_translation": (
        "made STRING, source STRING",
        "BOOLEAN",
        rf"""{_MADE} = '' OR {_MADE} RLIKE '\\S{{46}}' OR length({_MADE}) > 200 AND length({_MADE}) > 3 * length({_SOURCE}) + 40 OR coalesce(degenerate_text({_MADE}), false)""",
    ),
}


def sql_function(spark: SparkSession, name: str, parameters: str, kind: str, body: str) -> None:
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {body}")


def nfkd_function(spark: SparkSession) -> None:
    spark.udf.register("norm_nfkd", F.arrow_udf(_nfkd, "string"))
    sql_function(spark, "norm_text", "t STRING", "STRING", "lower(norm_nfkd(t))")
