"""Quality rules with adaptive thresholds from mergeable quantile sketches.

Every document gets its counts; each rate goes into a quantile sketch of its language and source. A sketch is a table of
counts per logarithmic bucket (relative error ``STEP / 2``), so sketches merge by adding counts, which Spark does before the
shuffle, and reruns agree. Sketches are kept for three levels: a language's source, the language, all documents.

Bounds: from the sketch of all documents, the median plus ``FENCE`` times the distance to the quartile that junk does not stretch (at least
``FENCE`` times a least spread). Below it, a language and then a source has its own centre (its median) and its own spread (the mean
distance from the centre), with values beyond the wider level's bound counted as that bound, so that much junk cannot
lift its own bound far. Centre and spread of n documents weigh n against ``PRIOR`` documents of the wider level: a large
group follows its own sketch, a small one its language's, and nothing switches in between. A group's bound is its centre plus
``FENCE`` spreads.

A document fails if a rate lies beyond the bound of its language and source by more than ``NOISE`` standard errors of a rate over as many
words or lines as it has; so a short text is not thrown out for one sign. The table of bounds has one row per language and source;
Spark's planner broadcasts it only if its measured size is small.

Base rules come on top: fewer than 10 words, or over 20 % of the words in repeated 5-word windows.

Cases: a null or empty text has no words, fails the base rules and is in no sketch; very long texts are counted whole; null languages and
sources are groups of their own; ties count alike; repeated rows count each; an empty table gives an empty result; other columns, whatever
their names, pass through ``filter_documents``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.llm.common import SPACES, bytes_of, discard, documents, lean, materialise, thrifty

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
STEP = 0.02
FLOOR = 1e-4
FENCE = 6.0
NOISE = 3.0
#: Documents of the wider level that a group's own sketch is weighed against.
PRIOR = 50
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
#: Rate: (the count, what it is a rate of, least spread, whether low values fail too).
RATES: dict[str, tuple[str, str, float, bool]] = {
    "symbols": ("n_symbols", "n_words", 0.02, False),
    "dup_lines": ("n_dup_lines", "n_lines", 0.05, False),
    "word_length": ("word_chars", "n_words", 0.4, True),
}


def text_counts(raw: bytes) -> tuple[int, ...]:
    """The counts of one text, in the order of ``COUNTS``."""
    words = raw.split()
    plain = raw.translate(None, SPACES)
    chars = len(plain) if plain.isascii() else len(plain.decode("utf-8", "replace"))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    repeated = 0
    if len(words) >= 6:
        windows = list(zip(words, words[1:], words[2:], words[3:], words[4:], strict=False))
        found = Counter(windows)
        if len(found) < len(windows):
            end = 0
            for i, w in enumerate(windows):
                if found[w] > 1:
                    repeated += i + 5 - max(i, end)
                    end = i + 5
    return len(words), chars, len(raw) - len(raw.translate(None, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in lean(batches):
        columns = list(zip(*map(text_counts, bytes_of(batch.column(0).field("text"))), strict=True)) or [[]] * len(COUNTS)
        yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c, pa.int64()) for c in columns]], names=[*batch.schema.names, *[f"_{c}" for c in COUNTS]])


def with_counts(docs: DataFrame, whole: bool = True) -> DataFrame:
    """``doc``, all columns of ``docs`` (unless ``whole``, without text), and one column ``_<name>`` per count."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), F.col("lang").alias("_lang"), F.col("source").alias("_source"))
    schema = T.StructType([*packed.schema.fields] + [T.StructField(f"_{c}", T.LongType()) for c in COUNTS])
    if whole:
        return packed.mapInArrow(thrifty(_count), schema)
    kept = [f for f in docs.schema.fields if f.name != "text"]
    schema = T.StructType([T.StructField("doc", T.StructType(kept)), *schema.fields[1:]])

    def without_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _count(batches):
            doc = batch.column(0)
            slim = pa.StructArray.from_arrays([doc.field(f.name) for f in kept], names=[f.name for f in kept])
            yield pa.RecordBatch.from_arrays([slim, *batch.columns[1:]], names=batch.schema.names)

    return packed.mapInArrow(thrifty(without_text), schema)


def rate(name: str) -> Column:
    count, of, _, _ = RATES[name]
    return F.try_divide(F.col(f"_{count}").cast("double"), F.col(f"_{of}").cast("double"))


def bucket(value: Column) -> Column:
    return F.when(value < FLOOR, F.lit(0)).otherwise(F.lit(1) + F.floor(F.log(value / FLOOR) / F.log(F.lit(1 + STEP)))).cast("int")


def middle(number: Column) -> Column:
    """The value in the middle of a bucket."""
    return F.when(number == 0, F.lit(0.0)).otherwise(F.lit(FLOOR) * F.pow(F.lit(1 + STEP), number - 0.5))


LEVELS = 3


def sketches(counted: DataFrame) -> DataFrame:
    """level (0 a language's source, 1 a language, 2 all), lang, source, rate, bucket and n."""
    values = F.explode(F.array(*[F.struct(F.lit(r).alias("rate"), bucket(rate(r)).alias("bucket")) for r in RATES]))
    finest = counted.filter("_n_words > 0").select(F.col("_lang").alias("lang"), F.col("_source").alias("source"), values.alias("v")).groupBy("lang", "source", "v.rate", "v.bucket").agg(F.count(F.lit(1)).alias("n"))
    levels = finest.withColumn("level", F.explode(F.array(*map(F.lit, range(LEVELS)))))
    return levels.groupBy("level", F.when(F.col("level") < 2, F.col("lang")).alias("lang"), F.when(F.col("level") < 1, F.col("source")).alias("source"), "rate", "bucket").agg(F.sum("n").alias("n"))


def _of_rate(values: dict[str, object]) -> Column:
    out = F.lit(None)
    for name, value in values.items():
        out = F.when(F.col("rate") == name, F.lit(value)).otherwise(out)
    return out


def _quantiles(sketch: DataFrame) -> DataFrame:
    """rows, q1, q2 and q3 of every sketch."""
    group = Window.partitionBy("lang", "source", "rate")
    cut = sketch.withColumn("rows", F.sum("n").over(group)).withColumn("upto", F.sum("n").over(group.orderBy("bucket")))

    def quantile(q: float) -> Column:
        return middle(F.min(F.when(F.col("upto") >= F.col("rows") * q, F.col("bucket"))))

    return cut.groupBy("lang", "source", "rate", "rows").agg(quantile(0.25).alias("q1"), quantile(0.5).alias("q2"), quantile(0.75).alias("q3"))


def bounds(counted: DataFrame) -> DataFrame:
    """lang, source and for each rate ``<rate>_low`` and ``<rate>_high``."""
    sketch = materialise(sketches(counted), "sketches")
    least, two_sided = _of_rate({r: v[2] for r, v in RATES.items()}), _of_rate({r: v[3] for r, v in RATES.items()})
    whole = _quantiles(sketch.filter("level = 2"))
    reach = F.greatest(F.when(two_sided, F.col("q3") - F.col("q2")).otherwise(F.col("q2") - F.col("q1")), least)
    wide = whole.select("rate", F.col("q2").alias("centre"), reach.alias("spread"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("string").alias("source"))
    for level in (1, 0):
        on = ["rate"] if level == 1 else ["rate", "lang"]
        outer = wide.select(*[F.col(c).alias(f"_{c}") for c in on], F.col("centre").alias("_centre"), F.col("spread").alias("_spread"))
        same = F.lit(True)
        own = sketch.filter(F.col("level") == level)
        medians = _quantiles(own).select(F.col("lang").alias("l"), F.col("source").alias("s"), F.col("rate").alias("r"), F.col("rows"), F.col("q2").alias("median"))
        for c in on:
            same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
        joined = own.join(medians, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("rate") == F.col("r"))).join(outer, same)
        high, low = F.col("_centre") + FENCE * F.col("_spread"), F.col("_centre") - FENCE * F.col("_spread")
        share = F.col("rows") / (F.col("rows") + PRIOR)
        centre = share * F.greatest(low, F.least(high, F.col("median"))) + (1 - share) * F.col("_centre")
        inside = F.greatest(low, F.least(high, middle(F.col("bucket"))))
        joined = joined.withColumns({"centre": centre, "off": F.abs(inside - centre), "share": share})
        made = joined.groupBy("lang", "source", "rate").agg(F.first("centre").alias("centre"), F.first("share").alias("share"), F.first("_spread").alias("outer"), (F.sum(F.col("off") * F.col("n")) / F.sum("n")).alias("mean"))
        wide = made.select("rate", "centre", (F.col("share") * F.col("mean") + (1 - F.col("share")) * F.col("outer")).alias("spread"), "lang", "source")
    high = F.col("centre") + FENCE * F.col("spread")
    low = F.when(two_sided, F.col("centre") - FENCE * F.col("spread")).otherwise(F.lit(-1.0))
    made = wide.select("lang", "source", "rate", F.struct(low.alias("low"), high.alias("high")).alias("bound")).groupBy("lang", "source")
    return made.agg(*[F.max(F.when(F.col("rate") == r, F.col(f"bound.{side}"))).alias(f"{r}_{side}") for r in RATES for side in ("low", "high")])


def base_failed() -> Column:
    return (F.col("_n_words") < MIN_WORDS) | (100 * F.col("_n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_n_words"))


def _noise(name: str) -> Column:
    """How far a rate over so many words or lines may stray by chance."""
    count, of, _, two_sided = RATES[name]
    n = F.col(f"_{of}").cast("double")
    if two_sided:  # a mean length: lengths spread by about half of it
        return F.try_divide(NOISE * 0.5 * F.col(f"_{name}_high"), F.sqrt(n))
    return NOISE * F.sqrt(F.try_divide(F.greatest(F.col(f"_{name}_high"), F.try_divide(F.lit(1.0), n)), n))


def judge(counted: DataFrame, limits: DataFrame) -> DataFrame:
    """``counted`` plus ``_base_failed`` and ``_kept``."""
    named = limits.select(F.col("lang").alias("_l"), F.col("source").alias("_s"), *[F.col(c).alias(f"_{c}") for c in limits.columns[2:]])
    joined = counted.join(named, F.col("_lang").eqNullSafe(F.col("_l")) & F.col("_source").eqNullSafe(F.col("_s")), "left")
    outside = F.lit(False)
    for r in RATES:
        outside = outside | F.coalesce((rate(r) > F.col(f"_{r}_high") + _noise(r)) | (rate(r) < F.col(f"_{r}_low") - _noise(r)), F.lit(False))
    return joined.withColumn("_base_failed", base_failed()).withColumn("_kept", ~F.col("_base_failed") & ~outside)


def measured(docs: DataFrame) -> DataFrame:
    """The counts of every document without its text, written to the shared folder."""
    counted = with_counts(docs.select("doc_id", "lang", "source", "text"), whole=False)
    return materialise(counted.select(F.col("doc.doc_id").alias("doc_id"), *counted.columns[1:]), "counts")


def filter_documents(docs: DataFrame) -> DataFrame:
    """The documents that the rules keep, with all their columns. Texts are counted again rather than shuffled to meet their verdict."""
    counted = measured(docs)
    limits = materialise(bounds(counted), "bounds")
    discard(counted)
    return judge(with_counts(docs), limits).filter("_kept").select(*[F.col(f"doc.`{c}`") for c in docs.columns])


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = measured(documents(spark, sf_dir))
    judged = judge(counted, materialise(bounds(counted), "bounds"))
    return judged.select("doc_id", *[F.col(f"_{c}").alias(c) for c in COUNTS[:5]], F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"))
