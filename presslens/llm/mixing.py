"""Mixing sources to target weights as a time-varying curriculum.

Targets: the budget is shared by weight, capped at ``max_repeats`` times a source's size, and the excess is shared again.
The shares that result are ``min(cap, level * weight)`` for one common level; since the total is concave in the level, the
level is the largest of the lines through the breakpoints, which one window over the table of sources gives.

Curriculum: each source has a weight schedule over training time 0 to 1. Its integral is the source's cumulative token
demand; a document that starts at some share of its source's tokens is trained at the time when the demand reaches that
share (the inverse). Range-sorting the drawn documents by that time gives the training order.

A source's documents are laid out in the order of a hash of their id, and the target is taken from the start, wrapping
around once per pass; so whole documents are taken but for the one at the end of the target, which gives its first words.

Rows that are alike in all their columns are one row with copies while places are worked out, whatever share of the rows they are. Sources may
be many: they are ranked in parts by range, and the level is found over the distinct (size, weight) of sources, of which there
are at most three for each size, and no more sizes than the square root of twice the words.

Cases: a null text or one without words has size 0 and gives nothing; a text of any length is counted whole; a null source is one source, the
last; rows alike in id, size, source and text are interchangeable; an empty table gives an empty result; other columns may have any
names but map types, which are not compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslens.llm.common import WORD, documents, materialise, spread_copies

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MAX_REPEATS = 2
#: Schedule of each weight: (time, relative rate) knots. Heavily weighted sources lead early, light ones late.
SCHEDULES: dict[int, list[tuple[float, float]]] = {5: [(0.0, 1.5), (1.0, 0.5)], 2: [(0.0, 1.0), (1.0, 1.0)], 1: [(0.0, 0.25), (0.5, 0.75), (1.0, 2.25)]}
#: Rows that one prefix-sum block holds on average.
BLOCK_ROWS = 8192


def invert_schedule(knots: list[tuple[float, float]], share: Column) -> Column:
    """The time at which the integral of the piecewise linear ``knots`` reaches ``share`` of its total."""
    if len(knots) < 2 or any(w < 0 for _, w in knots) or any(a[0] >= b[0] for a, b in zip(knots, knots[1:], strict=False)):
        raise ValueError("a schedule needs two or more knots, in time order, of weights 0 or more")
    areas = [(b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False)]
    total, done, out = sum(areas), 0.0, None
    if not total > 0:
        raise ValueError("a schedule needs some weight")
    for (t0, w0), (t1, w1), area in zip(knots, knots[1:], areas, strict=False):
        rest = share * total - done
        slope = (w1 - w0) / (t1 - t0)
        if slope:
            inner = F.lit(t0) + (F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + rest * (2 * slope))) - w0) / slope
        else:
            inner = F.lit(t0) + (rest / w0 if w0 else F.lit(0.0))
        done += area
        out = F.when(share * total <= done, inner) if out is None else out.when(share * total <= done, inner)
    return F.least(F.lit(knots[-1][0]), out.otherwise(F.lit(knots[-1][0])))


def _ranked(per: DataFrame) -> DataFrame:
    """``per`` plus ``rank``, from 0, by source in code point order, null last. One window per range of sources, and one over the ranges."""
    order = F.col("source").asc_nulls_last()
    parts = materialise(per.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources")
    counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return parts.withColumn("inside", inside).join(before, "part").withColumn("rank", F.col("before") + F.col("inside")).drop("part", "inside", "before")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """source, source_size, weight and target of each source. ``sized`` has source and words."""
    per = sized.groupBy("source").agg(F.sum("words").alias("source_size"))
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(F.col("rank"), F.lit(len(weights))).cast("int"))
    capped = materialise(_ranked(per).select("source", "source_size", weight.alias("weight"), (F.col("source_size") * max_repeats).alias("cap")), "capped")
    steps = capped.groupBy("cap", "weight").agg(F.sum("cap").alias("caps"), F.sum("weight").alias("weights"), F.sum("source_size").alias("sizes"))
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "cap", "weight")
    prefix, suffix = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("sizes").over(Window.partitionBy(F.lit(0)))
    lines = steps.select(((total * budget - F.coalesce(F.sum("caps").over(prefix), F.lit(0))) / F.sum("weights").over(suffix)).alias("line"))
    level = lines.agg(F.max("line")).first()[0]
    return capped.select("source", "source_size", "weight", F.least(F.col("cap").cast("double"), F.lit(level) * F.col("weight")).alias("target"))


def _word_count() -> Column:
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def _row_hash(docs: DataFrame) -> Column:
    return F.xxhash64(*[F.col(f"`{c}`") for c, t in docs.dtypes if "map<" not in t])


def _places(docs: DataFrame, weights: tuple[int, ...], budget: float, max_repeats: int) -> DataFrame:
    """One row per group of like rows: doc_id, source, size, row, copies, where the first starts in its source, the source's figures."""
    rows = docs.select("doc_id", "source", _word_count().alias("size"), _row_hash(docs).alias("row"))
    sized = rows.groupBy("doc_id", "source", "size", "row").agg(F.count(F.lit(1)).alias("copies"))
    sized = sized.withColumns({"words": F.col("size") * F.col("copies"), "ord": F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit(""))})
    sized = materialise(sized, "sizes")
    groups, digits = sized.count(), 2
    while groups > BLOCK_ROWS * 16**digits and digits < 8:
        digits += 1
    # Ids that are null have no hash: their rows are spread by the row's.
    block = F.when(F.col("ord") == "", F.concat(F.lit("!"), F.substring(F.hex("row"), 1, digits))).otherwise(F.substring("ord", 1, digits))
    placed = sized.withColumn("block", block)
    sums = placed.groupBy("source", "block").agg(F.sum("words").alias("words"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("block").alias("b"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("start"))
    targets = source_targets(sized, weights, budget, max_repeats).withColumnRenamed("source", "s")
    starts = starts.join(targets, starts.s.eqNullSafe(targets.s)).drop(targets.s)
    inside = Window.partitionBy("source", "block").orderBy("ord", "doc_id", "size", "row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    laid = placed.withColumn("upto", F.sum("words").over(inside))
    laid = laid.join(starts, laid.source.eqNullSafe(starts.s) & (laid.block == starts.b)).withColumn("first", F.col("start") + F.col("upto") - F.col("words"))
    return laid.select("doc_id", "source", "size", "row", "copies", "first", "source_size", "weight", "target")


def _draws(schedules: dict[int, list[tuple[float, float]]], max_repeats: int) -> Column:
    """One (pass, words, position) for every pass that takes words of copy ``number``."""
    offset_of = F.col("first") + F.col("number") * F.col("size")

    def drawn(k: int) -> Column:
        offset = offset_of + F.col("source_size") * k
        words = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.round("target").cast("long") - offset))
        share = F.least(F.lit(1.0), F.coalesce(F.try_divide(offset.cast("double"), F.col("target")), F.lit(0.0)))
        at = F.lit(0.0)
        for w, knots in schedules.items():
            at = F.when(F.col("weight") == w, invert_schedule(knots, share)).otherwise(at)
        return F.struct(F.lit(k).alias("pass"), words.alias("words"), at.alias("position"))

    return F.filter(F.array(*[drawn(k) for k in range(max_repeats)]), lambda d: d["words"] > 0)


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_repeats: int = MAX_REPEATS, schedules: dict[int, list[tuple[float, float]]] | None = None) -> DataFrame:
    """One row per document, range-sorted by its first training position: doc_id, source, size, source_size, target, taken and draws.

    ``draws`` holds one (pass, words, position) for every pass that takes words of the document; documents without any come last.
    """
    each = spread_copies(_places(docs, weights, budget, max_repeats), "copies", "number")
    out = each.select("doc_id", "source", "size", "source_size", "target", _draws(schedules or SCHEDULES, max_repeats).alias("draws"))
    out = out.withColumn("taken", F.aggregate("draws", F.lit(0).cast("long"), lambda a, d: a + d["words"]))
    return out.orderBy(F.get("draws", 0)["position"].asc_nulls_last(), "doc_id", "size")


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, max_repeats: int = MAX_REPEATS, schedules: dict[int, list[tuple[float, float]]] | None = None) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row per draw, range-sorted by training position.

    A document that the mix repeats comes back once per pass; the one that ends a source's target in mid-text is cut
    after the words that are taken, and a document without words is not drawn. Every row has its own draws, like rows too.
    """
    plan = materialise(_places(docs, weights, budget, max_repeats), "places").withColumnRenamed("doc_id", "id")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), _row_hash(docs).alias("hash"))
    joined = whole.join(plan, (whole.hash == plan.row) & F.col("doc.doc_id").eqNullSafe(plan.id) & F.col("doc.source").eqNullSafe(plan.source))
    each = joined.filter("copies = 1").withColumn("number", F.lit(0).cast("long"))
    if not plan.filter("copies > 1").isEmpty():
        each = each.unionByName(spread_copies(joined.filter("copies > 1").dropDuplicates(["hash", "id", "source"]), "copies", "number"))
    drawn = each.withColumn("draw", F.explode(_draws(schedules or SCHEDULES, max_repeats)))
    #: The pattern is applied only to the document that a target cuts.
    parts = F.regexp_extract_all(F.col("doc.text"), F.lit(f"({WORD}[\\x20\\x09-\\x0D]*)"), F.lit(1))
    cut = F.when(F.col("draw.words") < F.col("size"), F.array_join(F.slice(parts, F.lit(1), F.greatest(F.lit(1), F.col("draw.words").cast("int"))), "")).otherwise(F.col("doc.text"))
    ordered = drawn.withColumn("text", cut).orderBy("draw.position", "id", "draw.pass", "row", "number")
    return ordered.select(*[F.col("text") if c == "text" else F.col(f"doc.`{c}`") for c in docs.columns])


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's share of the mix, in training order; ``position`` is the time of its first draw, null if it has none."""
    plan = plan_mix(documents(spark, sf_dir))
    return plan.select("doc_id", "size", "source_size", "target", "taken", F.get("draws", 0)["position"].alias("position"), F.size("draws").alias("passes"))
