"""Overlap join of sales and click sessions by overlap interval partitioning.

Sessions: clicks of one client are first summed up by pieces of ``GAP``, within which no gap can be longer; only the pieces, six an
hour at most whatever the number of clicks, are put in order per client. Spans are then floored to slots of one hour. Sessions with
the same client and slots are one entry with a count, sales with the same client and slots are probed once.

Entries are grouped by the granule in which they start and by the logarithmic class of their length (an entry without end has a class
of its own). A granule of a class is wider than its entries are long, so of the granules that an entry may share with a
sale's span, only those at the span's two ends (at most two each) need a look at the entries: the sale probes their members, which are
verified. All entries of a granule between them lie inside the span, so the sale probes the granule's sums, and those of
``WIDER`` granules in one row where the run is long enough. All probes are one equi-join on client, class, level and granule, so
the work of one client is dealt out over its granules, and no pair inside a span is ever made.

What one client can bring to one task is bounded by the calendar, not by its rows: its pieces, six an hour, in the
sessions' window. Its distinct sale spans are dealt out in parts.

Cases: rows with a null client or time are ignored, and lines without a sale; a sale without lines ends where it starts. Sales that
repeat count each time, under one sale_id; a null sale_id has no lines. Other columns are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

MICROS = 1_000_000
GAP, SLOT = 600 * MICROS, 3600 * MICROS
#: Granules of the shortest classes have 2 to this power slots.
FINE = 6
#: Rows of sums for 1, 16 and 256 granules.
LEVELS, WIDER = 3, 4
MEMBERS = -1
ENDLESS = -1
#: Parts in which the spans of one key are dealt out.
PARTS = 8


def micros(at: Column) -> Column:
    """Microseconds since 1970 of a timestamp as it reads, whatever the session's zone."""
    seconds = F.unix_date(at.cast("date")).cast("long") * 86400 + F.hour(at) * 3600 + F.minute(at) * 60
    return seconds * MICROS + (F.extract(F.lit("SECOND"), at) * MICROS).cast("long")


def floored(value: Column, width: int) -> Column:
    """The slot of a number, also of a negative one."""
    return F.call_function("div", value - F.pmod(value, F.lit(width)), F.lit(width))


def sessions(clicks: DataFrame, key: str = "client_id", at: str = "ts", kind: str = "kind", gap: int = GAP) -> DataFrame:
    """key, first, last (microseconds) and open: whether a click at the last time is a purchase. More than ``gap`` without a click begins another session."""
    rows = clicks.select(F.col(key).alias("key"), micros(F.col(at)).alias("at"), F.coalesce(F.col(kind) == "purchase", F.lit(False)).alias("bought")).filter("key IS NOT NULL AND at IS NOT NULL")
    pieces = rows.groupBy("key", floored(F.col("at"), gap).alias("piece")).agg(F.min("at").alias("first"), F.max(F.struct("at", "bought")).alias("last"))
    order = Window.partitionBy("key").orderBy("piece")
    begins = F.coalesce(F.col("first") - F.lag("last.at").over(order) > gap, F.lit(True))
    numbered = pieces.withColumn("_begins", begins.cast("long")).withColumn("session", F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    made = numbered.groupBy("key", "session").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return made.select("key", "first", F.col("last.at").alias("last"), F.col("last.bought").alias("open"))


def sale_spans(sales: DataFrame, lines: DataFrame) -> DataFrame:
    """id, key, low and high (slots); high is null for a sale with a line that is not shipped."""
    slot = floored(micros(F.col("shipped_at")), SLOT)
    ends = lines.filter("sale_id IS NOT NULL").groupBy(F.col("sale_id").alias("_sale")).agg(F.max(slot).alias("_shipped"), F.max(F.col("shipped_at").isNull()).alias("_open"))
    rows = sales.filter("client_id IS NOT NULL AND sold_at IS NOT NULL").select(F.col("sale_id").alias("id"), F.col("client_id").alias("key"), floored(micros(F.col("sold_at")), SLOT).alias("low"))
    joined = rows.join(ends, F.col("id") == F.col("_sale"), "left")
    return joined.select("id", "key", "low", F.when(~F.coalesce("_open", F.lit(False)), F.greatest("low", "_shipped")).alias("high"))


def entries(found: DataFrame) -> DataFrame:
    """Sessions by client and slots: key, a, b (null without end), how many and the sum of their checksums, with length class, granule's width (a power) and granule."""
    a, b = floored(F.col("first"), SLOT), F.when(~F.col("open"), floored(F.col("last"), SLOT))
    said = F.crc32(F.col("first").cast("string").cast("binary"))
    same = found.groupBy("key", a.alias("a"), b.alias("b")).agg(F.count(F.lit(1)).alias("n"), F.sum(said).alias("crc"))
    length_class = F.when(F.col("b").isNull(), ENDLESS).otherwise(F.length(F.bin(F.col("b") - F.col("a") + 1)) - 1)
    classed = same.withColumn("k", length_class.cast("int")).withColumn("width", F.greatest(F.lit(FINE), F.col("k") + 1))
    return classed.withColumn("g", F.expr("shiftright(a, width)"))


def index(rows: DataFrame) -> DataFrame:
    """What sales probe, by key, k, level and g: the entries of a granule (level ``MEMBERS``), and sums over granules."""
    members = rows.select("key", "k", F.lit(MEMBERS).alias("level"), "g", "a", "b", "n", "crc")
    levels = rows.withColumn("level", F.explode(F.array(*[F.lit(i) for i in range(LEVELS)]))).withColumn("g", F.expr(f"shiftright(g, {WIDER} * level)"))
    n = F.col("n")
    sums = levels.groupBy("key", "k", "level", "g").agg(F.sum(n * F.col("a")).alias("a"), F.sum(n * F.col("b")).alias("b"), F.sum(n).alias("n"), F.sum("crc").alias("crc"))
    return members.unionByName(sums)


def _run(low: Column, high: Column) -> Column:
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))


def _probe(granules: Column, level: int, part: int) -> Column:
    return F.transform(granules, lambda g: F.struct(F.lit(level).alias("level"), g.alias("g"), F.lit(part).alias("part")))


#: What a probe asks for: entries to verify; sums of entries inside the span; sums of endless entries that began before it.
VERIFY, INSIDE, BEFORE = range(3)


def probes(spans: DataFrame, rows: DataFrame) -> DataFrame:
    """The granules that each distinct span (key, low, high) may share with entries of its key, per class that the key has."""
    classes = rows.groupBy("key", "k", "width").agg(F.min("g").alias("least"), F.max("g").alias("most"))
    per_key = classes.groupBy(F.col("key").alias("_key")).agg(F.collect_list(F.struct("k", "width", "least", "most")).alias("_classes"))
    # One key's spans meet its classes, a row that comes once a part, in several parts.
    parted = spans.select("key", "low", "high").distinct().withColumn("_part", F.pmod(F.xxhash64("low", "high"), F.lit(PARTS)))
    per_part = per_key.withColumn("_of", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(PARTS - 1).cast("long"))))
    met = parted.join(per_part, (F.col("key") == F.col("_key")) & (F.col("_part") == F.col("_of")))
    asked = met.select("key", "low", "high", F.explode("_classes").alias("_c")).select("key", "low", "high", "_c.*")
    reach = F.when(F.col("k") == ENDLESS, 0).otherwise(F.expr("shiftleft(2L, greatest(k, 0)) - 2"))
    asked = asked.withColumn("_reach", reach).withColumns({
        "_l0": F.expr("greatest(least, shiftright(low - _reach, width))"),
        "_l1": F.expr("shiftright(low, width)"),
        "_r0": F.expr("shiftright(high - _reach, width)"),
        "_r1": F.expr("least(most, shiftright(high, width))"),
    })
    asked = asked.withColumns({
        "_left": _run(F.col("_l0"), F.least("most", "_l1")),
        "_right": F.when(F.col("high").isNull(), F.array().cast("array<bigint>")).otherwise(_run(F.greatest("least", "_r0", F.col("_l1") + 1), F.col("_r1"))),
        "_x0": F.greatest("least", F.col("_l1") + 1),
        "_y0": F.least("most", F.col("_r0") - 1),
        "_u0": F.col("least"),
        "_v0": F.when(F.col("k") == ENDLESS, F.least("most", F.col("_l1") - 1)).otherwise(F.col("least") - 1),
    })
    parts = [_probe(F.col("_left"), MEMBERS, VERIFY), _probe(F.col("_right"), MEMBERS, VERIFY)]
    for part, (x, y) in ((INSIDE, ("_x", "_y")), (BEFORE, ("_u", "_v"))):
        for level in range(LEVELS):
            low, high = F.col(f"{x}{level}"), F.col(f"{y}{level}")
            if level + 1 == LEVELS:
                parts.append(_probe(_run(low, high), level, part))
                break
            whole, once = (1 << WIDER) - 1, 1 << WIDER
            asked = asked.withColumns({f"{x}{level + 1}": F.shiftright(low + whole, WIDER), f"{y}{level + 1}": F.shiftright(high + 1, WIDER) - 1})
            above = F.col(f"{x}{level + 1}") <= F.col(f"{y}{level + 1}")
            parts.append(_probe(_run(low, F.when(above, F.col(f"{x}{level + 1}") * once - 1).otherwise(high)), level, part))
            parts.append(_probe(_run(F.when(above, (F.col(f"{y}{level + 1}") + 1) * once).otherwise(high + 1), high), level, part))
    return asked.select("key", "low", "high", "k", F.explode(F.concat(*parts)).alias("_p")).select("key", "low", "high", "k", "_p.*")


def relation(low: Column, high: Column, a: Column, b: Column) -> Column:
    """How the span from ``low`` to ``high`` lies to that from ``a`` to ``b``; ends without a value are infinite."""
    ends = F.when(high.isNull() & b.isNull(), 0).when(high.isNull(), 1).when(b.isNull(), -1).otherwise(F.signum(high - b).cast("int"))

    def by_end(sooner: str, equal: str, later: str) -> Column:
        return F.when(ends < 0, sooner).when(ends == 0, equal).otherwise(later)

    return F.when(low < a, by_end("overlaps", "finished_by", "contains")).when(low == a, by_end("starts", "equals", "started_by")).otherwise(by_end("during", "finishes", "overlapped_by"))


def related(spans: DataFrame, rows: DataFrame) -> DataFrame:
    """key, low, high, relation, n, slots, crc: the entries of the key that share a slot with the span, by relation."""
    low, high, a, b, n, part = (F.col(c) for c in ("low", "high", "a", "b", "n", "part"))
    asked = probes(spans, rows)
    found = asked.join(index(rows), ["key", "k", "level", "g"])
    shares = (part != VERIFY) | ((high.isNull() | (a <= high)) & (b.isNull() | (b >= low)))
    endless = F.col("k") == ENDLESS
    named = F.when(part == VERIFY, relation(low, high, a, b))
    named = named.when((part == INSIDE) & ~endless, "contains").when(part == INSIDE, F.when(high.isNull(), "finished_by").otherwise("overlaps"))
    named = named.otherwise(F.when(high.isNull(), "finishes").otherwise("during"))
    slots = F.when(part == VERIFY, n * (F.least(high, b) - F.greatest(low, a) + 1))
    slots = slots.when((part == INSIDE) & ~endless, b - a + n).when(part == INSIDE, n * (high + 1) - a).otherwise(n * (high - low + 1))
    pairs = found.filter(shares).select("key", "low", "high", named.alias("relation"), "n", slots.alias("slots"), "crc")
    return pairs.groupBy("key", "low", "high", "relation").agg(F.sum("n").alias("n"), F.sum("slots").alias("slots"), F.sum("crc").alias("crc"))


def overlapping_sessions(sales: DataFrame, lines: DataFrame, clicks: DataFrame) -> DataFrame:
    """Per sale and relation: sale_id, relation, n_pairs, overlap_slots (null where both ends are open), sessions_crc."""
    spans = sale_spans(sales, lines)
    found = related(spans, entries(sessions(clicks)))
    at = F.coalesce("high", F.col("low") - 1)  # no span ends before it starts
    sums = found.select(F.col("key").alias("_key"), F.col("low").alias("_low"), at.alias("_at"), "relation", "n", "slots", "crc")
    mine = spans.select("id", "key", "low", at.alias("at"))
    joined = mine.join(sums, (F.col("key") == F.col("_key")) & (F.col("low") == F.col("_low")) & (F.col("at") == F.col("_at")))
    return joined.groupBy(F.col("id").alias("sale_id"), "relation").agg(F.sum("n").alias("n_pairs"), F.sum("slots").alias("overlap_slots"), F.sum("crc").alias("sessions_crc"))


def op13_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    sales, lines, clicks = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("sales", "sale_lines", "clicks"))
    return overlapping_sessions(sales, lines, clicks)


_STEP = "list_reduce(range(8), lambda d, j: xor(d >> 1, 3988292384 * (d & 1)), {})"
#: A checksum's bytes are folded bit by bit, as SQL has no such function.
_CRC = f"xor(4294967295, list_reduce(list_transform(string_split(t0::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, x: {_STEP.format('xor(c, x)')}, 4294967295::BIGINT))"
SQL = f"""WITH k AS (SELECT client_id, epoch_us(ts) AS t, coalesce(kind = 'purchase', false) AS p FROM clicks WHERE client_id IS NOT NULL AND ts IS NOT NULL),
q AS (SELECT *, sum(fresh) OVER (PARTITION BY client_id ORDER BY t) AS run FROM (SELECT *, CASE WHEN t - lag(t) OVER (PARTITION BY client_id ORDER BY t) <= 600000000 THEN 0 ELSE 1 END AS fresh FROM k)),
s AS (SELECT client_id, t0, floor(t0 / 3600000000)::BIGINT AS a, floor(t1 / 3600000000)::BIGINT AS b, o FROM (SELECT client_id, min(t) AS t0, max(t) AS t1, max(struct_pack(t := t, p := p)).p AS o FROM q GROUP BY client_id, run)),
c AS (SELECT *, {_CRC} AS crc FROM s),
l AS (SELECT sale_id, max(epoch_us(shipped_at)) AS shipped, bool_or(shipped_at IS NULL) AS o FROM sale_lines GROUP BY sale_id),
v AS (SELECT sales.sale_id, client_id, floor(epoch_us(sold_at) / 3600000000)::BIGINT AS lo, floor(greatest(epoch_us(sold_at), coalesce(shipped, epoch_us(sold_at))) / 3600000000)::BIGINT AS hi, coalesce(o, false) AS o
  FROM sales LEFT JOIN l ON sales.sale_id = l.sale_id WHERE client_id IS NOT NULL AND sold_at IS NOT NULL),
j AS (SELECT sale_id, lo, CASE WHEN v.o THEN 1e18::BIGINT ELSE hi END AS hi, a, CASE WHEN c.o THEN 1e18::BIGINT ELSE b END AS b, crc FROM v JOIN c USING (client_id) WHERE (v.o OR a <= hi) AND (c.o OR b >= lo)),
r AS (SELECT sale_id, CASE WHEN lo < a THEN CASE WHEN hi < b THEN 'overlaps' WHEN hi = b THEN 'finished_by' ELSE 'contains' END WHEN lo = a THEN CASE WHEN hi < b THEN 'starts' WHEN hi = b THEN 'equals' ELSE 'started_by' END
  ELSE CASE WHEN hi < b THEN 'during' WHEN hi = b THEN 'finishes' ELSE 'overlapped_by' END END AS relation, CASE WHEN least(hi, b) < 1e18 THEN least(hi, b) - greatest(lo, a) + 1 END AS slots, crc FROM j)
SELECT sale_id, relation, count(*) AS n_pairs, sum(slots)::BIGINT AS overlap_slots, sum(crc)::BIGINT AS sessions_crc FROM r GROUP BY sale_id, relation"""
