"""What the explorer does: selections, tables, cross-tabs, map measures, graphs, evaluation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions.scores import round_exact, security

#: What stands for "unknown" in a facet.
JUNK = ("", "Undetermined", "Non déterminé", "None", "Inclassable", "Inclassable/Non pertinent")


def is_junk(value: Column, more: tuple[str, ...] = ()) -> Column:
    return value.isNull() | value.isin(*JUNK, *more)


@dataclass(frozen=True)
class Selection:
    """Facets, a period and a search text; each is left out if empty."""

    facets: dict[str, tuple] = field(default_factory=dict)
    period: tuple[str, str, str] | None = None
    search: tuple[str, tuple[str, ...]] | None = None

    def apply(self, rows: DataFrame) -> DataFrame:
        for column, values in self.facets.items():
            rows = rows.filter(F.col(column).isin(*values))
        if self.period:
            column, start, end = self.period
            rows = rows.filter(F.col(column).between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
        if self.search and self.search[0]:
            text, columns = self.search
            rows = rows.filter(F.contains(F.lower(F.concat_ws(" ", *columns)), F.lit(text.lower())))
        return rows


#: What can be counted per value of a dimension: names of columns to an aggregate. ``media`` names the outlet, ``interest`` the naval interest.
MEASURES = {
    "count": lambda media, interest: F.count(F.lit(1)),
    "sources": lambda media, interest: F.count_distinct(media),
    "naval": lambda media, interest: F.sum(F.coalesce(interest, F.lit(0.0))) / F.count(F.lit(1)),
    "navcount": lambda media, interest: F.count_if(interest > 0),
}
MISSING = "—"


def measured(rows: DataFrame, dim: str, measures: list[str], media: str, interest: str) -> DataFrame:
    """dim and the measures asked for, all in one aggregation; rows without a value of the dimension are one value of their own."""
    unknown = [m for m in measures if m not in MEASURES]
    if unknown:
        raise ValueError(f"no such measure: {', '.join(unknown)}; there are {', '.join(MEASURES)}")
    value = F.coalesce(F.nullif(F.col(dim).cast("string"), F.lit("")), F.lit(MISSING))
    return rows.groupBy(value.alias("value")).agg(*[MEASURES[m](F.col(media), F.col(interest)).alias(m) for m in measures])


def sort_table(rows: DataFrame, column: str, descending: bool, unique: str) -> DataFrame:
    """Nulls count as empty: first upwards, last downwards."""
    order = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_first()
    return rows.orderBy(order, unique)


def page(rows: DataFrame, order: list, number: int, size: int) -> DataFrame:
    return rows.orderBy(*order).offset(number * size).limit(size)


def map_measures(rows: DataFrame, country: str, media: str, interest: str) -> DataFrame:
    value = F.coalesce(F.col(interest), F.lit(0.0))
    return rows.filter(~is_junk(F.col(country))).groupBy(country).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(media).alias("n_media"), (F.sum(value) / F.count(F.lit(1))).alias("mean_interest"), F.count_if(value > 0).alias("n_interest")
    )


def ranking(measured: DataFrame, key: str, value: str, most: int = 25) -> DataFrame:
    return measured.filter(F.col(value) > 0).orderBy(F.desc(value), key).limit(most)


def covered(measured: DataFrame, value: str) -> DataFrame:
    """One row: how many keys have a value."""
    return measured.agg(F.count_if(F.col(value) > 0).alias("covered"))


def map_shapes(shapes: DataFrame, measured: DataFrame, key: str, value: str) -> DataFrame:
    """Every shape of the map with its value, 0 without one, and the share of the largest (which is 1 at least) that colours it."""
    counted = shapes.select(key).join(measured.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(0)))
    return counted.withColumn("shade", F.col(value) / F.greatest(F.max(value).over(Window.partitionBy(F.lit(0))), F.lit(1)))


def options(rows: DataFrame, column: str, more_junk: tuple[str, ...] = ()) -> DataFrame:
    """The values that a filter on ``column`` offers, in order: all but junk and the names in ``more_junk``."""
    return rows.filter(~is_junk(F.col(column), more_junk)).select(column).distinct().orderBy(column)


def page_count(rows: DataFrame, size: int) -> DataFrame:
    """One row: the rows, and the pages they fill; an empty table has one page."""
    return rows.agg(F.count(F.lit(1)).alias("n")).withColumn("pages", F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / size)))


def crosstab(rows: DataFrame, dim: str, measure: Column, most: int, by_date: bool = False) -> DataFrame:
    made = rows.filter(~is_junk(F.col(dim).cast("string"))).groupBy(dim).agg(measure.alias("value"))
    return made.orderBy(*([F.desc(dim)] if by_date else [F.desc("value"), F.col(dim)])).limit(most)


def excluded(rows: DataFrame, dim: str, measure: Column) -> DataFrame:
    """The sum of the measure over the groups that a cross-tab leaves out."""
    return rows.filter(is_junk(F.col(dim))).groupBy(dim).agg(measure.alias("value")).agg(F.coalesce(F.sum("value"), F.lit(0)).alias("excluded"))


def split_series(rows: DataFrame, dim: str, split: str, measure: Column, most: int = 8, top: int | None = None, by_date: bool = False) -> DataFrame:
    """dim, split and value for the ``most`` most frequent split values; missing cells are 0.

    With ``top`` only the labels that the cross-tab shows. Only those ``most`` names come to the driver.
    """
    clean = rows.filter(~is_junk(F.col(dim).cast("string")) & ~is_junk(F.col(split).cast("string")))
    names = [r[0] for r in clean.groupBy(split).agg(F.count(F.lit(1)).alias("_n")).orderBy(F.desc("_n"), split).limit(most).collect()]
    if top is not None:
        shown = crosstab(rows, dim, measure, top, by_date).select(dim)
        clean = clean.join(shown, dim, "left_semi")
    cells = [F.struct(F.lit(n).alias(split), F.coalesce(F.col("`" + str(n).replace("`", "``") + "`"), F.lit(0)).alias("value")) for n in names]
    if not names:
        return clean.groupBy(dim, split).agg(measure.alias("value"))
    wide = clean.groupBy(dim).pivot(split, names).agg(measure)
    return wide.select(dim, F.explode(F.array(*cells)).alias("_cell")).select(dim, "_cell.*")


def edges(rows: DataFrame, source: str, target: str, same_dim: bool = False) -> DataFrame:
    out = rows.filter(~is_junk(F.col(source)) & ~is_junk(F.col(target))).groupBy(F.col(source).alias("src"), F.col(target).alias("dst")).agg(F.count(F.lit(1)).alias("w"))
    return out.filter("src <> dst") if same_dim else out


def top_edges(graph: DataFrame, most: int) -> DataFrame:
    """Edges whose ends are both among the heaviest of their side, over all edges."""
    whole = graph
    for side in ("src", "dst"):
        top = whole.groupBy(F.col(side).alias(f"_{side}")).agg(F.sum("w").alias("_w")).orderBy(F.desc("_w"), f"_{side}").limit(most)
        graph = graph.join(top, F.col(side) == F.col(f"_{side}"), "left_semi")
    return graph


def nodes(graph: DataFrame) -> DataFrame:
    both = graph.select(F.col("src").alias("id"), "w", F.lit(1).alias("s"), F.lit(0).alias("t")).unionByName(graph.select(F.col("dst").alias("id"), "w", F.lit(0).alias("s"), F.lit(1).alias("t")))
    role = F.when((F.max("s") == 1) & (F.max("t") == 1), "both").when(F.max("s") == 1, "source").otherwise("target")
    return both.groupBy("id").agg(F.sum("w").alias("weight"), role.alias("role"))


def neighbourhood(graph: DataFrame, node: str) -> DataFrame:
    return graph.filter((F.col("src") == node) | (F.col("dst") == node))


def media_card(rows: DataFrame, media: str, index: str, interest: str, rated: str, order: list[Column]) -> DataFrame:
    """Per outlet: articles, mean security (each rounded first) of those with interest, 0 without; the newest rated row's rating, the newest row.

    ``order`` ends in a unique column; its largest is the newest.
    """
    points = security(F.col(index), F.col(interest))
    newest = F.struct(*order)
    return rows.groupBy(media).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(round_exact(F.avg(F.when(F.col(interest) >= 1, points))), F.lit(0.0)).alias("note"),
        F.max_by(F.col(rated), F.when(F.col(rated).isNotNull(), newest)).alias("rating"),
        F.max(newest).alias("latest"),
    )


def media_countries(rows: DataFrame, media: str, country: str, more_junk: tuple[str, ...] = ()) -> DataFrame:
    return rows.filter(~is_junk(F.col(country), more_junk)).groupBy(media, country).agg(F.count(F.lit(1)).alias("n"))


def recall(rows: DataFrame, gold: str, predicted: str, least: int = 20) -> DataFrame:
    made = rows.groupBy(gold).agg(F.count(F.lit(1)).alias("support"), F.count_if(F.col(gold) == F.col(predicted)).alias("hits"))
    return made.filter(F.col("support") >= least).select(gold, "support", "hits", (F.col("hits") / F.col("support")).alias("recall"))


def accuracy(rows: DataFrame, pairs: dict[str, tuple[Column, Column]]) -> DataFrame:
    """One row per name: how many rows have a usable gold value, and the share that agrees. ``pairs``: gold and predicted."""
    parts = [rows.agg(F.lit(n).alias("what"), F.count_if(~is_junk(g)).alias("total"), F.count_if(~is_junk(g) & (g == p)).alias("hits")) for n, (g, p) in pairs.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("accuracy", F.try_divide("hits", "total"))


def first_seen(rows: DataFrame, media: str, headquarters: str, theme: str, order: list[Column]) -> DataFrame:
    """Seat and theme of each outlet (in lower case) as its first row has them; a ``.gov`` outlet is political."""
    key = F.lower(F.trim(F.col(media)))
    first = F.min_by(F.struct(F.coalesce(headquarters, F.lit("")).alias("hq"), theme), F.struct(*order))
    made = rows.groupBy(key.alias("media")).agg(first.alias("f"))
    return made.select("media", F.col("f.hq").alias("hq"), F.when(F.col("media").contains(".gov"), "Politique").otherwise(F.col(f"f.{theme}")).alias("theme"))


def confusions(rows: DataFrame, gold: str, predicted: str, most: int = 8) -> DataFrame:
    made = rows.filter(F.col(gold) != F.col(predicted)).groupBy(gold, predicted).agg(F.count(F.lit(1)).alias("n"))
    return made.orderBy(F.desc("n"), gold, predicted).limit(most)
