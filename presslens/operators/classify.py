"""The row classifier: themes, countries, regions, scores of an article, from its title and its outlet's card.

All keyword work is row-local (``matching.hits_by``: one pass for all dictionaries). Cards are a measured table, broadcast while it is small;
regions are a literal map. So an article is classified where it lies.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions import scores
from presslens.functions.text import norm
from presslens.operators import matching
from presslens.operators.lookup import in_map, sized
from presslens.operators.matching import NO_COUNTRY, Dictionary, Rule

#: An article without a theme, the theme of government outlets, and what an outlet's theme says of its articles.
NO_THEME, POLITICAL = "Non déterminé", "Politique"
THEME_OF_OUTLET = {
    "Tech": "Tech",
    "Business": "Markets and business",
    "Sports": "Sports",
    "Tensions/guerre/violences/géopolitique": "Guerre/violence",
    "Politique américaine": "Politique américaine",
}
CARD = "media string, pays_siege string, theme_media string, note string, indice_fiabilite string, notation string"
#: What the classifier makes, in the archive's names.
MADE = (
    "country_headquarters", "country_article", "region", "sujet_article", "sujet_media", "official_rating", "indice_fiabilite", "notation",
    "fiabilité_calcul", "indice_interet_naval", "region_maritime", "fiabilité2", "intérêt marine calcul", "intérêt_par_fiabilité", "confiance_pays_article",
)


@dataclass(frozen=True)
class Dictionaries:
    themes: Dictionary
    countries: Dictionary
    naval: Dictionary
    zones: Dictionary
    rules: tuple[Rule, ...] = ()
    regions: dict[str, str] = field(default_factory=dict)


def last_cards(cards: DataFrame, order: list[Column]) -> DataFrame:
    """One card per outlet, by trimmed lower-case name; the last in ``order`` wins."""
    named = cards.withColumn("media", F.lower(F.trim("media")))
    row = F.struct(*[F.coalesce(c, F.lit("")).alias(c) for c in named.columns if c != "media" and c in CARD])
    return named.groupBy("media").agg(F.max_by(row, F.struct(*order)).alias("_card")).select("media", "_card.*")


def with_cards(rows: DataFrame, cards: DataFrame, media: str) -> DataFrame:
    """``rows`` plus ``_card``, the outlet's card, null without one."""
    held = cards.select(F.col("media").alias("_media"), F.struct(*[c for c in cards.columns if c != "media"]).alias("_card"))
    return rows.join(sized(held), F.lower(F.col(media)) == F.col("_media"), "left").drop("_media")


def is_government(media: Column) -> Column:
    return F.coalesce(F.lower(media).contains(".gov"), F.lit(False))


def outlet_theme(media: Column, theme: Column) -> Column:
    """The outlet's theme for the fallback on its seat."""
    return F.when(is_government(media), POLITICAL).otherwise(F.coalesce(theme, F.lit("")))


def theme_chain(rule: Column, best: Column, theme_of_outlet: Column) -> Column:
    """A rule's theme, else the best score's, else what the outlet's theme stands for, else none."""
    made = F.coalesce(rule, best)
    out = F.when(made.isNotNull(), made)
    for said, theme in THEME_OF_OUTLET.items():
        out = out.when(theme_of_outlet == said, theme)
    return out.otherwise(NO_THEME)


def with_region(rows: DataFrame, regions: dict[str, str], country: str) -> DataFrame:
    found = in_map(F.col(country), regions)
    if found is not None:
        return rows.drop("region").withColumn("region", F.coalesce(found, F.lit(NO_COUNTRY)))
    table = rows.sparkSession.createDataFrame(list(regions.items()), "_country string, region string")
    joined = rows.drop("region").join(sized(table), F.col(country) == F.col("_country"), "left").drop("_country")
    return joined.withColumn("region", F.coalesce("region", F.lit(NO_COUNTRY)))


def classify_rows(rows: DataFrame, words: Dictionaries, cards: DataFrame, title: str = "titre", media: str = "nom_du_media") -> DataFrame:
    """``rows`` plus the columns ``MADE``, which win over columns of the same names. ``cards``: one row per outlet (``last_cards``)."""
    rows = rows.drop(*MADE).withColumn("_text", norm(F.coalesce(title, F.lit(""))))
    text = F.col("_text")
    found = rows.withColumn("_hits", matching.hits_by(text, {"themes": words.themes, "countries": words.countries, "naval": words.naval, "zones": words.zones, "rules": matching.rule_words(list(words.rules))}))
    found = with_cards(found, cards, media).withColumns({"_theme": matching.top_in(F.col("_hits.themes"))["class"], "_best": matching.top_in(F.col("_hits.countries")), "_strong": matching.countries_in(F.col("_hits.countries"))})
    index, interest = scores.reliability_index(F.col("_card.indice_fiabilite")), matching.total_in(F.col("_hits.naval")).cast("double")
    theme = F.col("_card.theme_media")
    rule = matching.first_rule(text, F.col("_strong"), list(words.rules), F.col("_hits.rules"))
    seat = matching.country_confidence(F.col("_best.score"), F.col("_best.class"), F.col("_card.pays_siege"), outlet_theme(F.col(media), theme))
    made = found.withColumns({
        "country_headquarters": F.coalesce("_card.pays_siege", F.lit(NO_COUNTRY)),
        "_seat": seat,
        "sujet_article": theme_chain(rule, F.col("_theme"), theme),
        "sujet_media": F.coalesce(theme, F.lit("")),
        "official_rating": F.coalesce("_card.note", F.lit("")),
        "indice_fiabilite": index,
        "notation": scores.rating(F.col("_card.notation")),
        "indice_interet_naval": interest,
        "region_maritime": matching.zone_in(F.col("_hits.zones")),
    })
    made = with_region(made.withColumns({"country_article": F.col("_seat.country"), "confiance_pays_article": F.col("_seat.confidence")}), words.regions, "country_article")
    scored = scores.score_columns(F.col("indice_fiabilite"), F.col("indice_interet_naval"))
    made = made.withColumns({"fiabilité_calcul": scored["reliability_score"], "fiabilité2": scored["reliability2"], "intérêt marine calcul": scored["marine"], "intérêt_par_fiabilité": scored["composite"]})
    return made.select(*[F.col(f"`{c}`") for c in rows.columns if c != "_text"], *[F.col(f"`{c}`") for c in MADE])


def batch_counters(rows: DataFrame, banned: Column, original: str = "titre_vo", theme: str = "sujet_article", country: str = "country_article") -> DataFrame:
    """One row of counts: rows read, banned, translated, with a theme, with a country; the last three without banned rows."""
    kept = ~banned
    return rows.agg(
        F.count(F.lit(1)).alias("n_read"),
        F.count_if(banned).alias("n_banned"),
        F.count_if(kept & (F.coalesce(original, F.lit("")) != "")).alias("n_translated"),
        F.count_if(kept & (F.col(theme) != NO_THEME)).alias("n_theme"),
        F.count_if(kept & (F.col(country) != NO_COUNTRY)).alias("n_country"),
    )

