"""Dictionaries applied again to the whole archive: bans, dates, outlet names, cards, naval scores and what follows from them.

Themes, countries, regions and confidences stay as they are, unless ``everything`` is asked for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from presslens.functions import dates, scores
from presslens.functions.text import norm
from presslens.operators import matching, media
from presslens.operators.classify import Dictionaries, classify_rows, with_cards

#: A seat that counts as missing.
NO_SEAT = ("", "Undetermined", "None")
FLAGS = {"_banned": "n_banned", "_dated": "n_dates", "_merged": "n_merged", "_rescored": "n_scores", "_seated": "n_seats", "_naval": "n_naval"}


def marked(rows: DataFrame, words: Dictionaries, cards: DataFrame, aliases: DataFrame, bans: DataFrame) -> DataFrame:
    """Every row as the rescan leaves it, with a flag for each kind of change (the keys of ``FLAGS``); banned rows are still there.

    Needs nom_du_media, titre, time_stamp (text), country_headquarters, sujet_media, official_rating, indice_fiabilite,
    indice_interet_naval and the four scores.
    """
    columns = [c for c in rows.columns if c not in ("notation", "region_maritime")]
    found = media.flag_banned(rows, bans, "nom_du_media", "_banned")
    found = media.canonical_names(found, aliases, "nom_du_media")
    found = found.withColumn("_merged", F.col("canonical") != F.col("nom_du_media")).withColumn("nom_du_media", F.coalesce("canonical", "nom_du_media"))
    found = with_cards(found, cards, "nom_du_media").withColumn("_text", norm(F.coalesce("titre", F.lit(""))))
    found = found.withColumn("_hits", matching.hits_by(F.col("_text"), {"naval": words.naval, "zones": words.zones}))

    def of_card(name: str):
        return F.nullif(F.col(f"_card.{name}"), F.lit(""))

    def text_of(name: str):
        return F.coalesce(F.col(name), F.lit(""))

    merged_seat = F.when(F.col("_merged"), F.coalesce(of_card("pays_siege"), F.col("country_headquarters"))).otherwise(F.col("country_headquarters"))
    found = found.withColumn("country_headquarters", merged_seat)
    seated = of_card("pays_siege").isNotNull() & text_of("country_headquarters").isin(*NO_SEAT)
    date = dates.norm_date(F.col("time_stamp"))
    index, interest = scores.reliability_index(F.col("_card.indice_fiabilite")), matching.total_in(F.col("_hits.naval")).cast("double")
    marine = F.round(interest * 0.4 / 40, 4)
    stale = ~F.col("indice_fiabilite").eqNullSafe(index) | ~F.round("`intérêt marine calcul`", 4).eqNullSafe(marine)
    scored = scores.score_columns(index, interest)
    made = {
        "_seated": seated,
        "country_headquarters": F.when(seated, of_card("pays_siege")).otherwise(F.col("country_headquarters")),
        "sujet_media": F.when(F.col("_merged") | (F.trim(text_of("sujet_media")) == ""), F.coalesce(of_card("theme_media"), F.col("sujet_media"))).otherwise(F.col("sujet_media")),
        "official_rating": F.when(F.col("_merged") | (F.trim(text_of("official_rating")) == ""), F.coalesce(of_card("note"), F.col("official_rating"))).otherwise(F.col("official_rating")),
        "_dated": ~date.eqNullSafe(F.col("time_stamp")),
        "time_stamp": date,
        "notation": scores.rating(F.col("_card.notation")),
        "region_maritime": matching.zone_in(F.col("_hits.zones")),
        "_naval": ~F.col("indice_interet_naval").eqNullSafe(interest),
        "_rescored": stale,
        "fiabilité_calcul": F.when(stale, scored["reliability_score"]).otherwise(F.col("fiabilité_calcul")),
        "fiabilité2": F.when(stale, scored["reliability2"]).otherwise(F.col("fiabilité2")),
        "intérêt marine calcul": F.when(stale, marine).otherwise(F.col("`intérêt marine calcul`")),
        "intérêt_par_fiabilité": F.when(stale, scores.whole_composite(index, interest)).otherwise(F.col("intérêt_par_fiabilité")),
        "indice_fiabilite": F.when(stale, index).otherwise(F.col("indice_fiabilite")),
        "indice_interet_naval": interest,
    }
    return found.withColumns(made).select(*[F.col(f"`{c}`") for c in columns], "notation", "region_maritime", *FLAGS)


def rescan(rows: DataFrame, words: Dictionaries, cards: DataFrame, aliases: DataFrame, bans: DataFrame, everything: bool = False) -> DataFrame:
    """The archive after a rescan, without banned rows. ``everything`` classifies titles anew as well."""
    kept = settled(marked(rows, words, cards, aliases, bans))
    return classify_rows(kept, words, cards) if everything else kept


def _counts() -> list:
    kept = ~F.col("_banned")
    return [F.count_if(F.col(f) if f == "_banned" else kept & F.col(f)).alias(n) for f, n in FLAGS.items()]


def counters(found: DataFrame) -> DataFrame:
    """One row: how many rows each kind of change concerns; all but the bans without banned rows. ``found``: from ``marked``."""
    return found.agg(*_counts())


def observed(found: DataFrame) -> tuple[DataFrame, Observation]:
    """``found`` and its counters, which are there once what is made of it has been written: one pass for both."""
    seen = Observation()
    return found.observe(seen, *_counts()), seen


def settled(found: DataFrame) -> DataFrame:
    """Without banned rows and flags."""
    return found.filter(~F.col("_banned")).drop(*FLAGS)
