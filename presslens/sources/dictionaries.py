"""Editable dictionary files, parsed on the driver: they are small by nature."""

from __future__ import annotations

import csv
import io
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.operators.classify import CARD, last_cards
from presslens.operators.lookup import sized


def whole_text(spark: SparkSession, path: str) -> str:
    """A small file from whatever store Spark reads."""
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def _lines(text: str):
    for line in text.splitlines():
        line = line.strip()
        if line and not line.startswith("#"):
            yield line


def _named(text: str):
    for line in _lines(text):
        if ":" in line:
            name, _, body = line.partition(":")
            yield name.strip(), [w.strip().lower() for w in body.split(",") if w.strip()]


def classes(text: str) -> list[tuple[str, list[tuple[str, int]]]]:
    """``Class: word, *strong word``; a star makes weight 2."""
    return [(name, [(w.lstrip("*").strip(), 2 if w.startswith("*") else 1) for w in words]) for name, words in _named(text)]


def scale(text: str) -> list[tuple[str, list[tuple[str, int]]]]:
    """``weight: words``; lines whose weight is no integer are skipped."""
    return [(name, [(w, int(name)) for w in words]) for name, words in _named(text) if name.lstrip("-").isdigit()]


def zones(text: str) -> list[tuple[str, list[tuple[str, int]]]]:
    """``Zone: words``, in file order; zones without words are dropped."""
    return [(name, [(w, 1) for w in words]) for name, words in _named(text) if words]


def stop_words(text: str) -> dict[str, tuple[str, ...]]:
    """``code: word, word`` per language, in the order in which ties are decided; to be passed to ``language.detect``."""
    return {name: tuple(words) for name, words in _named(text)}


def bans(text: str) -> list[tuple[str, str]]:
    """One outlet a line, a prefix if it ends in a star; for ``media.patterns``."""
    return [(line, "") for line in _lines(text)]


def _pairs(text: str, heading: str):
    for line in _lines(text):
        if ";" in line and not line.startswith(f"{heading};"):
            left, right = (x.strip() for x in line.split(";", 1))
            yield left, right


def aliases(text: str) -> list[tuple[str, str]]:
    """``alias;name`` under a heading; for ``media.patterns``."""
    return list(_pairs(text, "alias"))


def languages(text: str) -> dict[str, str]:
    """``outlet;language`` under a heading, both in lower case; a later line wins."""
    return {m.lower(): code.lower() for m, code in _pairs(text, "media") if m and code}


def declared(spark: SparkSession, spoken: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(list(spoken.items()), "media string, declared string")


def with_declared(rows: DataFrame, spoken: DataFrame, media: str) -> DataFrame:
    """``rows`` plus ``declared``, the language that the outlet is listed with; null if it is not."""
    listed = spoken.withColumnRenamed("media", "_media")
    return rows.join(sized(listed), F.lower(F.trim(F.col(media))) == F.col("_media"), "left").drop("_media")


def json_map(text: str) -> dict[str, str]:
    """A flat JSON object, of regions by country for one."""
    return {k: str(v) for k, v in json.loads(text).items()}


def cards(spark: SparkSession, text: str) -> DataFrame:
    """Cards of outlets from ``;`` separated lines with a heading; one per outlet, the last wins."""
    names = [c.split()[0] for c in CARD.split(", ")]
    rows = [(i, *[r.get(n) or "" for n in names]) for i, r in enumerate(csv.DictReader(io.StringIO(text), delimiter=";"))]
    return last_cards(spark.createDataFrame(rows, f"_line int, {CARD}"), [F.col("_line")])
