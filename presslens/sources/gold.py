"""Articles labelled by hand, and the evaluation of the classifier on them."""

from __future__ import annotations

import functools
import io
import xml.etree.ElementTree as ET
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.operators import explore

GOLD = ("nom_du_media", "titre", "country_headquarters", "sujet_media", "sujet_article", "country_article")


#: The namespace of sheets in a workbook.
SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def sheet_rows(content: bytes) -> list[list[str | None]]:
    """The cells of a workbook's first sheet, as texts: shared, inline and plain values; empty cells are null."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names = book.namelist()
        shared = []
        if "xl/sharedStrings.xml" in names:
            shared = ["".join(t.text or "" for t in item.iter(f"{SHEET}t")) for item in ET.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{SHEET}si")]
        first = min((n for n in names if n.startswith("xl/worksheets/sheet")), key=lambda n: (len(n), n))
        rows = []
        for row in ET.fromstring(book.read(first)).iter(f"{SHEET}row"):
            cells: dict[int, str | None] = {}
            for cell in row.iter(f"{SHEET}c"):
                letters = "".join(x for x in cell.get("r", "") if x.isalpha())
                at = functools.reduce(lambda n, x: 26 * n + ord(x) - 64, letters, 0) - 1 if letters else len(cells)
                value, kind = cell.findtext(f"{SHEET}v"), cell.get("t")
                cells[at] = "".join(t.text or "" for t in cell.iter(f"{SHEET}t")) if kind == "inlineStr" else shared[int(value)] if kind == "s" and value is not None else value
            rows.append([cells.get(i) for i in range(max(cells, default=-1) + 1)])
    return rows


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    """A labelled table as Parquet, CSV with semicolons, or the first sheet of a workbook, by the path's ending. Workbooks are small: they are read on the driver."""
    if path.endswith(".xlsx"):
        rows = sheet_rows(bytes(spark.read.format("binaryFile").load(path).select("content").first()[0]))
        names = [c or "" for c in rows[0]]
        found = spark.createDataFrame([(i, *(r + [None] * len(names))[: len(names)]) for i, r in enumerate(rows[1:])], "line long, " + ", ".join(f"`{n}` string" for n in names))
    elif path.endswith(".csv"):
        found = spark.read.csv(path, sep=";", header=True, quote='"', escape='"', multiLine=True)
    else:
        found = spark.read.parquet(path)
    return found if "line" in found.columns else found.withColumn("line", F.monotonically_increasing_id())


def gold_country(country: Column) -> Column:
    """The country under the dictionary's name."""
    return F.when(country == "Hong-Kong", "Hong Kong").otherwise(country)


def eligible(rows: DataFrame, theme: str = "sujet_article", country: str = "country_article") -> DataFrame:
    """Rows with a usable theme or country."""
    return rows.filter(~explore.is_junk(F.col(theme)) | ~explore.is_junk(F.col(country)))


def report(rows: DataFrame, theme: str = "theme", country: str = "country") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Agreement on themes and countries, recall per theme, most frequent confusions; ``theme`` and ``country`` are the predictions."""
    usable = eligible(rows)
    overall = explore.accuracy(usable, {"theme": (F.col("sujet_article"), F.col(theme)), "country": (gold_country(F.col("country_article")), F.col(country))})
    themed = usable.filter(~explore.is_junk(F.col("sujet_article")))
    return overall, explore.recall(themed, "sujet_article", theme).orderBy(F.desc("support"), "sujet_article"), explore.confusions(themed, "sujet_article", theme)
