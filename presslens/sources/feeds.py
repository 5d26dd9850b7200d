"""Feed documents and catalogues, raw logs, landed as files or fetched."""

from __future__ import annotations

import urllib.request
import xml.etree.ElementTree as ET
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from presslens.functions.dates import to_iso
from presslens.operators.merge import unseen

LOG = "media string, titre string, lien string, date string"
AGENT, TIMEOUT, THREADS = "Mozilla/5.0 (presslens)", 20, 16
#: The namespaces of Atom and of Dublin Core.
ATOM, DUBLIN = "{http://www.w3.org/2005/Atom}", "{http://purl.org/dc/elements/1.1/}"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A raw log: semicolons, header, doubled quotes; rows without a title or link go."""
    rows = spark.read.schema(LOG).csv(path, sep=";", header=True, quote='"', escape='"', multiLine=True)
    return rows.filter((F.length("titre") > 0) & (F.length("lien") > 0))


def append_log(rows: DataFrame, path: str) -> None:
    """Rows added to a log folder; every file has the heading."""
    rows.select("media", "titre", "lien", "date").write.mode("append").csv(path, sep=";", header=True, quote='"', escape='"')


def write_seen(hashes: DataFrame, path: str) -> None:
    """The hashes seen so far, each once and sorted, one a line."""
    hashes.select("hash").distinct().orderBy("hash").write.mode("overwrite").text(path)


def read_seen(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumnRenamed("value", "hash")


#: How a catalogue lists a feed, both texts in single quotes, the address as the argument of a call.
LISTED = r"name:\s*'([^']+)'\s*,\s*url:\s*\w+\(\s*'([^']+)'"


def feed_catalogue(text: DataFrame, most: int = 0, order: str | None = None) -> DataFrame:
    """name and url from catalogues written as code (column ``value``, one catalogue a row); the first URL of a name wins.

    In the order of the catalogues (column ``order``) and their entries; ``most`` over 0 takes that many feeds only, for trials.
    """
    found = F.arrays_zip(F.regexp_extract_all("value", F.lit(LISTED), F.lit(1)).alias("name"), F.regexp_extract_all("value", F.lit(LISTED), F.lit(2)).alias("url"))
    place = F.col(order) if order else F.lit(0)
    rows = text.select(place.alias("file"), F.posexplode(found).alias("pos", "f")).select("file", "pos", F.col("f.name").alias("name"), F.col("f.url").alias("url"))
    first = rows.groupBy("name").agg(F.min(F.struct("file", "pos", "url")).alias("first")).select("first.*", "name")
    return (first.orderBy("file", "pos").limit(most) if most else first).select("name", "url")


def fetch(url: str, timeout: float = TIMEOUT) -> bytes:
    with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": AGENT}), timeout=timeout) as answer:
        return answer.read()


def fetch_feeds(feeds: DataFrame, timeout: float = TIMEOUT, threads: int = THREADS) -> DataFrame:
    """media, content and error of feeds (name, url), fetched by the executors; a feed that fails has no content and its error."""

    def one(url: str | None) -> tuple[bytes | None, str | None]:
        try:
            return fetch(url or "", timeout), None
        except Exception as e:  # one feed's failure must not end the others
            return None, str(e)[:80]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(threads) as pool:
            for batch in batches:
                got = list(pool.map(one, batch.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([c for c, _ in got], pa.binary()), pa.array([e for _, e in got], pa.string())], names=["media", "content", "error"])

    return feeds.select("name", "url").mapInArrow(run, "media string, content binary, error string")


def _text(node: ET.Element, *tags: str) -> str:
    """The text of the first of the tags that has any, in the order of the tags."""
    return next((found for found in ((node.findtext(t) or "").strip() for t in tags) if found), "")


def parse_feed(xml: bytes | str | None) -> list[dict[str, str]]:
    """RSS items at any depth, else Atom entries; malformed XML has none. Only un-namespaced RSS tags count, but for Dublin Core's date."""
    try:
        root = ET.fromstring(xml or b"")
    except ET.ParseError:
        return []
    items = [{"title": _text(i, "title"), "link": _text(i, "link"), "date": _text(i, "pubDate", f"{DUBLIN}date")} for i in root.iter("item")]
    if items:
        return items
    out = []
    for entry in root.iter(f"{ATOM}entry"):
        link = entry.find(f"{ATOM}link")
        out.append({"title": _text(entry, f"{ATOM}title"), "link": "" if link is None else link.get("href", "").strip(), "date": _text(entry, f"{ATOM}published", f"{ATOM}updated")})
    return out


@F.pandas_udf(T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("title", "link", "date")])))
def feed_items(xml: pd.Series) -> pd.Series:
    """In Python, as malformed XML must not fail the job and Spark's own XML functions do."""
    return xml.map(parse_feed)


def read_feeds(files: DataFrame) -> DataFrame:
    """media, titre, lien, date of feeds given as (media, content)."""
    rows = files.select("media", F.explode(feed_items("content")).alias("i")).select("media", F.col("i.title").alias("titre"), F.col("i.link").alias("lien"), to_iso(F.col("i.date")).alias("date"))
    return rows.filter((F.length("titre") > 0) & (F.length("lien") > 0))


def collect(files: DataFrame, seen: DataFrame) -> DataFrame:
    """New articles of fetched feeds, with their link's hash; an article in several feeds goes to the first outlet by name."""
    return unseen(read_feeds(files), seen, "lien", [F.col("media"), F.col("date"), F.col("titre")])
