"""Keyword matching in one pass over each text, scores over it, and context rules.

A keyword is found where it stands in the text and neither a word character nor an apostrophe comes right before it, nor a word character
right after it. All keywords of all dictionaries are one automaton (Aho-Corasick), made once in a worker; a text goes through it
once, whatever the number of keywords, and only the characters around what it finds are looked at. Texts go to it in Arrow batches and only
numbers come back. (Tokens looked up in hash sets by higher-order functions, all inside the JVM, took three times as long.)

A dictionary is made on the driver, so its size is known. Up to ``LITERAL_BYTES`` it goes along with the plan. A larger one is broadcast in
parts of ``BROADCAST_BYTES`` at most, one automaton each; what they find, numbers again, meets the entries in a join. Either way every text is
matched where it lies.
"""

from __future__ import annotations

import functools
from array import array
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions.text import head_token, norm_word, once, trim
from presslens.operators.lookup import BROADCAST_BYTES, LITERAL_BYTES, literal, sized

ENTRY = "kw_id int, class string, ord int, kw string, weight int"
FIELDS = tuple(c.split()[0] for c in ENTRY.split(", "))
#: No keyword begins after one of these.
APOSTROPHES = ("'", "’")


@dataclass(frozen=True)
class Dictionary:
    """Entries (kw_id, class, ord, kw, weight)."""

    rows: tuple[tuple, ...]

    @property
    def size(self) -> int:
        return sum(len(str(v).encode()) for row in self.rows for v in row)


def dictionary(entries: list[tuple[str, list[tuple[str, int]]]], normalise: bool = False) -> Dictionary:
    """Classes in file order, each with (keyword, weight); an entry that is listed twice counts twice.

    Texts are matched in normal form (``text.norm``), keywords as they are written unless ``normalise`` is set: a keyword with
    composed accents then never matches.
    """
    rows = []
    for order, (name, words) in enumerate(entries):
        for word, weight in words:
            word = norm_word(word) if normalise else word
            if head_token(word) is None:
                raise ValueError(f"a keyword must start with a word character: {word!r}")
            rows.append((len(rows), name, order, word, weight))
    return Dictionary(tuple(rows))


def together(books: dict[str, Dictionary]) -> tuple[Dictionary, dict[str, tuple[int, int]]]:
    """Several dictionaries as one, and the range of numbers that each one's entries have in it."""
    rows, spans = [], {}
    for name, book in books.items():
        spans[name] = (len(rows), len(rows) + len(book.rows))
        rows += [(len(rows) + i, *row[1:]) for i, row in enumerate(book.rows)]
    return Dictionary(tuple(rows)), spans


@functools.lru_cache(maxsize=16)
def _automaton(words: tuple[str, ...]) -> ahocorasick.Automaton:
    """Of each word, its numbers (more where it is listed again) and its length."""
    numbers: dict[str, list[int]] = {}
    for i, word in enumerate(words):
        numbers.setdefault(word, []).append(i)
    made = ahocorasick.Automaton()
    for word, own in numbers.items():
        made.add_word(word, (own, len(word)))
    made.make_automaton()
    return made


def _word(letter: str) -> bool:
    return letter.isalnum() or letter == "_"


def places_in(text: str, words: tuple[str, ...]) -> dict[int, int]:
    """The number of each word found, and where it begins first, from 1."""
    found: dict[int, int] = {}
    for end, (numbers, length) in _automaton(words).iter(text):
        at = end - length
        if numbers[0] in found or (at >= 0 and (_word(text[at]) or text[at] in APOSTROPHES)) or (end + 1 < len(text) and _word(text[end + 1])):
            continue
        found.update(dict.fromkeys(numbers, at + 2))
    return found


def _ints(numbers: array) -> pa.Array:
    return pa.array(np.frombuffer(numbers, np.int32), pa.int32())


def _places(words: tuple[str, ...] | Broadcast):
    """(n, pos) of the words found in each text; ``words`` themselves or a broadcast of them."""

    def run(texts: pa.Array) -> pa.Array:
        trim()
        offsets, numbers, places = array("i", [0]), array("i"), array("i")
        held = words if isinstance(words, tuple) else words.value
        for one in texts:  # a batch may be 64 MB, so its texts are strings one at a time
            text = one.as_py()
            found = places_in(text, held) if text else {}
            numbers.extend(found.keys())
            places.extend(found.values())
            offsets.append(len(numbers))
        pairs = pa.StructArray.from_arrays([_ints(numbers), _ints(places)], names=["n", "pos"])
        return pa.ListArray.from_arrays(_ints(offsets), pairs)

    return F.arrow_udf(run, "array<struct<n:int,pos:int>>")


def hits_in(text: Column, words: Dictionary) -> Column:
    """The entries found in a text: array of kw_id, class, ord, kw, weight, pos (1-based, of the first hit)."""
    kind = f"struct<{ENTRY.replace(' ', ':').replace(',:', ',')}>"
    if not words.rows:
        return F.array().cast(f"array<{kind[:-1]},pos:int>>")
    entries = literal([dict(zip(FIELDS, row, strict=False)) for row in words.rows], f"array<{kind}>")

    def entry(hit: Column) -> Column:
        e = F.get(entries, hit["n"])
        return F.struct(*[e[n].alias(n) for n in FIELDS], hit["pos"].alias("pos"))

    return F.transform(_places(tuple(row[3] for row in words.rows))(text), entry)


def hits_by(text: Column, books: dict[str, Dictionary]) -> Column:
    """A struct with the hits of each dictionary; the text is searched once for all."""
    every, spans = together(books)

    def of(span: tuple[int, int]):
        return lambda h: (h["kw_id"] >= span[0]) & (h["kw_id"] < span[1])

    return once(hits_in(text, every), lambda hits: F.struct(*[F.filter(hits, of(span)).alias(name) for name, span in spans.items()]))


def keyword_hits(texts: DataFrame, words: Dictionary, key: str = "id", text: str = "norm_text", literal_bytes: int = LITERAL_BYTES, part_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """One row per text and entry found: key, kw_id, class, ord, kw, weight, pos."""
    if words.size <= literal_bytes:
        return texts.select(key, F.explode(hits_in(F.col(text), words)).alias("_h")).select(key, "_h.*")
    spark, found, at = texts.sparkSession, [], 0
    while at < len(words.rows):
        size, end = 0, at
        while end < len(words.rows) and (end == at or size + len(words.rows[end][3].encode()) <= part_bytes):
            size += len(words.rows[end][3].encode())
            end += 1
        held = spark.sparkContext.broadcast(tuple(row[3] for row in words.rows[at:end]))
        places = texts.select(key, F.explode(_places(held)(F.col(text))).alias("_h"))
        found.append(places.select(key, (F.col("_h.n") + at).alias("kw_id"), F.col("_h.pos").alias("pos")))
        at = end
    every = functools.reduce(DataFrame.unionByName, found)
    return every.join(sized(spark.createDataFrame(list(words.rows), ENTRY)), "kw_id").select(key, *FIELDS, "pos")


def class_scores(hits: DataFrame, key: str = "id") -> DataFrame:
    return hits.groupBy(key, "class", "ord").agg(F.sum("weight").alias("score"), F.min("pos").alias("pos"))


def top_class(scores: DataFrame, key: str = "id") -> DataFrame:
    """Highest score, then earliest hit, then file order."""
    best = F.max_by(F.struct("class", "score"), F.struct(F.col("score"), -F.col("pos"), -F.col("ord")))
    return scores.groupBy(key).agg(best.alias("best")).select(key, F.col("best.class").alias("class"), F.col("best.score").alias("score"))


def total_score(hits: DataFrame, key: str = "id", cap: int | None = None) -> DataFrame:
    total = F.sum("weight")
    return hits.groupBy(key).agg((F.least(total, F.lit(cap)) if cap else total).alias("score"))


def best_zone(hits: DataFrame, key: str = "id") -> DataFrame:
    """The class with most entries found; a tie goes to the first in the file."""
    counts = hits.groupBy(key, "class", "ord").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(key).agg(F.max_by("class", F.struct(F.col("n"), -F.col("ord"))).alias("zone"))


def ranked(hits: Column) -> Column:
    """The classes of a row's hits: array of (score, early, first, n, class), best last when sorted."""

    def classes(held: Column) -> Column:
        def of_class(order: Column) -> Column:
            mine = F.filter(held, lambda h: h["ord"] == order)
            score = F.aggregate(mine, F.lit(0), lambda a, h: a + h["weight"])
            return F.struct(score.alias("score"), (-F.array_min(F.transform(mine, lambda h: h["pos"]))).alias("early"), (-order).alias("first"), F.size(mine).alias("n"), F.get(mine, 0)["class"].alias("class"))

        return F.transform(F.array_distinct(F.transform(held, lambda h: h["ord"])), of_class)

    return once(hits, classes)


def top_in(hits: Column) -> Column:
    """(score, class) of a row's best class: score, then earliest hit, then file order; null without hits."""
    return F.array_max(ranked(hits))


def total_in(hits: Column, cap: int | None = None) -> Column:
    total = F.aggregate(hits, F.lit(0), lambda a, h: a + h["weight"])
    return F.least(total, F.lit(cap)) if cap is not None else total


def zone_in(hits: Column) -> Column:
    """The class with most entries found, empty without any; a tie goes to the first in the file."""
    return F.coalesce(F.array_max(F.transform(ranked(hits), lambda r: F.struct(r["n"], r["first"], r["class"])))["class"], F.lit(""))


def countries_in(hits: Column) -> Column:
    """How many classes have a strong word (weight 2)."""
    return F.size(F.array_distinct(F.transform(F.filter(hits, lambda h: h["weight"] == 2), lambda h: h["ord"])))


def substring_labels(texts: DataFrame, labels: dict[str, list[str]], text: str) -> DataFrame:
    """One row per text and label with any of its terms inside the text, words or not."""
    found = F.array(*[F.when(_any_of(F.lower(F.col(text)), terms), F.lit(name)) for name, terms in labels.items()])
    return texts.withColumn("label", F.explode(F.filter(found, lambda x: x.isNotNull())))


def label_counts(texts: DataFrame, labels: dict[str, list[str]], text: str) -> DataFrame:
    """label and n, the number of texts with any of its terms; labels that no text has are listed with 0."""
    lowered = F.lower(F.col(text))
    counts = texts.agg(*[F.count_if(_any_of(lowered, terms)).alias(f"n{i}") for i, terms in enumerate(labels.values())])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(name).alias("label"), F.col(f"n{i}").alias("n")) for i, name in enumerate(labels)])).alias("x")).select("x.*")


def _any_of(text: Column, terms: list[str]) -> Column:
    out = F.lit(False)
    for term in terms:
        out = out | text.contains(term)
    return out


@dataclass(frozen=True)
class Rule:
    """A class; parts that must all hold, each a list of words of which one must occur, ``@pays`` being one more country."""

    name: str
    parts: tuple[tuple[str, ...], ...]
    negatives: tuple[str, ...] = ()


def parse_rule(line: str) -> Rule | None:
    """``Class: a|b + @pays + !c``; None for comments and lines without a colon."""
    line = line.strip()
    if not line or line.startswith("#") or ":" not in line:
        return None
    name, _, body = line.partition(":")
    parts, negatives = [], []
    for piece in filter(None, (x.strip().lower() for x in body.split("+"))):
        if piece.startswith("!"):
            negatives += [w.strip() for w in piece[1:].split("|") if w.strip() and w.strip() != "@pays"]
        else:
            parts.append(tuple(w.strip() for w in piece.split("|") if w.strip()))
    return Rule(name.strip(), tuple(parts), tuple(negatives))


def rule_words(rules: list[Rule]) -> Dictionary:
    """The words of rules, each once, to be found with the keywords of the dictionaries."""
    every = dict.fromkeys(w for rule in rules for part in (*rule.parts, rule.negatives) for w in part if w != "@pays")
    return Dictionary(tuple((i, "", 0, word, 0) for i, word in enumerate(every)))


def first_rule(text: Column, countries: Column, rules: list[Rule], found: Column | None = None) -> Column:
    """The first rule that holds, as a class; ``countries`` is the number of distinct countries with a strong word. ``found``: the hits of ``rule_words``, if at hand."""

    said = F.transform(hits_in(text, rule_words(rules)) if found is None else found, lambda h: h["kw"])
    out = F.lit(None).cast("string")
    for rule in reversed(rules):
        needed = sum(part == ("@pays",) for part in rule.parts)
        holds = countries >= needed
        for part in rule.parts:
            if part == ("@pays",):
                continue
            test = _any_said(said, [w for w in part if w != "@pays"])
            holds = holds & ((test | (countries >= needed + 1)) if "@pays" in part else test)
        if rule.negatives:
            holds = holds & ~_any_said(said, list(rule.negatives))
        out = F.when(holds, F.lit(rule.name)).otherwise(out)
    return out


def _any_said(said: Column, words: list[str]) -> Column:
    return F.coalesce(F.arrays_overlap(said, F.array(*map(F.lit, words))), F.lit(False)) if words else F.lit(False)


#: Themes of an outlet whose seat stands for the country of its articles, and what an article without one gets.
SEAT_THEMES, NO_COUNTRY = ("Local/Régional", "Politique"), "Undetermined"


def country_confidence(score: Column, country: Column, headquarters: Column, media_theme: Column) -> Column:
    """(country, confidence): a score of 2 or more names it, else a local or political outlet's seat, else undetermined."""

    def pair(value: Column, said: str) -> Column:
        return F.struct(value.alias("country"), F.lit(said).alias("confidence"))

    seat = media_theme.isin(*SEAT_THEMES) & (F.coalesce(headquarters, F.lit("")) != "")
    return F.when(score >= 3, pair(country, "high")).when(score == 2, pair(country, "medium")).when(seat, pair(headquarters, "media-default")).otherwise(pair(F.lit(NO_COUNTRY), "none"))
