"""Alignment of two tokenizers' tokens by an event sweep.

Every text, with one space before it, is encoded by a byte-level BPE (A) and by a sentence-piece BPE (B). Two branches emit the
tokens' end events, A's and B's; an event row holds the ids of the tokens of one tokenizer that end in one window of
``WINDOW`` bytes, from which their ends follow by summing the tokens' lengths. The union is dealt out by document, sorted within
partitions by window, and streamed through a machine that holds one window and the tokens of the group that is still open. Where
A and B tokens both end, a group ends; the two tokens that end there are a link.

How often an id pair is linked in the whole corpus is counted from the links that the sweep wrote. The ``FREQUENT`` most frequent
pairs go to every task (their number is the bound of what is broadcast); links of all other pairs meet their counts in a join.

Encoding works on chunks: a word with the spaces before it. Neither A's pattern nor a piece of B reaches from a character that is
not white space over a following space, so chunks are encoded independently: known ones are looked up, the others of a text go
through the tokenizer together.

Cases: a null or empty text, and one whose tokens' bytes are not the space and the text again, has no tokens: zeros and an empty
digest. A document is a row: rows that repeat are swept once and returned as often as they come, and their links count each
time. A null doc_id is a document's like any other. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import json
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm.common import discard, documents, materialise, spread_copies, thrifty

VOCABULARY_A, VOCABULARY_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Bytes of text whose end events are one row.
WINDOW = 1 << 13
#: Pairs whose counts go to every task.
FREQUENT = 1 << 17
#: Chunks of at most so many characters are remembered, so many a task.
SHORT, REMEMBERED = 48, 1 << 17
#: Links in one row of the sweep's table.
LINKS = 1 << 16
#: An id pair is one number, A's id times this and B's id.
BASE = 1 << 16
KEY = ("doc_id", "digest", "part")

EVENTS = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("part", pa.int32()), ("at", pa.int64()), ("kind", pa.int32()), ("void", pa.bool_()), ("start", pa.int64()), ("ids", pa.binary())])
EVENTS_DDL = "doc_id long, digest binary, part int, at long, kind int, void boolean, start long, ids binary"
SWEPT = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("part", pa.int32()), ("copies", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("links", pa.binary())])
SWEPT_DDL = "doc_id long, digest binary, part int, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"


@dataclass
class Coder:
    """A tokenizer: a function from texts that begin with a space to ids, and the bytes of each id (empty for those that no text has)."""

    encode: Callable[[str], list[int]]
    pieces: list[bytes]

    def __post_init__(self) -> None:
        self.lengths = np.array([len(p) for p in self.pieces], np.int64)
        self.known: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes | None:
        """The ids of a space and ``text``, two bytes each; None if their bytes are not the space and the text."""
        parts = text.split(" ")
        found = list(map(self.known.get, parts))
        chunks, places, at = [], [], 0
        while at < len(parts):
            if found[at] is not None:
                at += 1
                continue
            end = at + 1
            while end < len(parts) and (not parts[end - 1] or parts[end - 1][-1].isspace()):  # the next space belongs to the same white space
                end += 1
            found[at:end] = [b""] * (end - at)
            chunks.append(parts[at] if end == at + 1 else " ".join(parts[at:end]))
            places.append(at)
            at = end
        if chunks and not self._encode_chunks(chunks, places, found):
            return None
        return b"".join(found)

    def _encode_chunks(self, chunks: list[str], places: list[int], found: list[bytes]) -> bool:
        """All chunks that are not known go through the tokenizer side by side; where each ends follows from its bytes."""
        said = " " + " ".join(chunks)
        ids = self.encode(said)
        if b"".join([self.pieces[i] for i in ids]) != said.encode():
            return False
        packed = np.array(ids, np.uint16)
        sizes = [len(c) + 1 for c in chunks] if said.isascii() else [len(c.encode()) + 1 for c in chunks]
        cuts = np.searchsorted(np.cumsum(self.lengths[packed]), np.cumsum(sizes)) + 1
        raw, since = packed.tobytes(), 0
        for place, chunk, cut in zip(places, chunks, cuts.tolist(), strict=True):
            own = found[place] = raw[2 * since : 2 * cut]
            since = cut
            if len(chunk) <= SHORT and len(self.known) < REMEMBERED and chunk and not chunk[-1].isspace() and " " not in chunk:
                self.known[chunk] = own
        return True


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 for itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


@functools.cache
def coder_a(path: str | None = None) -> Coder:
    """Byte-level BPE of a vocabulary in JSON. Merges are listed in the order of their ids, so the ids serve as ranks."""
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path(VOCABULARY_A), encoding="utf-8") as file:
        vocabulary = json.load(file)["model"]["vocab"]
    letters = _byte_letters()
    ranks = {bytes([letters[x] for x in entry]): i for entry, i in vocabulary.items() if all(x in letters for x in entry)}
    made = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece
    return Coder(made.encode_ordinary, pieces)


@functools.cache
def coder_b(path: str | None = None) -> Coder:
    """Sentence-piece BPE, which puts the space before by itself."""
    import public_tokenizers
    import sentencepiece

    made = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY_B))
    pieces = []
    for i in range(made.get_piece_size()):
        piece = made.id_to_piece(i)
        pieces.append(bytes([int(piece[3:-1], 16)]) if made.is_byte(i) else b"" if made.is_control(i) or made.is_unknown(i) else piece.replace("▁", " ").encode())
    space = [made.piece_to_id("▁")]
    return Coder(lambda said: made.encode(said[1:]) if len(said) > 1 else space, pieces)


CODERS = (coder_a, coder_b)


def _events(kind: int, path: str | None):
    """The rows of one tokenizer: for each document a header (window -1), then its ids by the window in which they end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = CODERS[kind](path)
        for batch in batches:
            doc_ids, parts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            rows: list[tuple] = []
            for doc_id, value, part in zip(doc_ids, batch.column(1), parts, strict=True):
                text = value.as_py() or ""
                digest = hashlib.sha256(text.encode()).digest() + (b"" if value.is_valid else b"0")
                packed = coder.ids(text) if text else None
                rows.append((doc_id, digest, part, -1, kind, packed is None, 0, b""))
                if packed is not None:
                    ends = np.cumsum(coder.lengths[np.frombuffer(packed, np.uint16)])
                    window = (ends - 1) // WINDOW
                    cuts = np.flatnonzero(np.diff(window)) + 1
                    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ends)], strict=True):
                        rows.append((doc_id, digest, part, int(window[a]), kind, False, int(ends[a - 1]) if a else 0, packed[2 * a : 2 * b]))
                if len(rows) > 2048:
                    yield _batch(rows, EVENTS)
                    rows = []
            if rows:
                yield _batch(rows, EVENTS)

    return thrifty(run)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def events(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The end events of both tokenizers, in document order. ``part`` only spreads documents that repeat."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.spark_partition_id().alias("part"))
    both = texts.mapInArrow(_events(0, path_a), EVENTS_DDL).unionByName(texts.mapInArrow(_events(1, path_b), EVENTS_DDL))
    return both.repartition(*KEY).sortWithinPartitions(*KEY, "at", "kind")


@dataclass
class Groups:
    """Closed groups: the common ends, and for each side the ids, the group of each and whether it ends its group."""

    ends: np.ndarray
    ids: tuple[np.ndarray, np.ndarray]
    group: tuple[np.ndarray, np.ndarray]
    closes: tuple[np.ndarray, np.ndarray]


@dataclass
class Machine:
    """What is open in one document: per side, ids and ends of the tokens that no common end has closed yet."""

    lengths: tuple[np.ndarray, np.ndarray]
    ids: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.int64)] * 2)
    ends: list[np.ndarray] = field(default_factory=lambda: [np.zeros(0, np.int64)] * 2)

    def feed(self, kind: int, start: int, packed: bytes) -> None:
        ids = np.frombuffer(packed, np.uint16).astype(np.int64)
        self.ids[kind] = np.concatenate([self.ids[kind], ids])
        self.ends[kind] = np.concatenate([self.ends[kind], start + np.cumsum(self.lengths[kind][ids])])

    def close(self) -> Groups | None:
        """The groups that are complete; the rest stays open."""
        common = np.intersect1d(self.ends[0], self.ends[1], assume_unique=True)
        if not len(common):
            return None
        ids, group, closes = [], [], []
        for k in (0, 1):
            n = int(np.searchsorted(self.ends[k], common[-1], "right"))
            ids.append(self.ids[k][:n])
            group.append(np.searchsorted(common, self.ends[k][:n]))
            closes.append(common[group[k]] == self.ends[k][:n])
            self.ids[k], self.ends[k] = self.ids[k][n:], self.ends[k][n:]
        return Groups(common, tuple(ids), tuple(group), tuple(closes))


def _documents(batches: Iterator[pa.RecordBatch], lengths: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[tuple, int, Groups | None]]:
    """(key, copies, groups) per closed window, and at a document's end (key, copies, None)."""
    key, copies, void, machine, last = None, 0, False, None, (-1, -1)
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for doc_id, digest, part, at, kind, gone, start, packed in zip(*columns, strict=True):
            if key != (doc_id, digest, part):
                if key is not None:
                    if machine and (made := machine.close()):
                        yield key, copies, made
                    yield key, copies, None
                key, copies, void, machine, last = (doc_id, digest, part), 0, False, Machine(lengths), (-1, -1)
            if at < 0:
                copies, void = copies + (kind == 0), void or gone
            elif not void and (at, kind) != last:  # rows of a copy come next to each other
                if last[0] not in (-1, at) and (made := machine.close()):
                    yield key, copies, made
                machine.feed(kind, start, packed)
                last = (at, kind)
    if key is not None:
        if machine and (made := machine.close()):
            yield key, copies, made
        yield key, copies, None


def _interleaved(made: Groups) -> tuple[np.ndarray, np.ndarray]:
    """The places of A's and B's tokens when every group lists its A tokens, then its B tokens."""
    n = len(made.ends)
    in_a, in_b = np.bincount(made.group[0], minlength=n), np.bincount(made.group[1], minlength=n)
    before_b, with_a = np.cumsum(in_b) - in_b, np.cumsum(in_a)
    return np.arange(len(made.ids[0])) + before_b[made.group[0]], np.arange(len(made.ids[1])) + with_a[made.group[1]]


@functools.cache
def _said(n: int) -> np.ndarray:
    """The decimal ids below ``n`` with what may follow: a comma, a bar, a semicolon."""
    made = np.empty(3 * n, object)
    for i in range(n):
        made[3 * i : 3 * i + 3] = [b"%d," % i, b"%d|" % i, b"%d;" % i]
    return made


def _digester(path_a: str | None, path_b: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = coder_a(path_a), coder_b(path_b)
        said, rows, size = _said(max(len(a.pieces), len(b.pieces))), [], 0
        counts, sha, links, held = [0] * 4, hashlib.sha256(), [], 0
        for key, copies, made in _documents(batches, (a.lengths, b.lengths)):
            if made:
                place = _interleaved(made)
                order = np.empty(len(made.ids[0]) + len(made.ids[1]), np.int64)
                order[place[0]] = 3 * made.ids[0] + made.closes[0]
                order[place[1]] = 3 * made.ids[1] + 2 * made.closes[1]
                sha.update((b";" if counts[2] else b"") + b"".join(said[order].tolist())[:-1])
                pairs = (made.ids[0][made.closes[0]] * BASE + made.ids[1][made.closes[1]]).astype(np.uint32)
                counts = [x + y for x, y in zip(counts, (len(made.ids[0]), len(made.ids[1]), len(made.ends), len(pairs)), strict=True)]
                links.append(pairs)
                held += len(pairs)
                if held >= LINKS:
                    rows.append((*key, copies, 0, 0, 0, 0, None, np.concatenate(links).tobytes()))
                    size, links, held = size + held, [], 0
            else:
                rows.append((*key, copies, *counts, sha.hexdigest() if counts[2] else "", np.concatenate(links).tobytes() if links else b""))
                size += held
                counts, sha, links, held = [0] * 4, hashlib.sha256(), [], 0
            if size > 4 * LINKS or len(rows) > 2048:
                yield _batch(rows, SWEPT)
                rows, size = [], 0
        if rows:
            yield _batch(rows, SWEPT)

    return thrifty(run)


def sweep(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Per document (``KEY``, ``copies``): the counts of tokens, groups and links, the groups' digest, and the links as packed pairs. Long documents have further rows with links alone, without a digest."""
    return events(docs, path_a, path_b).mapInArrow(_digester(path_a, path_b), SWEPT_DDL)


GROUP_DDL = "doc_id long, digest binary, start long, end long, a_ids array<int>, b_ids array<int>, copies long"


def _lister(path_a: str | None, path_b: str | None):
    names = [x.split()[0] for x in GROUP_DDL.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        since = 0
        for key, copies, made in _documents(batches, (coder_a(path_a).lengths, coder_b(path_b).lengths)):
            if made is None:
                since = 0
                continue
            n, ends = len(made.ends), made.ends.tolist()
            lists = [pa.ListArray.from_arrays(pa.array(np.searchsorted(made.group[k], np.arange(n + 1)).astype(np.int32)), pa.array(made.ids[k].astype(np.int32))) for k in (0, 1)]
            columns = [pa.array([key[0]] * n, pa.int64()), pa.array([key[1]] * n, pa.binary()), pa.array([since, *ends[:-1]], pa.int64()), pa.array(ends, pa.int64()), *lists, pa.array([copies] * n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=names)
            since = ends[-1]

    return thrifty(run)


def aligned_groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The groups themselves, one row each: byte range in a space and the text, A's and B's ids; the last of both are linked."""
    return events(docs, path_a, path_b).mapInArrow(_lister(path_a, path_b), GROUP_DDL)


def _pair_counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        by_copies: dict[int, list[np.ndarray]] = {}
        for copies, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            by_copies.setdefault(copies, []).append(np.frombuffer(packed.as_py(), np.uint32))
        for copies, held in by_copies.items():
            every = np.sort(np.concatenate(held))
            first = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]])) if len(every) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(every))) * copies
            yield pa.RecordBatch.from_arrays([pa.array(every[first].astype(np.int64)), pa.array(n, pa.int64())], names=["pair", "n"])


def pair_counts(swept: DataFrame) -> DataFrame:
    """pair, n (its links in the corpus) and best (no pair of the same B id has more)."""
    counts = materialise(swept.select("copies", "links").mapInArrow(_pair_counter, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair") % BASE
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))  # at most one row per entry of B's vocabulary
    made = counts.join(F.broadcast(most), b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    made.stored_at = counts.stored_at
    return made


def _looker(frequent):
    """Adds up the counts of links whose pair is frequent; the pairs of the others follow as rows, with the number of links of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = frequent.value
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                codes = np.frombuffer(row["links"], np.uint32).astype(np.int64)
                at = np.minimum(np.searchsorted(pairs, codes), max(len(pairs) - 1, 0))
                hit = pairs[at] == codes if len(pairs) else np.zeros(len(codes), bool)
                key = tuple(row[k] for k in KEY)
                rows.append((*key, -1 - zlib.crc32(row["digest"]), 0, *[row[c] for c in ("copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")], int(counts[at[hit]].sum()), int(best[at[hit]].sum())))
                others, times = np.unique(codes[~hit], return_counts=True)
                rows += [(*key, p, k, None, 0, 0, 0, 0, None, 0, 0) for p, k in zip(others.tolist(), times.tolist(), strict=True)]
            if rows:
                yield _batch(rows, LOOKED)

    return thrifty(run)


LOOKED = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("part", pa.int32()), ("pair", pa.int64()), ("k", pa.int64()), ("copies", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("s", pa.int64()), ("t", pa.int64())])
LOOKED_DDL = "doc_id long, digest binary, part int, pair long, k long, copies long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, s long, t long"


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, most_frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = docs.sparkSession
    swept = materialise(sweep(docs, path_a, path_b), "swept")
    pairs = materialise(counted := pair_counts(swept), "counts")
    discard(counted)
    top = pairs.orderBy(F.desc("n"), "pair").limit(most_frequent).toArrow()
    counts, codes, best = (top.column(c).to_numpy() for c in ("n", "pair", "best"))
    order = np.argsort(codes)
    frequent = spark.sparkContext.broadcast((codes[order].astype(np.int64), counts[order].astype(np.int64), best[order].astype(np.int64)))
    least, final = (int(counts[-1]), int(codes[-1])) if len(codes) else (1 << 62, -1)
    others = pairs.filter((F.col("n") < least) | ((F.col("n") == least) & (F.col("pair") > final))).select(F.col("pair").alias("_pair"), "n", "best")
    looked = swept.mapInArrow(_looker(frequent), LOOKED_DDL)
    joined = looked.join(others, F.col("pair") == F.col("_pair"), "left")
    times = F.coalesce(F.col("n"), F.lit(0))
    totals = [F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")]
    summed = joined.groupBy(*KEY).agg(*totals, F.max("copies").alias("copies"), F.max("groups_sha256").alias("groups_sha256"), F.sum(F.col("s") + F.col("k") * times).alias("count_sum"), F.sum(F.col("t") + F.when(F.col("best"), F.col("k")).otherwise(0)).alias("n_best"))
    return spread_copies(summed, "copies", "_copy").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(documents(spark, sf_dir))
