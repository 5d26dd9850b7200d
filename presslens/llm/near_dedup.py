"""N-gram Jaccard join by parity sketches.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. Documents with equal sets are one class, found by
a 64-bit digest; only classes are joined.

Sketches: a token flips one bit of a class's parity sketch, at a place its hash names; two sketches differ in at most as many bits
(their Hamming distance) as the sets have tokens in their symmetric difference. A sketch of half the bits is the exclusive or of
both halves, so sketches of any two lengths (powers of two, at least two bits a token) can be compared. In a size band, tokens are
dealt into ``p`` cells, and the hashes of a cell are XORed: a parity sketch of 64 bits whose difference shows in the cell as a whole.

Pigeonhole join: sets of sizes a <= b with similarity of 0.8 or more differ in at most ``(a + b) // 9`` tokens and have
``b <= 1.25 * a``. Bands grow by 1.25, a set takes part in its own band and the next, and a band has more cells than its largest
difference; so two such sets have at least ``need`` equal cells in some band that are not empty. A set that has none to spare sends
its empty cells too.

1. Cells are packed by block of documents into one binary per bucket of keys and sorted in Arrow groups. Cells that two classes or
   more share come out as rows, one per class; classes that share fewer than ``need`` cells in a band have no partner there and go.
2. Each class is paired with one class of each of its cells: the one with most shared cells, which in a family of copies is the one
   nearest to all. Pairs that the sketches' Hamming distance cannot rule out are verified, the links make components.
3. What is left are cells that hold several components. Two similar sets share at least ``need`` cells, so they meet in the rarest
   cells of each, all but ``need`` - 1 of them. Classes of different components that meet there are compared by sketches in the
   join, and verified.

No link between components is lost, and pairs inside a component are not listed, so rows grow with the classes and not with the square
of a family.

Verification counts the shingles of both texts, word by word. Texts that are wanted are found by a broadcast of their keys while these are
at most ``BROADCAST_KEYS``, by a shuffle join beyond.

Cases: null or empty texts, and texts without words, have empty sets and link with nothing; texts with one to four words are
one shingle; very long texts are sets like others; rows that repeat are in one class; a class without any doc_id has a null
component; an empty table gives an empty result; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm.common import discard, documents, lean, materialise, text_bytes, thrifty, trim
from presslens.llm.components import components

SHINGLE = 5
#: Similarity of at least 80 %, as integers: 100 * intersection >= 80 * union.
PERCENT = 80
#: Cells that a bucket of keys holds on average, and that a block packs at once.
BUCKET_CELLS = 1 << 20
BLOCK_CELLS = 1 << 20
DESCRIBED_ROWS = 4096
BROADCAST_KEYS = 1 << 20
#: Cells per character of text, in the mean; it sets the number of buckets.
CELLS_PER_CHAR = 0.1
#: Bits of a key inside its bucket.
KEY_BITS = 40
_KEY = np.uint64((1 << KEY_BITS) - 1)
_BANDS = [math.ceil(1.25**i - 1e-9) for i in range(90)]
_THRESHOLDS = np.array(_BANDS, np.int64)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 150_000:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


def shingles(raw: bytes, hashes: dict[bytes, int]) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = raw.translate(_LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n = min(SHINGLE, len(h))
    total = np.zeros(len(h) - n + 1, np.uint64)
    for i in range(n):
        total += h[i : len(h) - n + 1 + i] * _FACTORS[i]
    return np.unique(_mix(total + np.uint64(n)))


def sketch_of(tokens: np.ndarray) -> np.ndarray:
    """The parity sketch: 64-bit words, as many as the next power of two has for two bits a token."""
    words = max(1, 1 << (2 * len(tokens) - 1).bit_length() >> 6) if len(tokens) else 1
    place = (tokens & np.uint64(64 * words - 1)).astype(np.int64)
    bits = np.bincount(place, minlength=64 * words) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(np.int64)


def class_of(tokens: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) - (1 << 63)


def bands(n: int) -> list[tuple[int, int, int]]:
    """(band, cells, most differing tokens) of the bands in which a set of ``n`` tokens can meet others."""
    own = int(np.searchsorted(_THRESHOLDS, n, "right")) - 1
    out = []
    for band in (own, own + 1):
        top = _BANDS[band + 1] - 1
        most = (n + min(top, n * 100 // PERCENT)) // 9
        if most:
            out.append((band, int(1.1 * (2 * top // 9)) + 8, most))
    return out


def cells(tokens: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """The keys of a set's cells, with the band's parity as their last bit, and the cells to spare in the band of each parity."""
    keys, spare = [], [1 << 20, 1 << 20]
    for band, p, most in bands(len(tokens)):
        part = ((tokens >> np.uint64(32)) * np.uint64(p)) >> np.uint64(32)
        starts = np.flatnonzero(np.diff(part.astype(np.int64), prepend=-1))
        xored = np.bitwise_xor.reduceat(tokens, starts)
        place = part[starts]
        left = p - len(starts)
        spare[band & 1] = p - most - left
        if p - most - left < 1 and left:
            empty = np.setdiff1d(np.arange(p, dtype=np.uint64), place, assume_unique=True)
            place, xored = np.concatenate([place, empty]), np.concatenate([xored, np.zeros(len(empty), np.uint64)])
        key = _mix(_mix(place * np.uint64(128) + np.uint64(band)) + xored)
        keys.append((key & ~np.uint64(1)) | np.uint64(band & 1))
    return (np.concatenate(keys) if keys else np.zeros(0, np.uint64)), spare


_SETS = pa.schema([("doc_id", pa.int64()), ("cid", pa.int64()), ("n", pa.int64()), ("spare0", pa.int32()), ("spare1", pa.int32()), ("key", pa.int64()), ("sketch", pa.list_(pa.int64()))])


def _packer(buckets: int, spread: int):
    """Blocks of cells, one binary per bucket: classes of the block, the cells' sorted keys as differences, the place of each cell's class.

    The documents' own rows go along under negative numbers, so that texts are cut into shingles once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        turn = TaskContext.get().partitionId()
        hashes, seen = _WordHashes(), set()
        classes, keys, held, described = [], [], 0, []

        def pack() -> pa.RecordBatch:
            numbers, blobs = [], []
            if keys:
                key = np.concatenate(keys)
                place = np.repeat(np.arange(len(keys), dtype=np.int64), [len(k) for k in keys])
                bucket = (((key >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
                key = key & _KEY
                order = np.lexsort((key, bucket))
                bucket, key, place = bucket[order], key[order], place[order]
                starts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
                table = np.array(classes, np.int64)
                for a, b in zip(starts, [*starts[1:], len(key)], strict=True):
                    mine, where = np.unique(place[a:b], return_inverse=True)
                    gaps = np.diff(key[a:b], prepend=np.uint64(0))
                    wide = 8 if int(gaps.max()) >> 32 else 4
                    numbers.append(int(bucket[a]))
                    blobs.append(np.array([len(mine), b - a, wide], np.int64).tobytes() + table[mine].tobytes() + gaps.astype(f"<u{wide}").tobytes() + where.astype("<u2").tobytes())
            for at in range(0, len(described), DESCRIBED_ROWS):
                sink = pa.BufferOutputStream()
                part = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*described[at : at + DESCRIBED_ROWS], strict=True), _SETS.types, strict=True)], schema=_SETS)
                with pa.ipc.new_stream(sink, _SETS) as out:
                    out.write_batch(part)
                numbers.append(-1 - (turn * 31 + at // DESCRIBED_ROWS) % spread)
                blobs.append(sink.getvalue().to_pybytes())
            return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

        for batch in lean(batches):
            ids, row_keys = (batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("doc_id", "key"))
            for doc_id, row_key, raw in zip(ids, row_keys, text_bytes(batch), strict=True):
                tokens = shingles(raw, hashes)
                cid = class_of(tokens)
                key, spare = cells(tokens)
                fresh = cid not in seen
                described.append((doc_id, cid, len(tokens), *spare, row_key, sketch_of(tokens) if fresh else None))
                if fresh:
                    seen.add(cid)
                    if len(key):
                        classes.append(cid)
                        keys.append(key)
                        held += len(key)
                if held >= BLOCK_CELLS or len(keys) >= 65535 or len(described) >= 1 << 17:
                    yield pack()
                    classes, keys, held, described = [], [], 0, []
        if described:
            yield pack()

    return run


CELL, DOCUMENT = 0, 1
FOUND = "kind int, a long, b long, n long, spare0 int, spare1 int, key long, sketch array<long>"
_FOUND = pa.schema([("kind", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), *[_SETS.field(i) for i in range(2, len(_SETS))]])


def _match(table: pa.Table) -> pa.Table:
    """A bucket's shared cells as (cell, class) rows; or documents' rows."""
    trim()
    number = table.column("bucket")[0].as_py()
    blobs = table.column("blob").to_pylist()
    if number < 0:
        rows = pa.concat_tables([pa.ipc.open_stream(blob).read_all() for blob in blobs])
        return pa.table([pa.array(np.full(len(rows), DOCUMENT), pa.int32()), *rows.columns], schema=_FOUND)
    keys, cids = [], []
    for blob in blobs:
        n, m, wide = np.frombuffer(blob, np.int64, 3).tolist()
        classes = np.frombuffer(blob, np.int64, n, 24)
        keys.append(np.cumsum(np.frombuffer(blob, f"<u{wide}", m, 24 + 8 * n).astype(np.uint64)))
        cids.append(classes[np.frombuffer(blob, "<u2", m, 24 + 8 * n + wide * m).astype(np.int64)])
    key, cid = np.concatenate(keys), np.concatenate(cids)
    order = np.lexsort((cid, key))
    key, cid = key[order], cid[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (cid[1:] != cid[:-1])
    key, cid = key[fresh], cid[fresh]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    several = np.repeat(sizes, sizes) > 1
    # The bucket's number stands above the key, the band's parity is the last bit.
    cell = (key[several] | np.uint64(number % (1 << 23) << KEY_BITS)).astype(np.int64)
    columns = [pa.array(np.full(len(cell), CELL), pa.int32()), pa.array(cell), pa.array(cid[several])]
    return pa.table([*columns, *[pa.nulls(len(cell), f.type) for f in list(_FOUND)[3:]]], schema=_FOUND)


def hamming(a: Column, b: Column) -> Column:
    """The Hamming distance of two sketches, the longer one folded once to the length of the other."""

    def folded(x: Column, y: Column) -> Column:
        half = F.floor(F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(y), F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))).otherwise(x)

    return F.aggregate(F.zip_with(folded(a, b), folded(b, a), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(64)))


def _near(na: Column, nb: Column, sa: Column, sb: Column) -> Column:
    """Whether sizes and sketches allow the similarity."""
    return (F.least(na, nb) * 100 >= PERCENT * F.greatest(na, nb)) & (hamming(sa, sb) <= F.floor((na + nb) / 9))


def _by_sketch(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs that the sketches do not rule out."""
    side = lambda c: classes.select(F.col("cid").alias(c), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    right = side("b").withColumnRenamed("b", "_b")
    near = (F.col("b") == F.col("_b")) & _near(F.col("na"), F.col("nb"), F.col("sa"), F.col("sb"))
    return pairs.join(side("a"), "a").join(right, near).select("a", "b")


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in lean(batches):
        made = [b" ".join(raw.translate(_LOWER).split()) for raw in text_bytes(batch)]
        yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("key")), pa.array(made, pa.binary())], names=["key", "words"])


#: Words are numbered per pair; five numbers below this make one 64-bit number.
_NUMBERS = 6208


def _numbered(words: list[bytes], numbers: dict[bytes, int]) -> np.ndarray | set:
    """The distinct shingles of five words or more: exact numbers, or tuples if there are too many different words."""
    for w in words:
        if w not in numbers:
            numbers[w] = len(numbers)
    if len(numbers) > _NUMBERS:
        return set(zip(*[words[i : len(words) - SHINGLE + 1 + i] for i in range(SHINGLE)], strict=True))
    n = np.array([numbers[w] for w in words], np.int64)
    out = n[: len(n) - SHINGLE + 1]
    for i in range(1, SHINGLE):
        out = out * _NUMBERS + n[i : len(n) - SHINGLE + 1 + i]
    return np.unique(out)


def _alike(left: list[bytes], right: list[bytes], numbers: dict[bytes, int], known: np.ndarray | set | None) -> bool:
    """Whether two texts' shingles, compared by their words, are similar enough. ``numbers`` and ``known`` are the left text's."""
    if min(len(left), len(right)) < SHINGLE:
        return left == right
    more = _numbered(right, dict(numbers))
    if isinstance(more, set) or isinstance(known, set):
        known, more = (set(zip(*[w[i : len(w) - SHINGLE + 1 + i] for i in range(SHINGLE)], strict=True)) for w in (left, right))
        both = len(known & more)
    else:
        both = len(np.intersect1d(known, more, assume_unique=True))
    return 100 * both >= PERCENT * (len(known) + len(more) - both)


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    last, left, numbers, known = None, [], {}, None
    for batch in lean(batches):
        a, b = batch.column(0), batch.column(1)
        out = []
        for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
            x, y = x.as_py(), y.as_py()
            if x != last:
                last, left, numbers = x, x.split(), {}
                known = _numbered(left, numbers) if len(left) >= SHINGLE else None
            if _alike(left, y.split(), numbers, known):
                out.append(i)
        at = pa.array(out, pa.int64())
        yield pa.RecordBatch.from_arrays([a.take(at), b.take(at)], names=["a", "b"])


def _links_of(pairs: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose texts are similar. ``docs`` have key and text; of each class one text is read."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    wanted = materialise(classes.join(ids, "cid", "left_semi").select("cid", F.col("rep.key").alias("key")), "wanted")
    keys = wanted.select("key")
    if wanted.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    texts = docs.join(keys, "key", "left_semi").mapInArrow(thrifty(_words), "key long, words binary").join(wanted, "key")
    texts = materialise(texts.groupBy("cid").agg(F.first("words").alias("words")), "words")
    right = pairs.join(texts.select(F.col("cid").alias("b"), F.col("words").alias("right")), "b")
    both = right.join(texts.select(F.col("cid").alias("a"), F.col("words").alias("left")), "a").select("a", "b", "left", "right")
    links = materialise(both.mapInArrow(thrifty(_similar), "a long, b long"), "links")
    discard(wanted, texts)
    return links


def _open_cells(shared: DataFrame, node: DataFrame) -> DataFrame:
    """The rows of cells that hold several components."""
    placed = shared.join(node.select(F.col("node").alias("cid"), "component"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    several = placed.groupBy("cell").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high").select("cell")
    return placed.join(several, "cell", "left_semi")


def _across(rows: DataFrame, shared: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs of classes of different components that meet in a rare cell of each and that the sketches do not rule out, once each."""
    concerned = shared.join(rows.select("cid").distinct(), "cid", "left_semi")
    often = shared.groupBy("cell").agg(F.count(F.lit(1)).alias("often"))
    listed = concerned.join(often, "cell").groupBy("cid", "parity").agg(F.array_sort(F.collect_list(F.struct("often", "cell"))).alias("c"), F.max("need").alias("need"))
    few = F.slice("c", F.lit(1), F.greatest(F.size("c") - F.col("need") + 1, F.lit(0)))
    rare = listed.select("cid", F.explode(F.transform(few, lambda x: x["cell"])).alias("cell"))
    open_rows = rare.join(rows.select("cell", "cid", "component"), ["cell", "cid"])
    known = open_rows.join(classes.select("cid", "n", "sketch"), "cid")
    side = lambda c: known.select(F.col("cell").alias(f"cell{c}"), F.col("cid").alias(c), F.col("component").alias(f"c{c}"), F.col("n").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"))
    meet = (F.col("cella") == F.col("cellb")) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _near(F.col("na"), F.col("nb"), F.col("sa"), F.col("sb"))
    return side("a").join(side("b"), meet).select("a", "b").distinct()


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, class_id and component_id of every row; ``class_id`` is the least doc_id with the same set."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    rows, chars = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(shuffles if rows > 1000 else 1, math.ceil(chars * CELLS_PER_CHAR / BUCKET_CELLS))
    spread = max(shuffles, rows >> 20)
    blobs = docs.mapInArrow(thrifty(_packer(buckets, spread)), "bucket int, blob binary")
    found = materialise(blobs.groupBy("bucket").applyInArrow(_match, FOUND), "found")
    described = found.filter(F.col("kind") == DOCUMENT).select(F.col("a").alias("doc_id"), F.col("b").alias("cid"), "n", "spare0", "spare1", "key", "sketch")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("rep")
    classes = described.filter("n > 0").groupBy("cid").agg(first, F.max("n").alias("n"), F.max("spare0").alias("spare0"), F.max("spare1").alias("spare1"), F.max("sketch").alias("sketch"))
    classes = materialise(classes, "classes")

    cell_rows = found.filter(F.col("kind") == CELL).select(F.col("a").alias("cell"), F.col("b").alias("cid"), F.col("a").bitwiseAND(F.lit(1).cast("long")).cast("int").alias("parity"))
    need = F.greatest(F.when(F.col("parity") == 0, F.col("spare0")).otherwise(F.col("spare1")), F.lit(1))
    able = cell_rows.groupBy("cid", "parity").agg(F.count(F.lit(1)).alias("held")).join(classes.select("cid", "spare0", "spare1"), "cid").withColumn("need", need).filter("held >= need")
    shared = materialise(cell_rows.join(able.select("cid", "parity", "held", "need"), ["cid", "parity"]), "shared")
    centre = shared.groupBy("cell").agg(F.max(F.struct("held", "cid"))["cid"].alias("centre"), F.count(F.lit(1)).alias("size")).filter("size > 1").select("cell", "centre")
    star = shared.join(centre, "cell").filter("cid <> centre").select(F.col("centre").alias("a"), F.col("cid").alias("b")).distinct()
    texts = docs.select("key", "text")
    pairs = materialise(_by_sketch(star, classes), "pairs")
    links = [_links_of(pairs, texts, classes)]
    node = components(links[0])
    rest = _open_cells(shared, node)
    more = materialise(_across(rest, shared, classes).join(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "pairs")
    discard(pairs)
    if not more.isEmpty():
        links.append(_links_of(more, texts, classes))
        settled = node
        node = components(links[0].unionByName(links[1]))
        discard(settled)
    discard(more, shared, *links)
    reps = classes.select("cid", F.col("rep.doc_id").alias("rep"), F.col("rep.none").alias("none"))
    named = node.join(reps, node.node == reps.cid).groupBy("component").agg(F.min(F.struct("none", "rep"))["rep"].alias("component_id"))
    of_class = node.join(named, "component").select(F.col("node").alias("cid"), "component_id", F.lit(True).alias("linked"))
    placed = F.when(F.col("linked"), F.col("component_id")).otherwise(F.col("rep"))
    members = reps.join(of_class, "cid", "left").select("cid", "rep", placed.alias("component_id"))
    joined = described.filter("n > 0").join(members, "cid").select("doc_id", F.col("n").alias("n_shingles"), F.col("rep").alias("class_id"), "component_id")
    empty = described.filter("n = 0").select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("class_id"), F.col("doc_id").alias("component_id"))
    out = materialise(joined.unionByName(empty), "near")
    discard(found, classes, node)
    return out


def dedup_near(docs: DataFrame) -> DataFrame:
    """The documents that stay, with all their columns: of each component the least doc_id, a null after all others.

    Rows are told apart by a 64-bit hash of doc_id and text, as one doc_id, or none, may have several texts; rows alike in both are one.
    A column named ``_row`` is kept like any other.
    """
    row = F.xxhash64("doc_id", "text")
    of_row = near_components(docs.select(row.alias("doc_id"), "text")).filter("n_shingles > 0").select(F.col("doc_id").alias("row"), "component_id").distinct()
    named = of_row.join(docs.select(row.alias("row"), "doc_id").distinct(), "row")
    named = materialise(named.select("component_id", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row").alias("who")), "named")
    least = named.groupBy("component_id").agg(F.min("who").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    dropped = named.join(least, "component_id").filter("who.row <> least.row").select(F.col("who.row").alias("row"))
    dropped = materialise(dropped, "dropped")
    discard(named)
    return docs.join(dropped, row == dropped.row, "left_anti")


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir)).select("doc_id", "n_shingles", "component_id", "class_id")
