"""Removal of repeated passages by column-wise construction of sorted suffixes.

A byte goes if it lies in a ``LENGTH``-byte string that also starts in a document of smaller doc_id.

1. Anchors: of every ``LENGTH``-byte window, the ``GRAM``-byte gram with the least hash (the leftmost of equals) is its anchor;
   equal windows have the same anchor at the same offset. The bytes that neighbouring windows with one anchor cover (at
   most ``2 * LENGTH - GRAM``) are one string. Equal strings (by 64-bit hash, next to the anchor's 48 bits) are a class: the
   smallest doc_id stands for it, and every other document loses all windows of the string. A block of documents
   settles its own classes and sends the hash of each once, so a passage in a third of all documents is one entry a block.
2. The strings that stand for the classes of an anchor with several documents go to the anchor's owner.
3. An owner builds the order of its strings' suffixes column by column, aligned at the anchor and from the right: each round
   puts one symbol before each string, so the order is a stable sort of the last one by that symbol, and the common prefix
   of neighbours is one more than the least in the range between them before. Where neighbours share ``LENGTH`` bytes or
   more, windows are equal, and those of all but the smallest doc_id are found.

What is found goes back to the documents in bundles, one per owner and bucket of documents, so its rows do not multiply with both.

The columns are built for ``AT_ONCE`` strings, or one anchor's, in memory, so no external files are kept; a round of
the whole collection, as for short reads, would need as many rounds as the longest document has bytes.

Cases: a null text is empty; texts below ``LENGTH`` bytes lose nothing; a string that repeats inside one document only stays;
rows that share a doc_id do not remove from each other, and a row without a doc_id loses nothing and removes nothing; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm.common import batches_of, discard, documents, lean, materialise, text_bytes, thrifty, trim

LENGTH, GRAM = 50, 16
WINDOW = LENGTH - GRAM + 1
#: Bytes whose grams are hashed at once; longer texts are cut there, counted from their own start.
CHUNK = 1 << 18
BLOCK_BYTES = 1 << 23
OWNER_BYTES = 1 << 22
AT_ONCE = 1 << 17
TABLE_ROWS = 1 << 14
#: Texts that a task hands to Python at once.
TEXTS = 1000
_BASE = 0x9E3779B97F4A7C15
_PLACE = np.uint64((1 << 24) - 1)
_KEY = np.uint64((1 << 48) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Runs:
    """The strings of some texts laid end to end: text's number, anchor's hash and place, first and last window, hash."""

    def __init__(self, texts: list[bytes]):
        self.flat = b"".join(texts)
        self.ends = np.cumsum([len(t) for t in texts])
        parts = [self._part(at) for at in range(0, len(self.flat) - LENGTH + 1, CHUNK)] or [(np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 3)]
        self.key, self.place, self.first, self.last = (np.concatenate(c) for c in zip(*parts, strict=True))
        self.text = np.searchsorted(self.ends, self.first, "right")
        digest, flat = xxhash.xxh3_64_intdigest, self.flat
        self.hash = np.fromiter((digest(flat[a:b]) for a, b in zip(self.first.tolist(), (self.last + LENGTH).tolist(), strict=True)), np.uint64, len(self.key))

    def _part(self, at: int) -> tuple[np.ndarray, ...]:
        grams = np.frombuffer(self.flat, np.uint8)[at : at + CHUNK + LENGTH - 1].astype(np.uint64)
        width, power = 1, _BASE
        while width < GRAM:
            grams = grams[:-width] * np.uint64(power) + grams[width:]
            width, power = 2 * width, power * power % (1 << 64)
        grams = _mix(grams)
        least, width = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), 1
        while width < WINDOW:
            step = min(width, WINDOW - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        place = (least & _PLACE).astype(np.int64)
        inside = np.ones(len(place) + 2, bool)
        inside[[0, -1]] = False
        over = (self.ends[(self.ends > at) & (self.ends < at + len(place) + LENGTH)][:, None] - at - np.arange(1, LENGTH)[None, :]).ravel()
        inside[over[(over >= 0) & (over < len(place))] + 1] = False
        turn = np.ones(len(place) + 1, bool)
        turn[1:-1] = place[1:] != place[:-1]
        first = np.flatnonzero(inside[1:-1] & (turn[:-1] | ~inside[:-2]))
        last = np.flatnonzero(inside[1:-1] & (turn[1:] | ~inside[2:]))
        return grams[place[first]], place[first] + at, first + at, last + at


def _blocks(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple[list, list[bytes], list[list]]]:
    """doc_ids, texts and other columns of up to ``CHUNK`` bytes of text; a longer text is alone."""
    ids, texts, others, held = [], [], [[] for _ in names], 0
    for batch in lean(batches):
        columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("doc_id", *names)]
        for text, doc_id, *more in zip(text_bytes(batch), *columns, strict=True):
            if ids and (held + len(text) > CHUNK or len(ids) >= 4096):
                yield ids, texts, others
                ids, texts, others, held = [], [], [[] for _ in names], 0
            ids.append(doc_id)
            texts.append(text)
            for column, value in zip(others, more, strict=True):
                column.append(value)
            held += len(text)
    if ids:
        yield ids, texts, others


def _by_doc(doc: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The distinct documents, and each one's values."""
    order = np.argsort(doc, kind="stable")
    doc, values = doc[order], values[order]
    starts = np.flatnonzero(np.concatenate([np.ones(min(len(doc), 1), bool), doc[1:] != doc[:-1]]))
    return doc[starts], [values[a:b] for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(doc)], strict=False)]


def _classes(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order by class and document, where in it a class starts, and which entries have a smaller document before them."""
    order = np.lexsort((doc, hashes))
    h, d = hashes[order], doc[order]
    starts = np.concatenate([np.ones(min(len(h), 1), bool), h[1:] != h[:-1]])
    lead = np.maximum.accumulate(np.where(starts, np.arange(len(h)), 0)) if len(h) else np.zeros(0, np.int64)
    return order, starts, d > d[lead]


GONE, BUILD, HITS = 0, 1, 2
_BUNDLES = "bucket int, kind int, blob binary"


def _bundles(doc: np.ndarray, values: np.ndarray, buckets: int) -> list[tuple[int, bytes]]:
    """(bucket of documents, blob): number of documents, their ids, how many values each has, the values (rows of 8-byte numbers)."""
    if not len(doc):
        return []
    bucket = (_mix(doc.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((doc, bucket))
    doc, values, bucket = doc[order], values[order], bucket[order]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1)).tolist()
    out = []
    for a, b in zip(cuts, [*cuts[1:], len(doc)], strict=True):
        ids, counts = np.unique(doc[a:b], return_counts=True)
        out.append((int(bucket[a]), np.array([len(ids)], np.int64).tobytes() + ids.tobytes() + counts.astype(np.int64).tobytes() + values[a:b].tobytes()))
    return out


def _of_bundles(blobs: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents and values (rows of ``width`` numbers) of many blobs, ordered by document."""
    docs, values = [np.zeros(0, np.int64)], [np.zeros((0, width), np.uint64)]
    for blob in blobs:
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        docs.append(np.repeat(np.frombuffer(blob, np.int64, n, 8), np.frombuffer(blob, np.int64, n, 8 + 8 * n)))
        values.append(np.frombuffer(blob, np.uint64, -1, 8 + 16 * n).reshape(-1, width))
    doc, value = np.concatenate(docs), np.concatenate(values)
    order = np.argsort(doc, kind="stable")
    return doc[order], value[order]


def _per_document(*wanted: tuple[int, int]):
    """For a bucket: one row per document, with the values of each wanted (kind, width) as one binary, null without any."""

    def run(table: pa.Table) -> pa.Table:
        kinds, blobs = table.column("kind").to_pylist(), table.column("blob").to_pylist()
        found = []
        for kind, width in wanted:
            doc, value = _of_bundles([b for k, b in zip(kinds, blobs, strict=True) if k == kind], width)
            found.append(dict(zip(*(x.tolist() if isinstance(x, np.ndarray) else x for x in _by_doc(doc, value)), strict=True)))
        ids = sorted(set().union(*found))
        lists = [pa.array([None if i not in own else np.unique(own[i]).tobytes() if width == 1 else own[i].tobytes() for i in ids], pa.binary()) for (_, width), own in zip(wanted, found, strict=True)]
        return pa.table([pa.array(ids, pa.int64()), *lists], names=["doc_id", *[("gone", "build", "hits")[k] for k, _ in wanted]])

    return run


def _bundle_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())], names=["bucket", "kind", "blob"])


def _packer(owners: int):
    """Blobs per owner: documents, 48 bits of anchor and 16 of the document's place, hashes. What a block settles has negative owners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, keys, hashes, held, count = [], [], [], 0, 0

        def pack() -> pa.RecordBatch:
            doc, key, digest = np.concatenate(docs), np.concatenate(keys), np.concatenate(hashes)
            order, starts, gone = _classes(digest, doc)
            numbers, blobs = [], []
            for bucket, blob in _bundles(doc[order][gone], digest[order][gone], owners):
                numbers.append(-1 - bucket)
                blobs.append(blob)
            doc, key, digest = doc[order][starts], key[order][starts], digest[order][starts]
            owner = (((key >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)).astype(np.int64)
            order = np.argsort(owner, kind="stable")
            doc, key, digest, owner = doc[order], key[order], digest[order], owner[order]
            cuts = np.flatnonzero(np.diff(owner, prepend=-1)).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(owner)], strict=True):
                mine, where = np.unique(doc[a:b], return_inverse=True)
                rows = ((key[a:b] & _KEY) << np.uint64(16)) | where.astype(np.uint64)
                numbers.append(int(owner[a]))
                blobs.append(np.array([len(mine)], np.int64).tobytes() + mine.tobytes() + rows.tobytes() + digest[a:b].tobytes())
            return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(blobs, pa.binary())], names=["owner", "blob"])

        for ids, texts, _ in _blocks(batches):
            runs = Runs(texts)
            docs.append(np.array(ids, np.int64)[runs.text])
            keys.append(runs.key)
            hashes.append(runs.hash)
            held, count = held + len(runs.flat), count + len(ids)
            if held >= BLOCK_BYTES or count >= 60_000:
                yield pack()
                docs, keys, hashes, held, count = [], [], [], 0, 0
        if docs:
            yield pack()

    return run


def _shared(table: pa.Table, owners: int) -> pa.Table:
    """By bucket of documents: the strings that a smaller document has too, and those that stand for a class and go to the owner."""
    trim()
    blobs = table.column("blob").to_pylist()
    owner = table.column("owner")[0].as_py()
    if owner < 0:
        return _bundle_table([(-1 - owner, GONE, b) for b in blobs])
    keys, docs, hashes = [], [], []
    for blob in blobs:
        n = int(np.frombuffer(blob, np.int64, 1)[0])
        ids, rows = np.frombuffer(blob, np.int64, n, 8), np.frombuffer(blob, np.uint64, -1, 8 + 8 * n)
        rows, digest = rows[: len(rows) // 2], rows[len(rows) // 2 :]
        keys.append(rows >> np.uint64(16))
        docs.append(ids[(rows & np.uint64(0xFFFF)).astype(np.int64)])
        hashes.append(digest)
    key, doc, digest = np.concatenate(keys), np.concatenate(docs), np.concatenate(hashes)
    order, starts, gone = _classes(digest, doc)
    lost = _bundles(doc[order][gone], digest[order][gone], owners)
    key, doc, digest = key[order][starts], doc[order][starts], digest[order][starts]
    order = np.lexsort((doc, key))
    key, doc, digest = key[order], doc[order], digest[order]
    edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    upto = np.append(edge[1:], len(key))
    several = np.repeat(doc[edge] != doc[upto - 1], upto - edge)
    build = _bundles(doc[several], digest[several], owners)
    return _bundle_table([(b, GONE, x) for b, x in lost] + [(b, BUILD, x) for b, x in build])


def _cutter(owners: int):
    """The strings that stand for their classes: owner, anchor, doc_id, hash, anchor's offset, bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, (build,) in _blocks(batches, "build"):
            runs = Runs(texts)
            cuts = np.searchsorted(runs.text, np.arange(len(ids) + 1)).tolist()
            wanted = []
            for a, b, lists in zip(cuts[:-1], cuts[1:], build, strict=True):
                _, at = np.unique(runs.hash[a:b], return_index=True)
                wanted.append(a + at[np.isin(runs.hash[a:b][at], np.frombuffer(lists, np.uint64))])
            wanted = np.concatenate(wanted)
            key, first = runs.key[wanted], runs.first[wanted]
            owner = (((key >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)).astype(np.int32)
            strings = [runs.flat[a:b] for a, b in zip(first.tolist(), (runs.last[wanted] + LENGTH).tolist(), strict=True)]
            doc = np.array(ids, np.int64)[runs.text[wanted]]
            columns = [pa.array(owner), pa.array(key.view(np.int64)), pa.array(doc), pa.array(runs.hash[wanted].view(np.int64)), pa.array((runs.place[wanted] - first).astype(np.int32)), pa.array(strings, pa.binary())]
            made = pa.RecordBatch.from_arrays(columns, names=["owner", "anchor", "doc_id", "hash", "offset", "bytes"])
            for at in range(0, len(made), 8192):
                yield made.slice(at, 8192)

    return run


def column_matches(flat: np.ndarray, sizes: np.ndarray, offsets: np.ndarray, groups: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(string, start) of the windows that also start, at the same column of the same group, in a string of smaller id.

    Strings are right-open rows of a table whose columns are counted from the anchor. The order starts empty; from the
    last column to the first, strings that end there enter behind, and all that cover the column are sorted by its symbol.
    """
    n = len(sizes)
    left = WINDOW - 1
    width = left + LENGTH + 1
    table = np.zeros((n, width), np.uint8)
    begin = left - offsets
    stop = np.cumsum(sizes)
    for i in range(0, n, TABLE_ROWS):
        j = min(n, i + TABLE_ROWS)
        low = int(stop[i] - sizes[i])
        piece = flat[low : int(stop[j - 1])]
        of = np.repeat(np.arange(i, j), sizes[i:j])
        table[of, np.arange(low, low + len(piece)) + (begin - stop + sizes)[of]] = piece
    end = begin + sizes
    _, group = np.unique(groups, return_inverse=True)
    order = np.zeros(0, np.int64)
    common = np.zeros(0, np.uint8)  # with the string before it in the order
    found, where = [], []
    for column in range(width - 1, -1, -1):
        entering = np.flatnonzero(end == column + 1)
        order = np.concatenate([order, entering])
        common = np.concatenate([common, np.zeros(len(entering), np.uint8)])
        stays = begin[order] <= column
        if not len(order):
            continue
        # Range minima over the order as it was, for neighbours that come from apart.
        levels = [common]
        while 2 << (len(levels) - 1) <= len(order):
            half = 1 << (len(levels) - 1)
            levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
        kept = np.flatnonzero(stays)
        symbol = table[order[kept], column]
        sort = np.argsort(symbol, kind="stable")
        was, symbol = kept[sort], symbol[sort]
        made = np.zeros(len(was), np.uint8)
        if len(was) > 1:
            equal = np.flatnonzero(symbol[1:] == symbol[:-1]) + 1
            a, b = was[equal - 1] + 1, was[equal]
            level = np.frexp((b - a + 1).astype(np.float64))[1] - 1
            least = np.zeros(len(equal), np.uint8)
            for k in np.unique(level).tolist():
                some = level == k
                least[some] = np.minimum(levels[k][a[some]], levels[k][b[some] + 1 - (1 << k)])
            made[equal] = np.minimum(least, LENGTH) + 1
        order, common = order[was], made
        if column > left:
            continue
        run = np.cumsum(common < LENGTH)
        member = end[order] - column >= LENGTH
        # Windows of different anchors can be equal in bytes only if their anchors are; the group settles hash collisions.
        by = np.lexsort((ids[order], group[order], run))
        key = run[by] * (int(group.max()) + 1) + group[order][by]
        same = np.concatenate([[True], key[1:] != key[:-1]])
        least_id = ids[order][by][np.maximum.accumulate(np.where(same, np.arange(len(by)), 0))]
        hit = (ids[order][by] > least_id) & member[by]
        found.append(order[by][hit])
        where.append(np.full(int(hit.sum()), column) - begin[order[by][hit]])
    return (np.concatenate(found), np.concatenate(where)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _match(table: pa.Table, owners: int) -> pa.Table:
    """An owner's repeated windows, by bucket of documents: hash of the string and a bit for each of its windows."""
    trim()
    table = table.sort_by("anchor").combine_chunks()
    anchor, ids = table.column("anchor").to_numpy(), table.column("doc_id").to_numpy()
    edge = np.append(np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]])), len(anchor)).tolist()
    bits = np.zeros(len(anchor), np.uint64)
    low = 0
    for this, following in zip(edge[1:], [*edge[2:], len(anchor) + AT_ONCE], strict=True):
        if following - low <= AT_ONCE:
            continue
        part = table.slice(low, this - low).column("bytes").combine_chunks()
        part = part.chunk(0) if isinstance(part, pa.ChunkedArray) else part
        wide = part.cast(pa.large_binary())
        stops = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
        flat = np.frombuffer(wide.buffers()[2], np.uint8)[stops[0] : stops[-1]]
        found, start = column_matches(flat, np.diff(stops), table.column("offset").to_numpy()[low:this].astype(np.int64), anchor[low:this], ids[low:this])
        np.bitwise_or.at(bits, low + found, np.uint64(1) << start.astype(np.uint64))
        low = this
    hit = bits > 0
    made = _bundles(ids[hit], np.stack([table.column("hash").to_numpy()[hit].view(np.uint64), bits[hit]], 1), owners)
    return _bundle_table([(b, HITS, x) for b, x in made])


_OUT = "doc_id long, kept binary, span_starts array<long>, span_ends array<long>, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _covered(texts: list[bytes], gone: list, hits: list) -> np.ndarray:
    """Which bytes of the texts, laid end to end, lie in a repeated window."""
    runs = Runs(texts)
    bits = np.zeros(len(runs.key), np.uint64)
    full = np.zeros(len(runs.key), bool)
    cuts = np.searchsorted(runs.text, np.arange(len(texts) + 1)).tolist()
    for a, b, lost, found in zip(cuts[:-1], cuts[1:], gone, hits, strict=True):
        if a < b and lost:
            full[a:b] = np.isin(runs.hash[a:b], np.frombuffer(lost, np.uint64))
        if a < b and found:
            rows = np.frombuffer(found, np.uint64).reshape(-1, 2)
            rows = rows[np.argsort(rows[:, 0], kind="stable")]
            at = np.minimum(np.searchsorted(rows[:, 0], runs.hash[a:b]), len(rows) - 1)
            bits[a:b] = np.where(rows[at, 0] == runs.hash[a:b], rows[at, 1], np.uint64(0))
    cover = np.zeros(len(runs.flat) + 1, np.int32)
    np.add.at(cover, runs.first[full], 1)
    np.subtract.at(cover, runs.last[full] + LENGTH, 1)
    for w in range(WINDOW):
        starts = runs.first[(bits >> np.uint64(w)) & np.uint64(1) > 0] + w
        np.add.at(cover, starts, 1)
        np.subtract.at(cover, starts + LENGTH, 1)
    return np.cumsum(cover[:-1]) > 0


def _remover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    for ids, texts, (gone, hits) in _blocks(batches, "gone", "hits"):
        cover = _covered(texts, gone, hits) if any(gone) or any(hits) else None
        rows, at = [], 0
        for doc_id, raw in zip(ids, texts, strict=True):
            begins, ends, kept = [], [], raw
            mine = cover[at : at + len(raw)] if cover is not None else None
            at += len(raw)
            if mine is not None and mine.any():
                edge = np.diff(mine.astype(np.int8), prepend=0, append=0)
                begins, ends = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
                kept = np.frombuffer(raw, np.uint8)[~mine].tobytes()
            rows.append((doc_id, kept, begins, ends, len(raw), len(raw) - len(kept), len(begins), hashlib.sha256(kept).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "kept", "span_starts", "span_ends", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """Every document's remaining bytes, the spans removed, their counts and a digest."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    owners = max(shuffles if size > 1_000_000 else 1, math.ceil(size / OWNER_BYTES))
    with batches_of(spark, TEXTS):
        shared = materialise(docs.filter("doc_id is not null").mapInArrow(thrifty(_packer(owners)), "owner int, blob binary").groupBy("owner").applyInArrow(lambda t: _shared(t, owners), _BUNDLES), "shared")
    build = shared.filter(F.col("kind") == BUILD).groupBy("bucket").applyInArrow(_per_document((BUILD, 1)), "doc_id long, build binary")
    strings = docs.join(build, "doc_id").mapInArrow(thrifty(_cutter(owners)), "owner int, anchor long, doc_id long, hash long, offset int, bytes binary")
    with batches_of(spark, TEXTS):
        found = materialise(strings.groupBy("owner").applyInArrow(lambda t: _match(t, owners), _BUNDLES), "found")
    both = shared.filter(F.col("kind") == GONE).unionByName(found)
    lists = materialise(both.groupBy("bucket").applyInArrow(_per_document((GONE, 1), (HITS, 2)), "doc_id long, gone binary, hits binary"), "lists")
    discard(shared, found)
    lists = lists.withColumnRenamed("doc_id", "_id")
    return docs.join(lists, docs.doc_id == lists._id, "left").select("doc_id", "text", "gone", "hits").mapInArrow(thrifty(_remover), _OUT)


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
