"""Byte-level BPE: ranked merges of distinct words as a fold of Spark higher-order functions.

A word's state in the fold is a string with one character per piece (the piece's id, shifted). A step looks up every
neighbouring pair in a constant rank map and merges the first pair of the least rank; the fold runs over one step less than the word
has bytes, and the characters that remain are the ids. The map holds the pairs of pieces whose bytes joined are a piece, dealt
into small buckets by a CRC. It enters a plan as a scalar subquery: a literal of a million characters would be printed with each
form of each plan, and Spark's driver keeps what it prints.

Encoding a corpus:

1. Words are counted per task and summed. Words that occur at least so often that no more than ``HEAD_WORDS`` remain (and
   are of 64 bytes at most) are encoded once each by the fold and sent to all tasks: a table of proven bound.
2. A pass over the texts looks their words up. What is not in the head stays as a hole, with the document's own
   distinct rare words beside it; the fold encodes these in the same stage, and a last step fills the holes. So no
   text and no word occurrence is ever shuffled, and no word is a hot key.
3. A word of over ``FOLD_BYTES`` bytes would take a fold quadratic in its length; such words are merged by a heap, with the same result.

Decoding concatenates the binary pieces of the ids.

Texts are cut some megabytes at once: the pattern sees each different part once, and what follows works on the numbers of words.

Splitting: ``PATTERN`` looks ahead only at white space, so a text whose white space is single spaces and newlines, never
side by side, splits alike when cut before each space and around each newline; other texts go through the pattern whole.

Cases: a null or empty text has no ids; special tokens in a text are ordinary text; repeated rows are encoded each; an
empty table gives an empty result; other columns pass through ``encode_documents``, whatever they are called, but for ``text`` and ``ids``.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
import mmap
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm.common import discard, documents, lean, let, materialise, text_bytes, thrifty, trim

HEAD_WORDS = 1 << 20
HEAD_BYTES = 64
FOLD_BYTES = 256
#: Buckets of the rank map.
BUCKETS = 1 << 16
SHIFT = 0x100
#: Stands before each pair in a bucket; above all pieces, so that a pair that is not there sorts last.
MARK = "\ufffd"
#: Bytes of text that are cut at once.
CHUNK_BYTES = 12 << 20
#: Bytes of packed ids that are filled and digested at once.
FILLED_BYTES = 4 << 20
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def vocabulary(path: str | None = None) -> dict[bytes, int]:
    """Piece to rank. ``path`` defaults to the installed public vocabulary for many languages."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
    if max(ranks.values()) + SHIFT >= 0xD800 or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("a vocabulary of up to 55,039 pieces with all single bytes is needed")
    return ranks


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class RankMap:
    """The constant rank map: buckets of ``MARK``, two pieces, the piece they make."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int]):
        buckets: list[list[str]] = [[] for _ in range(BUCKETS)]
        for piece, rank in ranks.items():
            for i in range(1, len(piece)):
                a, b = ranks.get(piece[:i]), ranks.get(piece[i:])
                if a is not None and b is not None:
                    pair = chr(a + SHIFT) + chr(b + SHIFT)
                    buckets[zlib.crc32(pair.encode()) % BUCKETS].append(f"{MARK}{pair}{chr(rank + SHIFT)}")
        held = pa.array([["".join(b) or MARK for b in buckets]], pa.list_(pa.string()))
        self.buckets = spark.createDataFrame(pa.table({"buckets": held})).scalar()
        self.bytes_in = "".join(map(chr, range(1, 256)))
        self.bytes_out = "".join(chr(ranks[bytes([b])] + SHIFT) for b in range(1, 256))
        self.zero = chr(ranks[b"\0"] + SHIFT)

    def beside(self, rows: DataFrame, made: str, body) -> DataFrame:
        """``rows`` and a column ``made`` of what ``body`` makes of the buckets.

        Spark takes no subquery in a function of a lambda, so it stands in a column of its own first. That is read once, and Spark puts the
        subquery back in its place: no row holds the buckets.
        """
        name = _unused("_buckets", [*rows.columns, made])
        return rows.withColumn(name, self.buckets).withColumn(made, let(F.col(name), body)).drop(name)

    def after(self, buckets: Column, pair: Column) -> Column:
        """A string that starts with the piece the pair makes, or with ``MARK``."""
        bucket = F.get(buckets, F.crc32(pair.cast("binary")).bitwiseAND(F.lit(BUCKETS - 1).cast("long")).cast("int"))
        return F.call_function("substring_index", bucket, F.concat(F.lit(MARK), pair), F.lit(-1))


def encode_word(word: Column, ranks: RankMap, buckets: Column) -> Column:
    """The ids of one word of 1 to ``FOLD_BYTES`` bytes, as a fold of ranked merges; a mark at the end says that no pair is left."""
    raw = F.decode(word.cast("binary"), "ISO-8859-1")
    start = F.replace(F.translate(raw, ranks.bytes_in, ranks.bytes_out), F.lit("\0"), F.lit(ranks.zero))
    mark, one = F.lit(MARK), F.lit(1)

    def step(pieces: Column, _: Column) -> Column:
        codes = F.transform(F.sequence(one, F.length(pieces) - 1), lambda i: F.ascii(ranks.after(buckets, F.substring(pieces, i, F.lit(2)))))

        def merge(at: Column) -> Column:
            made = F.substring(ranks.after(buckets, F.substring(pieces, at, F.lit(2))), one, one)
            return F.concat(F.substring(pieces, one, at - 1), made, F.substring(pieces, at + 2, F.length(pieces)))

        def least(codes: Column) -> Column:
            first = let(F.array_position(codes, F.array_min(codes)).cast("int"), merge)
            return F.when(F.array_min(codes) >= ord(MARK), F.concat(pieces, mark)).otherwise(first)

        return F.when((F.length(pieces) < 2) | F.endswith(pieces, mark), pieces).otherwise(let(codes, least))

    folded = F.aggregate(F.sequence(one, F.greatest(F.length(start) - 1, one)), start, step)
    return F.transform(F.split(F.replace(folded, mark, F.lit("")), ""), lambda c: F.ascii(c) - SHIFT)


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for a word of any length, by a heap over linked pieces."""
    n = len(word)
    after, before, piece = list(range(1, n + 1)), list(range(-1, n - 1)), [word[i : i + 1] for i in range(n)]
    heap = [(r, i, i + 1, 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, j, size = heapq.heappop(heap)
        if not piece[i] or j >= n or not piece[j] or after[i] != j or len(piece[i]) + len(piece[j]) != size:
            continue
        piece[i] += piece[j]
        piece[j] = b""
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := ranks.get(piece[a] + piece[b])) is not None:
                heapq.heappush(heap, (r, a, b, len(piece[a]) + len(piece[b])))
    return [ranks[p] for p in piece if p]


#: White space besides space and newline, and the zero byte; a text with any of it goes through the pattern whole.
_RARE = [chr(c) for c in (*range(0x0A), *range(0x0B, 0x20)) if chr(c).isspace() or not c] + [c for c in map(chr, range(128, 0x3001)) if c.isspace()]
_ODD = re.compile(b"|".join(re.escape(c.encode()) for c in _RARE))


class Splitter:
    """Cuts texts by the pattern. A regular text is cut before each space and around each newline first: its parts split alike alone and in it."""

    def __init__(self, pattern: str):
        self.words = regex.compile(pattern).findall

    def regular(self, raw: bytes) -> bool:
        if not raw:
            return True
        spaced = raw[0] in b" \n" or raw[-1] in b" \n" or b"  " in raw or b"\n\n" in raw or b" \n" in raw or b"\n " in raw
        return not spaced and _ODD.search(raw) is None

    def counts(self, texts: list[bytes]) -> tuple[pa.StringArray, np.ndarray]:
        """The distinct words of some texts, and how often each occurs."""
        words, sizes, number, _ = self._parts(texts)
        often = np.repeat(np.bincount(number, minlength=len(sizes)), sizes)
        return words.dictionary, np.bincount(words.indices.to_numpy(zero_copy_only=False), often, len(words.dictionary)).astype(np.int64)

    def cut(self, texts: list[bytes]) -> tuple[pa.StringArray, np.ndarray, np.ndarray]:
        """The distinct words of some texts, the numbers of all words in order, and where in these each text begins and the last ends."""
        words, sizes, number, parts = self._parts(texts)
        held = sizes[number]
        flat = words.indices.to_numpy(zero_copy_only=False)[_ragged((np.cumsum(sizes) - sizes)[number], held)]
        return words.dictionary, flat, np.concatenate([[0], np.cumsum(held)])[np.concatenate([[0], np.cumsum(parts)])]

    def _parts(self, texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray, np.ndarray]:
        """The words of all different parts and how many each part has; the numbers of the texts' parts in order, and how many each text has."""
        regular = [self.regular(raw) for raw in texts]
        blocks = [raw.replace(b" ", b"\0 ").replace(b"\n", b"\0\n\0") for raw, r in zip(texts, regular, strict=True) if r]
        data, lengths = b"".join([x for block in blocks for x in (block, b"\0")]), [len(block) + 1 for block in blocks]
        del blocks
        ends = np.flatnonzero(np.frombuffer(data, np.uint8) == 0) + 1
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        lists = [self.words(part[:-1].decode("utf-8", "replace")) for part in coded.dictionary.to_pylist()]
        parts = np.diff(np.searchsorted(ends, np.cumsum([0, *lengths]), "right"))
        number = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if not all(regular):  # a text that is not regular is one more part
            counts = np.ones(len(texts), np.int64)
            counts[regular] = parts
            every, own = np.empty(int(counts.sum()), np.int64), np.repeat(regular, counts)
            every[own] = number
            every[~own] = len(lists) + np.arange(int((~own).sum()))
            lists += [self.words(raw.decode("utf-8", "replace")) for raw, r in zip(texts, regular, strict=True) if not r]
            parts, number = counts, every
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return pa.array(list(itertools.chain.from_iterable(lists)), pa.string()).dictionary_encode(), sizes, number, parts


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of many runs, one after the other."""
    out = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    out += np.arange(len(out))
    return out


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of up to ``CHUNK_BYTES`` of text, a longer text alone."""
    for batch in lean(batches):
        at, texts, held = 0, [], 0
        for raw in text_bytes(batch):
            if texts and held + len(raw) > CHUNK_BYTES:
                yield batch.slice(at, len(texts)), texts
                at, texts, held = at + len(texts), [], 0
            texts.append(raw)
            held += len(raw)
        if texts:
            yield batch.slice(at, len(texts)), texts


_WORDS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def _counter(pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter(pattern)
        for _, texts in _chunks(batches):
            words, often = split.counts(texts)
            made = pa.RecordBatch.from_arrays([words, pa.array(often, pa.int64())], schema=_WORDS)
            yield made.filter(pc.less_equal(pc.binary_length(words), HEAD_BYTES))

    return run


def count_words(docs: DataFrame, pattern: str | None = None) -> DataFrame:
    """word and n for the words of up to ``HEAD_BYTES`` bytes that the pattern cuts."""
    pattern = pattern or split_pattern()
    return docs.select("text").mapInArrow(thrifty(_counter(pattern)), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def head_words(counts: DataFrame, most: int = HEAD_WORDS) -> DataFrame:
    """The words that occur at least so often that no more than ``most`` are left; at least twice."""
    counts = materialise(counts.filter("n >= 2"), "words")
    steps = counts.groupBy(F.floor(F.log2("n") * 8).alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()
    least, held = None, 0
    for s in steps:
        held += s["words"]
        if held > most:
            break
        least = s["least"]
    found = counts.filter(F.col("n") >= least) if least is not None else counts.filter("false")
    found.stored_at = counts.stored_at
    return found


_MAGIC = b"presslens words\n"
#: Words that are hashed at once on the driver.
PACKED = 1 << 15


def pack_head(table: pa.Table) -> bytearray:
    """Word to packed ids as one block of flat arrays: an open-addressing table of hashes, the words' and ids' ends, their bytes.

    The block is filled chunk by chunk where it lies: it is most of what the driver holds here, so there is no second copy.
    """
    size = table.num_rows
    mask = (1 << max(4, (2 * size - 1).bit_length())) - 1
    n_words = pc.sum(pc.binary_length(table.column(0))).as_py() or 0
    n_ids = 4 * (pc.sum(pc.list_value_length(table.column(1))).as_py() or 0)
    sizes = np.array([mask, mask + 1, size + 1, size + 1, n_words, n_ids], np.int64)
    at = np.cumsum([len(_MAGIC) + sizes.nbytes, 4 * (mask + 1), 4 * (size + 1), 4 * (size + 1), n_words]).tolist()
    block = bytearray(at[4] + n_ids)
    block[: at[0]] = _MAGIC + sizes.tobytes()
    slots, word_ends, id_ends = np.frombuffer(block, np.int32, mask + 1, at[0]), np.frombuffer(block, np.uint32, size + 1, at[1]), np.frombuffer(block, np.uint32, size + 1, at[2])
    words, ids = np.frombuffer(block, np.uint8, n_words, at[3]), np.frombuffer(block, "<i4", n_ids // 4, at[4])
    row = 0
    for column, lists in ((c, i) for part in table.to_batches() for c, i in [part.columns]):
        column, end = column.cast(pa.large_binary()), row + len(column)
        ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        word_ends[row + 1 : end + 1] = ends[1:] - ends[0] + word_ends[row]
        if word_ends[end] > word_ends[row]:
            words[word_ends[row] : word_ends[end]] = np.frombuffer(column.buffers()[2], np.uint8)[ends[0] : ends[-1]]
        places = lists.offsets.to_numpy().astype(np.int64)
        id_ends[row + 1 : end + 1] = (places[1:] - places[0]) * 4 + id_ends[row]
        ids[id_ends[row] // 4 : id_ends[end] // 4] = lists.flatten().to_numpy(zero_copy_only=False)
        row = end
    slots[:] = -1
    digest, keys, held = xxhash.xxh3_64_intdigest, np.empty(size, np.uint64), memoryview(block)[at[3] : at[4]]
    for begin in range(0, size, PACKED):  # a list of all ends at once would be most of the driver's memory here
        cuts = word_ends[begin : begin + PACKED + 1].tolist()
        keys[begin : begin + len(cuts) - 1] = [digest(held[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    rest, place = np.arange(size, dtype=np.int32), (keys & np.uint64(mask)).astype(np.int64)
    del keys
    while len(rest):  # one word of each free place settles, the others move on by one
        free = slots[place] < 0
        slots[place[free]] = rest[free]
        left = slots[place] != rest
        rest, place = rest[left], (place[left] + 1) & mask
    return block


class HeadTable:
    """What ``pack_head`` made, read where it lies: a broadcast's file is mapped, so all workers of a machine share its pages."""

    def __init__(self, block: memoryview):
        self.mask, slots, n_words, n_ids, words, ids = np.frombuffer(block, np.int64, 6, len(_MAGIC)).tolist()
        at = len(_MAGIC) + 48
        self.slots = np.frombuffer(block, np.int32, slots, at)
        ends = np.frombuffer(block, np.int32, n_words, at := at + 4 * slots)
        self.id_ends = np.frombuffer(block, np.int32, n_ids, at := at + 4 * n_words)
        self.words = pa.Array.from_buffers(pa.binary(), n_words - 1, [None, pa.py_buffer(ends), pa.py_buffer(block[at + 4 * n_ids : at + 4 * n_ids + words])])
        self.ids = np.frombuffer(block[at + 4 * n_ids + words : at + 4 * n_ids + words + ids], "<i4")

    def find(self, words: pa.BinaryArray) -> np.ndarray:
        """The number of each word, -1 if it is not here; hashes lead to a place, bytes decide."""
        out = np.full(len(words), -1, np.int64)
        digest = xxhash.xxh3_64_intdigest
        place = (np.fromiter(map(digest, words.to_pylist()), np.uint64, len(words)) & np.uint64(self.mask)).astype(np.int64)
        rest = np.arange(len(words))
        while len(rest):
            at = self.slots[place]
            rest, place, at = rest[at >= 0], place[at >= 0], at[at >= 0]
            same = pc.equal(self.words.take(pa.array(at)), words.take(pa.array(rest))).to_numpy(zero_copy_only=False).astype(bool)
            out[rest[same]] = at[same]
            rest, place = rest[~same], (place[~same] + 1) & self.mask
        return out


_TABLES: dict[str, HeadTable] = {}


def _head_table(token: str, shared) -> HeadTable:
    """Opened once in a worker."""
    if token not in _TABLES:
        _TABLES.clear()
        _TABLES[token] = HeadTable(_mapped(shared))
    return _TABLES[token]


def _mapped(shared) -> memoryview:
    """The block of a broadcast; its value is loaded only if there is no plain file to map."""
    path = getattr(shared, "_path", None)
    if path and os.path.exists(path):
        with open(path, "rb") as file:
            held = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        if (at := held.find(_MAGIC, 0, 4096)) >= 0:
            return memoryview(held)[at:]
    return memoryview(shared.value)


def _encoded(words: pa.StringArray, head: HeadTable, ranks: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of distinct words: all ids, where each word's begin, how many they are; and which words are rare, one hole each (-1, -2 and so on)."""
    raw = words.cast(pa.binary())
    place = head.find(raw)
    sizes = np.ones(len(words), np.int64)
    known = place >= 0
    sizes[known] = (head.id_ends[place[known] + 1] - head.id_ends[place[known]]) // 4
    length = pc.binary_length(raw).to_numpy(zero_copy_only=False)
    long = {i: merge_long(raw[i].as_py(), ranks) for i in np.flatnonzero(~known & (length > FOLD_BYTES)).tolist()}
    for i, ids in long.items():
        sizes[i] = len(ids)
    starts = np.cumsum(sizes) - sizes
    flat = np.empty(int(sizes.sum()), np.int32)
    flat[_ragged(starts[known], sizes[known])] = head.ids[_ragged(head.id_ends[place[known]] // 4, sizes[known])]
    for i, ids in long.items():
        flat[starts[i] : starts[i] + len(ids)] = ids
    rare = np.flatnonzero(~known & (length <= FOLD_BYTES))
    flat[starts[rare]] = -1 - np.arange(len(rare))
    return flat, starts, sizes, rare


def _runs(ids: np.ndarray, ends: np.ndarray, holes: np.ndarray) -> pa.ListArray:
    """Each text's ids cut at its holes: one run more than it has holes."""
    kept = np.concatenate([[0], np.cumsum(ids >= 0)])
    # Where a run ends: at a hole, or at a text's end, which comes before a hole at the same place.
    bounds = np.sort(np.concatenate([2 * holes + 1, 2 * ends[1:]]))
    offsets = np.concatenate([[0], kept[bounds // 2]])
    per_text = np.searchsorted(holes, ends, "left") + np.arange(len(ends))
    return pa.ListArray.from_arrays(pa.array(per_text, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[ids >= 0], pa.int32())))


def _looker(token: str, shared, path: str | None, pattern: str, names: list[str], own: list[str], packed: bool):
    """The texts' ids with holes for rare words, in columns called ``own``: ``packed`` in one binary with negative numbers, else as runs and the hole's words' numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, ranks, split = _head_table(token, shared), vocabulary(path), Splitter(pattern)
        for part, texts in _chunks(batches):
            words, seq, begin = split.cut(texts)
            flat, starts, sizes, rare = _encoded(words, head, ranks)
            held = sizes[seq]
            ids = flat[_ragged(starts[seq], held)]
            ends = np.concatenate([[0], np.cumsum(held)])[begin]
            holes = np.flatnonzero(ids < 0)
            # The rare words of each text, each once; a hole says which of them it is.
            of_text = np.searchsorted(ends, holes, "right") - 1
            pairs, which = np.unique(of_text * max(1, len(rare)) + (-1 - ids[holes]), return_inverse=True)
            first = np.searchsorted(pairs, np.arange(len(texts) + 1) * max(1, len(rare)))
            local = which - first[of_text]
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), words.take(pa.array(rare[pairs % max(1, len(rare))])))
            columns = [part.column(part.schema.get_field_index(n)) for n in names]
            if packed:
                ids[holes] = -1 - local
                block = pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(ids.astype("<i4"))])
                yield pa.RecordBatch.from_arrays([*columns, block, lists], names=[*names, *own])
            else:
                at = pa.array(np.searchsorted(holes, ends, "left"), pa.int32())
                yield pa.RecordBatch.from_arrays([*columns, _runs(ids, ends, holes), pa.ListArray.from_arrays(at, pa.array(local, pa.int32())), lists], names=[*names, *own])

    return run


def _slices(batch: pa.RecordBatch, name: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of up to ``most`` bytes of a binary column, a longer row alone."""
    ends = np.cumsum(pc.binary_length(batch.column(batch.schema.get_field_index(name))).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield batch.slice(at, end - at)
        at = end


def _filler(names: list[str], own: list[str], finish):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in lean(batches) for part in _slices(whole, own[0], FILLED_BYTES)):
            folded = batch.column(batch.schema.get_field_index(own[1]))
            words = folded.flatten()
            sizes_of = np.diff(words.offsets.to_numpy()).astype(np.int64)
            more = words.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
            packed = batch.column(batch.schema.get_field_index(own[0]))
            ids = np.frombuffer(b"".join(packed.to_pylist()), "<i4")
            counts = pc.binary_length(packed).to_numpy(zero_copy_only=False).astype(np.int64) // 4
            ends = np.concatenate([[0], np.cumsum(counts)])
            holes = np.flatnonzero(ids < 0)
            first = np.concatenate([[0], np.cumsum(np.diff(folded.offsets.to_numpy()))])
            word = first[np.searchsorted(ends, holes, "right") - 1] - 1 - ids[holes]
            starts, sizes = np.arange(len(ids)), np.ones(len(ids), np.int64)
            starts[holes], sizes[holes] = len(ids) + (np.cumsum(sizes_of) - sizes_of)[word], sizes_of[word]
            full = np.concatenate([ids, more])[_ragged(starts, sizes)]
            cuts = np.concatenate([[0], np.cumsum(sizes)])[ends]
            yield finish([batch.column(batch.schema.get_field_index(n)) for n in names], names, full, cuts)

    return run


def _joined(pieces: pa.BinaryArray, ids: np.ndarray, cuts: np.ndarray) -> Iterator[memoryview]:
    """The pieces of each text's ids, side by side."""
    taken = pieces.take(pa.array(ids, pa.int32()))
    data = memoryview(taken.buffers()[2] or b"")
    ends = np.frombuffer(taken.buffers()[1], np.int32)[taken.offset :][cuts].tolist() if len(ids) else [0] * len(cuts)
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        yield data[a:b]


def _digests(path: str | None):
    def run(columns: list[pa.Array], names: list[str], ids: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
        pieces, decimal = _pieces(path)
        coded = [hashlib.sha256(text[:-1]).hexdigest() for text in _joined(decimal, ids, cuts)]
        plain = [hashlib.sha256(text).hexdigest() for text in _joined(pieces, ids, cuts)]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.diff(cuts), pa.int64()), pa.array(coded, pa.string()), pa.array(plain, pa.string())], names=[*names, "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


_PIECES: dict = {}


def _pieces(path: str | None) -> tuple[pa.BinaryArray, pa.BinaryArray]:
    """Binary piece, and decimal form with a comma, of every id."""
    if path not in _PIECES:
        ranks = vocabulary(path)
        pieces = [b""] * (max(ranks.values()) + 1)
        for piece, rank in ranks.items():
            pieces[rank] = piece
        _PIECES[path] = pa.array(pieces, pa.binary()), pa.array([b"%d," % i for i in range(len(pieces))], pa.binary())
    return _PIECES[path]


def encode_documents(docs: DataFrame, path: str | None = None, pattern: str | None = None, head: int = HEAD_WORDS, finish=None, made: str = "") -> DataFrame:
    """``docs`` without its text, plus ``ids array<int>``; ``finish`` makes the columns ``made`` of packed ids instead, in Python."""
    pattern = pattern or split_pattern()
    ranks = RankMap(docs.sparkSession, vocabulary(path))
    words = head_words(count_words(docs, pattern), head)
    table = ranks.beside(words, "ids", lambda buckets: encode_word(F.col("word"), ranks, buckets)).select("word", "ids").toArrow()
    table = pa.table([table.column(0).cast(pa.string()), table.column(1).cast(pa.list_(pa.int32()))], names=["word", "ids"])
    shared = docs.sparkSession.sparkContext.broadcast(pack_head(table))
    del table
    discard(words)
    fields = [f for f in docs.schema.fields if f.name not in ("text", "ids")]
    names = [f.name for f in fields]
    packed, runs, which, rare, filled = (_unused(name, docs.columns) for name in ("_packed", "_runs", "_which", "_rare", "_folded"))
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in fields)
    own = [packed, rare] if finish else [runs, which, rare]
    kinds = f"{packed} binary, {rare} array<string>" if finish else f"{runs} array<array<int>>, {which} array<int>, {rare} array<string>"
    looker = thrifty(_looker(uuid.uuid4().hex, shared, path, pattern, names, own, finish is not None))
    looked = docs.select("text", *[F.col(f"`{n}`") for n in names]).mapInArrow(looker, ddl + kinds)
    folded = ranks.beside(looked, filled, lambda buckets: F.transform(rare, lambda w: encode_word(w, ranks, buckets))).drop(rare)
    if finish:
        return folded.mapInArrow(thrifty(_filler(names, [packed, filled], finish)), ddl + made)
    none = F.array().cast("array<int>")
    # The rare words are encoded once a row, then put where the holes are.
    words = let(F.col(filled), lambda made_of: F.transform(which, lambda w: F.get(made_of, w)))
    ids = F.flatten(F.zip_with(runs, words, lambda run, word: F.concat(run, F.coalesce(word, none))))
    return folded.select(*[F.col(f"`{n}`") for n in names], ids.alias("ids"))


def _unused(name: str, taken: list[str]) -> str:
    """``name``, or with as many more underscores before it as make it no other column's."""
    while name.lower() in {t.lower() for t in taken}:
        name = f"_{name}"
    return name


def decode_documents(coded: DataFrame, path: str | None = None) -> DataFrame:
    """``coded`` plus ``decoded``, the joined binary pieces of its ids."""
    names = [n for n in coded.columns if n != "decoded"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, _ = _pieces(path)
        for batch in lean(batches):
            ids = batch.column(batch.schema.get_field_index("ids"))
            ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
            plain = [bytes(x) for x in _joined(pieces, ids.flatten().to_numpy(zero_copy_only=False), ends)]
            yield pa.RecordBatch.from_arrays([*[batch.column(batch.schema.get_field_index(n)) for n in names], pa.array(plain, pa.binary())], names=[*names, "decoded"])

    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in coded.schema.fields if f.name != "decoded")
    return coded.select(*[F.col(f"`{n}`") for n in names]).mapInArrow(run, ddl + "decoded binary")


def encode_digests(docs: DataFrame, path: str | None = None, head: int = HEAD_WORDS) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes."""
    made = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encode_documents(docs.select("doc_id", "text"), path, head=head, finish=_digests(path), made=made)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(documents(spark, sf_dir))
