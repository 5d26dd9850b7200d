"""Exact deduplication by an exchange of Golomb-coded fingerprints.

1. Every task turns its documents into blocks: 64-bit hash, code points, SHA-256 and id of each document. The blocks are
   written to the shared folder; they hold no text.
2. From each block, every owner of a hash range gets the block's distinct hashes in its range, sorted, as Golomb-Rice coded
   gaps. An owner decodes all lists and answers each block with a bitmap: one bit per hash, set if another block has it.
3. Blocks and bitmaps meet again; a document is a suspect if its bit is set or its hash repeats inside the block.
4. Only suspects' texts are compared: grouped by their normalised bytes, with the count and the best row of each group
   combined before the shuffle, so that a group may hold any share of the rows.

Cases: texts of any length are hashed and compared whole; null text is empty text, and all empty texts are equal; of equal texts the row with the most code points in the
original, then the smallest doc_id stays; rows that repeat wholly, doc_id and text, share one verdict and are all counted
in ``group_size`` (``dedup_documents`` returns them once); an empty table gives an empty result; other columns are not read.
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

from presslens.llm.common import SPACES, batch_of, discard, documents, lean, materialise, row_count, text_bytes, thrifty

#: Documents in a block at most, and fingerprints that one owner decodes on average.
BLOCK_DOCS = 1 << 18
OWNER_HASHES = 1 << 22

BLOCKS = "block long, ids array<long>, hashes array<long>, points array<long>, shas binary"
_BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())), ("points", pa.list_(pa.int64())), ("shas", pa.binary())])
CODES = "owner int, block long, n int, k int, unary binary, rest binary"
_CODES = pa.schema([("owner", pa.int32()), ("block", pa.int64()), ("n", pa.int32()), ("k", pa.int32()), ("unary", pa.binary()), ("rest", pa.binary())])
MAPS = "owner int, block long, bits binary"
_MAPS = pa.schema([("owner", pa.int32()), ("block", pa.int64()), ("bits", pa.binary())])
DOCS = "doc_id long, points long, sha string, suspect boolean"
_DOCS = pa.schema([("doc_id", pa.int64()), ("points", pa.int64()), ("sha", pa.string()), ("suspect", pa.bool_())])


def golomb_encode(sorted_values: np.ndarray, span: int) -> tuple[int, bytes, bytes]:
    """Rice parameter, unary quotients and binary remainders of the gaps of distinct sorted numbers below ``span``."""
    n = len(sorted_values)
    k = max(0, int(math.log2(max(1.0, span / max(1, n)) * 0.69 + 1e-9))) if n else 0
    gaps = np.diff(sorted_values, prepend=np.uint64(0)).astype(np.uint64)
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1) - 1
    unary = np.zeros(int(ends[-1]) + 1 if n else 0, np.uint8)
    unary[ends] = 1
    shifts = np.arange(k - 1, -1, -1, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8)
    return k, np.packbits(unary).tobytes(), np.packbits(rest.ravel()).tobytes()


def golomb_decode(n: int, k: int, unary: bytes, rest: bytes) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    ends = np.flatnonzero(np.unpackbits(np.frombuffer(unary, np.uint8)))[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    bits = np.unpackbits(np.frombuffer(rest, np.uint8))[: n * k].reshape(n, k)
    remainders = np.zeros(n, np.uint64)
    for j in range(k):
        remainders = (remainders << np.uint64(1)) | bits[:, j].astype(np.uint64)
    return np.cumsum((quotients.astype(np.uint64) << np.uint64(k)) | remainders, dtype=np.uint64)


def _owners_of(hashes: np.ndarray, owners: int) -> np.ndarray:
    return (((hashes >> np.uint64(32)) * np.uint64(owners)) >> np.uint64(32)).astype(np.int32)


def _first_of(owner: int, owners: int) -> int:
    """The least hash of an owner's range."""
    return -(-(owner << 32) // owners) << 32


def _to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    context, made = TaskContext.get(), 0
    ids: list = []
    hashes, points, shas = [], [], []

    def block() -> pa.RecordBatch:
        number = (context.partitionId() << 24) | made
        return batch_of(_BLOCKS, [[number], [ids], [np.array(hashes, np.uint64).view(np.int64).tolist()], [points], [b"".join(shas)]])

    for batch in lean(batches):
        for doc_id, text in zip(batch.column(batch.schema.get_field_index("doc_id")).to_pylist(), text_bytes(batch), strict=True):
            plain = text.translate(None, SPACES)
            ids.append(doc_id)
            hashes.append(xxhash.xxh3_64_intdigest(plain))
            points.append(len(text) if text.isascii() else len(text.decode("utf-8", "replace")))
            shas.append(hashlib.sha256(plain).digest())
            if len(ids) >= BLOCK_DOCS:
                yield block()
                made += 1
                ids, hashes, points, shas = [], [], [], []
    if ids:
        yield block()


def _encoder(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes = np.unique(np.array(row["hashes"], np.int64).view(np.uint64))
                owner = _owners_of(hashes, owners)
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                out = []
                for at, to in zip(starts, [*starts[1:], len(hashes)], strict=True):
                    o = int(owner[at])
                    first = _first_of(o, owners)
                    k, unary, rest = golomb_encode(hashes[at:to] - np.uint64(first), (1 << 64) // owners)
                    out.append((o, row["block"], int(to - at), k, unary, rest))
                if out:
                    yield batch_of(_CODES, list(map(list, zip(*out, strict=True))))

    return run


def _answer(table: pa.Table) -> pa.Table:
    """An owner's part: which of the hashes that blocks sent came from more than one of them."""
    rows = table.to_pylist()
    lists = [golomb_decode(r["n"], r["k"], r["unary"], r["rest"]) for r in rows]
    values, counts = np.unique(np.concatenate(lists), return_counts=True)
    repeated = values[counts > 1]
    bits = [np.packbits(np.isin(x, repeated, assume_unique=True)).tobytes() for x in lists]
    return pa.table([pa.array([r["owner"] for r in rows], pa.int32()), pa.array([r["block"] for r in rows], pa.int64()), pa.array(bits, pa.binary())], schema=_MAPS)


def _marker(owners: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                hashes = np.array(row["hashes"], np.int64).view(np.uint64)
                distinct, where, counts = np.unique(hashes, return_inverse=True, return_counts=True)
                owner = _owners_of(distinct, owners)
                flags = counts > 1
                for m in row["maps"]:
                    # Owners' ranges ascend, and so do the distinct hashes.
                    first, end = np.searchsorted(owner, [m["owner"], m["owner"] + 1]).tolist()
                    flags[first:end] |= np.unpackbits(np.frombuffer(m["bits"], np.uint8))[: end - first].astype(bool)
                hexed = row["shas"].hex()
                yield batch_of(_DOCS, [row["ids"], row["points"], [hexed[i : i + 64] for i in range(0, len(hexed), 64)], pa.array(flags[where])])

    return run


def _verdicts(docs: DataFrame) -> DataFrame:
    """What ``find_copies`` gives, and the code points of every row's text."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    n = row_count(docs)
    owners = max(1, math.ceil(n / OWNER_HASHES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), n // 500))
    blocks = materialise(docs.mapInArrow(thrifty(_to_blocks), BLOCKS), "blocks")
    codes = blocks.select("block", "hashes").mapInArrow(_encoder(owners), CODES)
    maps = codes.groupBy("owner").applyInArrow(_answer, MAPS)
    maps = maps.groupBy("block").agg(F.collect_list(F.struct("owner", "bits")).alias("maps"))
    marked = materialise(blocks.join(maps, "block").mapInArrow(_marker(owners), DOCS), "marked")

    suspects = marked.filter("suspect")
    wanted = suspects.select("doc_id").distinct()
    texts = docs.join(wanted, docs.doc_id.eqNullSafe(wanted.doc_id), "left_semi")
    text = F.coalesce(F.col("text"), F.lit(""))
    plain = F.translate(text, SPACES.decode(), "")
    order = F.struct(F.length(text).alias("points"), (-F.col("doc_id")).alias("minus"), F.col("doc_id").alias("keep"))
    groups = texts.select(plain.alias("plain"), order.alias("order")).groupBy("plain").agg(F.count(F.lit(1)).alias("group_size"), F.max("order").alias("best"))
    groups = groups.select(F.sha2(F.col("plain").cast("binary"), 256).alias("sha"), "group_size", F.col("best.keep").alias("keep_id"), F.col("best.points").alias("most"))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("most"))
    several = suspects.join(groups, "sha").select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("text_sha256"), "points")
    discard(blocks)
    single = marked.filter("not suspect").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("sha").alias("text_sha256"), "points")
    return single.unionByName(several)


def find_copies(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 (of the normalised text) of every row."""
    return _verdicts(docs).drop("points")


def dedup_documents(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns: one of each text, whatever other texts have its doc_id or have none.

    A verdict holds for a doc_id, a normalised text and its code points; of kept rows that share these, the least text stays.
    Columns of any names pass through.
    """
    key = ["doc_id", "text_sha256", "points"]
    several = _verdicts(docs).filter("group_size > 1").groupBy(*key).agg(F.first("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    several = materialise(several.filter("not kept or n > 1"), "several")
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    rows = rows.withColumns({"sha": F.sha2(F.translate(text, SPACES.decode(), "").cast("binary"), 256), "length": F.length(text).cast("long")})

    def same(other: DataFrame):
        return F.col("doc.doc_id").eqNullSafe(other.doc_id) & (F.col("sha") == other.text_sha256) & (F.col("length") == other.points)

    stay = rows.join(several, same(several), "left_anti").select("doc.*")
    twice = several.filter("kept")
    if twice.isEmpty():
        return stay
    first = rows.join(twice, same(twice), "left_semi").groupBy("doc.doc_id", "sha").agg(F.min_by("doc", text).alias("doc"))
    return stay.unionByName(first.select("doc.*"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_copies(documents(spark, sf_dir))
