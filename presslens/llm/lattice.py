"""Document likelihood under a unigram model of subwords, over all segmentations.

The pieces are those of an existing vocabulary and stay as they are. Its scores are the order of its merges; they weigh the pieces
by Zipf's law at first. The corpus weighs them anew: in each of ``ROUNDS`` rounds the forward and backward recursions over
the lattice of every training word give the expected number of each piece, and the expectations, with a little of the first
weights, are the next round's weights. The probability of a text is that of its words and of an end, a word's that of all
segmentations of a space and its bytes, by the forward recursion in log space. As no piece reaches over a space, that is the sum
over all segmentations of the document. Every byte is a piece, so every text has a probability.

A word's probability is the same wherever it occurs, so each distinct word goes through the lattice once, many of the same
length at a time. The ``FREQUENT`` most frequent words go to every task (their number is the bound of what is broadcast); all
other words of a document meet their counts and probabilities in a join. Nothing else is collected but the expectations, one number a piece.

Cases: a null or empty text has the end alone. A null doc_id counts as empty text, whose remainder is 0: held out. Rows that repeat are
returned as often as they come, and their words count each time. Other columns are not read. Without training rows the base
score of every token is log10(1) and the first weights remain. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm.common import discard, documents, materialise, spread_copies, text_bytes, thrifty

VOCABULARY = "piece_bpe_32k.model"
FREQUENT = 1 << 18
ROUNDS = 2
#: Added to a word's count in the base score.
ADDED = 0.1
#: The first weights count as so many pieces seen.
PRIOR = 1000.0
#: The end of a document; no word holds a space.
END = b" "
#: Cells of the lattices that are worked on together, distinct words that a task counts before it sends them on.
CELLS, HELD = 1 << 19, 1 << 17
#: Expectations are sent as multiples of this, which makes their sum the same in any order.
UNIT = 2.0**-20


@dataclass
class Pieces:
    """A vocabulary's byte strings, their first weights, and the trie that finds them: ``step[node, byte]``, 0 for none, root 1."""

    prior: np.ndarray
    step: np.ndarray
    piece: np.ndarray


@functools.cache
def pieces(path: str | None = None) -> Pieces:
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
    size, weights = model.get_piece_size(), {}
    for i in range(size):
        if model.is_control(i) or model.is_unknown(i):
            continue
        piece = model.id_to_piece(i)
        raw = bytes([int(piece[3:-1], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()
        rank = size if model.is_byte(i) else -model.get_score(i)
        weights[raw] = weights.get(raw, 0.0) + 1 / (rank + 2.7)
    for b in range(256):
        weights.setdefault(bytes([b]), 1 / (size + 2.7))
    steps, ends = [{}, {}], [-1, -1]
    for number, raw in enumerate(weights):
        node = 1
        for b in raw:
            if b not in steps[node]:
                steps[node][b] = len(steps)
                steps.append({})
                ends.append(-1)
            node = steps[node][b]
        ends[node] = number
    step = np.zeros((len(steps), 256), np.int32)
    for node, after in enumerate(steps):
        step[node, list(after)] = list(after.values())
    prior = np.array(list(weights.values()))
    return Pieces(prior / prior.sum(), step, np.array(ends))


def weigh(expected: np.ndarray, ended: float, path: str | None = None) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces and of the end, from the expected numbers of both."""
    prior = pieces(path).prior
    share = 1 / (1 + len(prior))  # the end is one symbol among them
    total = expected.sum() + ended + PRIOR
    return np.log((expected + PRIOR * (1 - share) * prior) / total), math.log((ended + PRIOR * share) / total)


def _forward(cells: np.ndarray, held: Pieces, logs: np.ndarray, edges: list | None = None) -> np.ndarray:
    """``alpha[i]``: log probability of each word's first i bytes. ``cells``: one column a word. ``edges`` gets the pieces used."""
    n, m = cells.shape
    alpha = np.full((n + 1, m), -np.inf)
    alpha[0] = 0
    every = np.arange(m)
    for i in range(n):
        rows, node = every, held.step[1, cells[i]]
        for j in range(i, n):
            piece = held.piece[node]
            ends = piece >= 0
            at, used = rows[ends], piece[ends]
            if len(at):
                alpha[j + 1, at] = np.logaddexp(alpha[j + 1, at], alpha[i, at] + logs[used])
                if edges is not None:
                    edges.append((i, j + 1, at, used))
            if j + 1 == n:
                break
            node = held.step[node, cells[j + 1, rows]]
            goes = node > 0
            rows, node = rows[goes], node[goes]
            if not len(rows):
                break
    return alpha


def _same_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The places of words of one length, and their bytes after a space, one column a word."""
    sizes = np.array([len(w) for w in words])
    order = np.argsort(sizes, kind="stable")
    at = 0
    while at < len(order):
        n = sizes[order[at]] + 1
        end = min(int(np.searchsorted(sizes[order], n - 1, "right")), at + max(1, CELLS // n))
        places = order[at:end]
        yield places, np.frombuffer(b"".join([b" " + words[k] for k in places]), np.uint8).reshape(len(places), n).T.copy()
        at = end


def likelihoods(words: list[bytes], logs: np.ndarray, path: str | None = None) -> np.ndarray:
    """The natural log of each word's probability, a space before it."""
    held, out = pieces(path), np.zeros(len(words))
    for places, cells in _same_length(words):
        out[places] = _forward(cells, held, logs)[-1]
    return out


def expectations(words: list[bytes], counts: np.ndarray, logs: np.ndarray, path: str | None = None) -> np.ndarray:
    """How often each piece is expected in words that occur ``counts`` times."""
    held, out = pieces(path), np.zeros(len(logs))
    for places, cells in _same_length(words):
        edges: list = []
        alpha = _forward(cells, held, logs, edges)
        beta = np.full(alpha.shape, -np.inf)
        beta[-1] = 0
        times = np.log(counts[places]) - alpha[-1]
        used, much = [], []
        for i, j, at, piece in reversed(edges):
            after = logs[piece] + beta[j, at]
            beta[i, at] = np.logaddexp(beta[i, at], after)
            used.append(piece)
            much.append(np.exp(alpha[i, at] + after + times[at]))
        out += np.bincount(np.concatenate(used), np.concatenate(much), len(out))
    return out


def held_out(doc_id: object) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def words_of(raw: bytes) -> list[bytes]:
    return raw.lower().split()


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, its number in training rows, in all rows), summed up over a part of a task's rows."""

    def said() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(every.keys(), pa.binary()), pa.array([train.get(w, 0) for w in every], pa.int64()), pa.array(every.values(), pa.int64())], names=["word", "c", "n"])

    train, every = Counter(), Counter()
    for batch in batches:
        for doc_id, raw in zip(batch.column(0).to_pylist(), text_bytes(batch), strict=True):
            words = words_of(raw)
            words.append(END)
            every.update(words)
            if not held_out(doc_id):
                train.update(words)
            if len(every) > HELD:
                yield said()
                train, every = Counter(), Counter()
    if every:
        yield said()


def word_counts(docs: DataFrame) -> DataFrame:
    """word (``END`` for the end of a document), c (in training rows), n (in all rows), as a table of ``materialise``."""
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    return materialise(rows.mapInArrow(thrifty(_counter), "word binary, c long, n long").groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "words")


def _expecter(model, path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, total = model.value, None
        for batch in batches:
            made = expectations(batch.column(0).to_pylist(), batch.column(1).to_numpy().astype(float), logs, path)
            total = made if total is None else total + made
        if total is not None:
            some = np.flatnonzero(total >= UNIT / 2)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(np.rint(total[some] / UNIT).astype(np.int64))], names=["piece", "much"])

    return thrifty(run)


def train(words: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> tuple[np.ndarray, float]:
    """Log probabilities of the pieces and of the end, from all training words."""
    spark = words.sparkSession
    ended = words.filter(F.col("word") == F.lit(END)).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    logs, end = weigh(np.zeros(len(pieces(path).prior)), 0.0, path)
    for _ in range(rounds):
        model = spark.sparkContext.broadcast(logs)
        seen = words.filter((F.col("c") > 0) & (F.col("word") != F.lit(END))).select("word", "c")
        sums = seen.mapInArrow(_expecter(model, path), "piece long, much long").groupBy("piece").agg(F.sum("much").alias("much")).toArrow()  # one row a piece
        expected = np.zeros(len(logs))
        expected[sums.column("piece").to_numpy()] = sums.column("much").to_numpy() * UNIT
        logs, end = weigh(expected, float(ended), path)
        model.destroy()
    return logs, end


def _liker(model, path: str | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        logs, end = model.value
        for batch in batches:
            words = batch.column(0).to_pylist()
            lp = np.where(np.array([w == END for w in words], bool), end, likelihoods(words, logs, path)) / math.log(10)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lp)], names=["word", "c", "n", "lp"])

    return thrifty(run)


KEY = ("doc_id", "held_out", "digest")
#: Logarithms of other words are added up as multiples of this, in any order the same.
FINE = 10**12
_PARTS = pa.schema([("held_out", pa.bool_()), ("digest", pa.binary()), ("word", pa.binary()), ("k", pa.int64()), ("whole", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("logs", pa.float64()), ("score", pa.float64())])
_PARTS_DDL = "held_out boolean, digest binary, word binary, k long, whole boolean, n_tokens long, n_known long, logs double, score double"


def _adder(frequent, kind: pa.DataType):
    """Per row its sums over the frequent words, and a row for each other word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, known, logs, scores = frequent.value
        for batch in batches:
            ids, rows = [], []
            for doc_id, raw in zip(batch.column(0).to_pylist(), text_bytes(batch), strict=True):
                count = Counter(words_of(raw))
                count[END] = 1
                key = (held_out(doc_id), hashlib.sha256(raw).digest()[:16])
                at = [place.get(w, -1) for w in count]
                found, times = np.array(at), np.array(list(count.values()))
                there = found >= 0
                found, some = found[there], times[there]
                rows.append((*key, b" " + key[1], 0, True, int(times.sum()), int(some[known[found]].sum()), math.fsum(some * logs[found]), math.fsum(some * scores[found])))
                rows += [(*key, w, k, False, 0, 0, 0.0, 0.0) for w, k, a in zip(count, times.tolist(), at, strict=True) if a < 0]
                ids += [doc_id] * (len(rows) - len(ids))
                if len(rows) > 1 << 15:
                    yield _part_batch(ids, rows, kind)
                    ids, rows = [], []
            if rows:
                yield _part_batch(ids, rows, kind)

    return thrifty(run)


def _part_batch(ids: list, rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    columns = [pa.array(ids, kind), *[pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PARTS, strict=True)]]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", *_PARTS.names])


def score_documents(docs: DataFrame, path: str | None = None, rounds: int = ROUNDS, most_frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (both log10)."""
    spark = docs.sparkSession
    counted = word_counts(docs)
    model = spark.sparkContext.broadcast(train(counted, path, rounds))
    words = materialise(counted.mapInArrow(_liker(model, path), "word binary, c long, n long, lp double"), "likelihoods")
    discard(counted)
    total, kinds = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    top = words.orderBy(F.desc("n"), "word").limit(most_frequent).toArrow()
    names, c, n = top.column("word").to_pylist(), top.column("c").to_numpy(), top.column("n").to_numpy()
    frequent = spark.sparkContext.broadcast(({w: i for i, w in enumerate(names)}, c > 0, np.log10(c + ADDED), top.column("lp").to_numpy()))
    least, final = (int(n[-1]), names[-1]) if names else (1 << 62, b"")
    others = words.filter((F.col("n") < least) | ((F.col("n") == least) & (F.col("word") > F.lit(final)))).select(F.col("word").alias("_word"), "c", "lp")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = {"string": pa.string(), "int": pa.int32()}.get(rows.schema["doc_id"].dataType.simpleString(), pa.int64())
    parts = rows.mapInArrow(_adder(frequent, kind), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {_PARTS_DDL}")
    joined = parts.join(others, F.col("word") == F.col("_word"), "left")

    def times(value):
        return F.sum(F.coalesce(F.col("k") * F.round(value * FINE).cast("decimal(20,0)"), F.lit(0).cast("decimal(31,0)")))

    summed = joined.groupBy(*KEY).agg(
        F.count_if("whole").alias("copies"), F.max("n_tokens").alias("n_tokens"), F.max("n_known").alias("_known"), F.sum(F.when(F.col("c") > 0, F.col("k")).otherwise(0)).alias("_others"),
        F.max(F.when(F.col("whole"), F.col("logs"))).alias("_logs"), F.max(F.when(F.col("whole"), F.col("score"))).alias("_score"), times(F.log10(F.col("c") + ADDED)).alias("_more_logs"), times(F.col("lp")).alias("_more_score"),
    )

    def of_one(name: str):
        return F.col(name).cast("double") / F.col("copies") / FINE

    smoothed = math.log10(total + ADDED * (kinds + 1))
    made = summed.select(
        "doc_id", "held_out", "n_tokens", (F.col("_known") + (F.col("_others") / F.col("copies")).cast("long")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("_logs") + of_one("_more_logs") - F.col("n_tokens") * F.lit(smoothed)).alias("base_score"), (F.col("_score") + of_one("_more_score")).alias("score"), "copies",
    )
    return spread_copies(made, "copies", "_copy").drop("copies", "_copy")


def op12_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir))
