"""Document likelihoods against a brute-force version that lists all segmentations, and on held-out documents."""

import itertools
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from presslens.llm import lattice

DIR = "/root/testdata/sf0.001"
DDL = "doc_id long, text string"


def table(path=None):
    """The pieces with their numbers, read out of the trie."""
    held, found = lattice.pieces(path), {}

    def walk(node, said):
        if held.piece[node] >= 0:
            found[said] = int(held.piece[node])
        for b in np.flatnonzero(held.step[node]).tolist():
            walk(held.step[node, b], said + bytes([b]))

    walk(1, b"")
    return found


@pytest.fixture(scope="module")
def found():
    return table()


def segmentations(found, raw):
    if not raw:
        yield ()
    for end in range(1, len(raw) + 1):
        if raw[:end] in found:
            yield from ((found[raw[:end]], *rest) for rest in segmentations(found, raw[end:]))


def brute_model(found, counts, ended, rounds):
    logs, end = lattice.weigh(np.zeros(len(found)), 0.0)
    for _ in range(rounds):
        expected = np.zeros(len(found))
        for word, n in counts.items():
            ways = list(segmentations(found, b" " + word))
            weights = np.array([math.exp(sum(logs[p] for p in way)) for way in ways])
            for way, share in zip(ways, weights / weights.sum(), strict=True):
                for p in way:
                    expected[p] += n * share
        logs, end = lattice.weigh(expected, ended)
    return logs, end


def brute(found, rows, rounds=lattice.ROUNDS):
    train, ended = Counter(), 0
    for doc_id, text in rows:
        if not lattice.held_out(doc_id):
            train.update(lattice.words_of((text or "").encode()))
            ended += 1
    total, kinds = sum(train.values()) + ended, len(train) + (ended > 0)
    logs, end = brute_model(found, train, ended, rounds)
    out = []
    for doc_id, text in rows:
        words = lattice.words_of((text or "").encode())
        seen = [train[w] for w in words] + [ended]
        base = sum(math.log10((c + 0.1) / (total + 0.1 * (kinds + 1))) for c in seen)
        score = end + sum(math.log(sum(math.exp(sum(logs[p] for p in way)) for way in segmentations(found, b" " + w))) for w in words)
        out.append((doc_id, lattice.held_out(doc_id), len(seen), sum(c > 0 for c in seen), total, base, score / math.log(10)))
    return out


def check(got, want):
    def plain(r):
        return tuple(round(x, 6) if isinstance(x, float) else x for x in r)

    names = ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    assert sorted((plain(tuple(r[n] for n in names)) for r in got), key=repr) == sorted(map(plain, want), key=repr)


ROWS = [(i, t) for i, t in enumerate(["the cat sat", "The CAT\tsat\n on it", None, "", " \n", "été 漢 x", "zzq qzz", "the the the", "a b c d", "the cat", "mat", "on the mat", "\x00", "cat"])] + [(3, "the cat"), (3, "the cat"), (None, "the odd"), (None, None), (None, "the odd")]


def test_all_segmentations(spark, found):
    docs = spark.createDataFrame(ROWS, DDL).selectExpr("*", "1 AS word", "2 AS k", "3 AS c", "4 AS copies", "5 AS digest").repartition(3)
    want = brute(found, ROWS)
    check(lattice.score_documents(docs).collect(), want)
    for most in (0, 3):
        check(lattice.score_documents(docs, most_frequent=most).collect(), want)


def test_without_training_rows(spark, found):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    rows = [(i, "the cat") for i in held]
    check(lattice.score_documents(spark.createDataFrame(rows, DDL)).collect(), brute(found, rows))
    assert lattice.score_documents(spark.createDataFrame([], DDL)).count() == 0


def test_long_words(found):
    """A word of 3,000 bytes: the recursion stays in log space, and agrees with a plain one."""
    logs, _ = lattice.weigh(np.zeros(len(found)), 0.0)
    word = b"antidisestablishment" * 150
    raw, alpha = b" " + word, [0.0] + [-math.inf] * (len(word) + 1)
    for j, i in itertools.product(range(1, len(raw) + 1), range(1, 20)):
        if i <= j and raw[j - i : j] in found:
            alpha[j] = np.logaddexp(alpha[j], alpha[j - i] + logs[found[raw[j - i : j]]])
    got = lattice.likelihoods([b"the", word, b"cat"], logs)
    assert got[1] < -5000 and abs(got[1] - alpha[-1]) < 1e-6


def test_query(spark, found):
    """Counts and base scores of the table; the trained weights beat the first ones on held-out documents."""
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{DIR}/documents.parquet'").fetchall()
    got = {r.doc_id: r for r in lattice.op12_likelihood(spark, DIR).collect()}
    assert len(got) == len(rows)
    train, ended = Counter(), 0
    for doc_id, text in rows:
        if not lattice.held_out(doc_id):
            train.update(lattice.words_of((text or "").encode()))
            ended += 1
    total, kinds = sum(train.values()) + ended, len(train) + 1
    first, end = lattice.weigh(np.zeros(len(found)), 0.0)
    before = after = 0.0
    for doc_id, text in rows:
        words = lattice.words_of((text or "").encode())
        seen, r = [train[w] for w in words] + [ended], got[doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (lattice.held_out(doc_id), len(seen), sum(c > 0 for c in seen), total)
        assert abs(r.base_score - sum(math.log10((c + 0.1) / (total + 0.1 * (kinds + 1))) for c in seen)) < 1e-6
        if r.held_out:
            before += (end + lattice.likelihoods(words, first).sum()) / math.log(10)
            after += r.score
    assert before < after < 0 and after > 0.8 * before
