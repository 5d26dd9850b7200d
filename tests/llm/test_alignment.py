"""Alignment of two tokenizers against a brute-force version with the tokenizers' own libraries."""

import hashlib
import os
from collections import Counter, defaultdict

import duckdb
import pytest

from presslens.llm import alignment

os.environ["TOKENIZERS_PARALLELISM"] = "false"
DIR = "/root/testdata/sf0.001"
DDL = "doc_id long, text string"


@pytest.fixture(scope="module")
def libraries():
    import public_tokenizers as p
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(p.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=p.path("piece_bpe_32k.model"))


def tokens(libraries, text):
    """Ids with their end offsets, or two empty lists."""
    a, b = libraries
    if not text:
        return [], []
    raw = (" " + text).encode()
    letters = alignment._byte_letters()
    out = []
    for ids, piece in (
        (a.encode(" " + text, add_special_tokens=False).ids, lambda i: bytes(letters[x] for x in a.id_to_token(i))),
        (b.encode(text), lambda i: bytes([int(b.id_to_piece(i)[3:-1], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()),
    ):
        at, made, joined = 0, [], b""
        for i in ids:
            joined += piece(i)
            at += len(piece(i))
            made.append((i, at))
        if joined != raw:
            return [], []
        out.append(made)
    return tuple(out)


def brute(libraries, rows):
    docs, counts = [], Counter()
    for doc_id, text in rows:
        a, b = tokens(libraries, text)
        at_a, at_b = {e: x for x, e in a}, {e: y for y, e in b}
        cuts = sorted(at_a.keys() & at_b.keys())
        links = [(at_a[e], at_b[e]) for e in cuts]
        groups, i, j = [], 0, 0
        for cut in cuts:
            k, m = i, j
            while k < len(a) and a[k][1] <= cut:
                k += 1
            while m < len(b) and b[m][1] <= cut:
                m += 1
            groups.append(",".join(str(x) for x, _ in a[i:k]) + "|" + ",".join(str(y) for y, _ in b[j:m]))
            i, j = k, m
        counts.update(links)
        docs.append((doc_id, len(a), len(b), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "", len(groups)))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return sorted(((d, na, nb, g, len(ls), sum(counts[x] == most[x[1]] for x in ls), sum(counts[x] for x in ls), h) for d, na, nb, ls, h, g in docs), key=repr)


def rows_of(df):
    return sorted(((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect()), key=repr)


ODD = [
    (1, "the cat sat on the mat"), (2, None), (3, ""), (4, " "), (5, "a  b \n c\t d "), (6, "x▁y"), (7, "<|endoftext|> <s> </s> <0x41>"), (8, "漢字 かな 😀 é ﬁ"), (9, "\x00\x1c\x85  ‌"),
    (10, "the cat sat on the mat"), (10, "the cat sat on the mat"), (None, "the cat sat on the mat"), (None, None), (None, "unanswerable antidisestablishmentarianism"), (1, "unanswerable"), (11, "Ünïcödé naïve  "),
]


def test_odd_texts(spark, libraries):
    docs = spark.createDataFrame(ODD, DDL).selectExpr("*", "1 AS part", "2 AS digest", "3 AS pair", "4 AS copies")
    assert rows_of(alignment.align_documents(docs)) == brute(libraries, ODD)


def test_few_frequent_pairs(spark, libraries):
    """Pairs beyond the broadcast ones meet their counts in the join; windows and rows of links are crossed."""
    rows = [(i, "the cat sat on the unanswerable mat, 漢字 and more words " * k) for i, k in enumerate((1, 2, 400, 3, 1500))]
    docs = spark.createDataFrame(rows, DDL).repartition(3)
    for most in (0, 3):
        assert rows_of(alignment.align_documents(docs, most_frequent=most)) == rows_of(alignment.align_documents(docs))
    small = rows[:2] + rows[3:4]
    assert rows_of(alignment.align_documents(spark.createDataFrame(small, DDL), most_frequent=2)) == brute(libraries, small)


def test_groups(spark, libraries):
    rows = [(1, "unanswerable 漢字 cats"), (2, None)]
    got = alignment.aligned_groups(spark.createDataFrame(rows, DDL)).orderBy("start").collect()
    a, b = tokens(libraries, rows[0][1])
    assert [i for r in got for i in r.a_ids] == [i for i, _ in a] and [i for r in got for i in r.b_ids] == [i for i, _ in b]
    assert [r.end for r in got] == sorted({e for _, e in a} & {e for _, e in b}) and got[0].start == 0


def test_empty(spark):
    assert alignment.align_documents(spark.createDataFrame([], DDL)).count() == 0


def test_query(spark, libraries):
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{DIR}/documents.parquet'").fetchall()
    assert rows_of(alignment.op11_alignment(spark, DIR)) == brute(libraries, rows)
