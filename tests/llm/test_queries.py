"""The registered queries on the smallest tables: against DuckDB where there is SQL, against brute force where there is none."""

import base64
import glob
import hashlib
import os
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import tiktoken

from presslens.llm import registry

DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.fixture(scope="module")
def duck():
    db = duckdb.connect()
    for path in glob.glob(f"{DIR}/*.parquet"):
        db.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return db


@pytest.fixture(scope="module")
def texts(duck):
    return {i: t or "" for i, t in duck.execute("SELECT doc_id, text FROM documents").fetchall()}


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_against_sql(spark, duck, name):
    df = registry.QUERIES[name](spark, DIR)
    want = duck.execute(registry.ORACLE_SQL[name])
    names = sorted(c[0] for c in want.description)
    assert names == sorted(df.columns)
    order = [[c[0] for c in want.description].index(n) for n in names]
    assert sorted(([plain(r[n]) for n in names] for r in df.collect()), key=repr) == sorted(([plain(r[i]) for i in order] for r in want.fetchall()), key=repr)


def test_op1(spark, texts):
    got = registry.QUERIES["op1_sharding"](spark, DIR).collect()
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.grown_shard in (r.shard, 16) and r.law == "key" for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_op2(spark, texts):
    import public_tokenizers as p

    with open(p.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = registry.QUERIES["op2_bpe"](spark, DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = own.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_op5(spark, texts):
    assign = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
    got = registry.QUERIES["op5_secrets"](spark, DIR).collect()
    assert len(got) == len(texts)
    for r in got:
        t = texts[r.doc_id]
        spans = [(m.start(), 0, m.end()) for m in assign.finditer(t) if len(m[1]) >= 8] + [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16] + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
        said = [f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans)]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in spans) for i in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(said).encode()).hexdigest()
        assert [x for x in r.spans.split(",") if x and not x.startswith("auto:")] == said


def test_op8(spark, texts, duck):
    got = registry.QUERIES["op8_quality"](spark, DIR).collect()
    assert len(got) == len(texts)
    good = {i for (i,) in duck.execute("SELECT doc_id FROM labels WHERE quality = 1").fetchall()}
    bad = {i for (i,) in duck.execute("SELECT doc_id FROM labels WHERE quality = 0").fetchall()}
    for r in got:
        t = texts[r.doc_id]
        words = WORD.findall(t)
        windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
        often = Counter(windows)
        again = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(words) < 10 or 100 * len(again) > 20 * len(words)) and not (r.base_failed and r.kept)
    kept = {r.doc_id for r in got if r.kept}
    failed = {r.doc_id for r in got if r.base_failed}
    assert good - failed <= kept and len(bad & kept) <= 0.1 * len(bad)


def test_op9(spark, texts):
    email, phone = re.compile(r"[A-Za-z0-9._%+-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"), re.compile(r"\(\d{3}\) \d{3}-\d{4}")
    got = {r.doc_id: r for r in registry.QUERIES["op9_pii"](spark, DIR).collect()}
    assert got.keys() == texts.keys()
    made = {}
    for i, t in texts.items():
        new = got[i].text
        for pattern, shape in ((email, False), (phone, True)):
            old, now = pattern.findall(t), pattern.findall(new)
            assert len(old) == len(now)
            for a, b in zip(old, now, strict=True):
                assert made.setdefault(a.lower(), b) == b and a.lower() != b
                if shape:
                    assert re.sub(r"\d", "0", a) == re.sub(r"\d", "0", b)
        if not re.search(r"[0-9@]", t):
            assert new == t
    assert len(set(made.values())) == len(made)
