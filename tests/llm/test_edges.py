"""Clashing column names, repeated rows, nulls, long texts and empty tables, operator by operator."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from presslens.llm import chat, common, exact_dedup, mixing, near_dedup, pii, quality, substring_dedup

#: Columns named like those that operators make inside.
NAMES = ("draws", "_size", "_lang", "_source", "_n_words", "_kept", "_row", "doc", "hash", "row", "copies", "number", "_sha", "_points", "cell", "key", "_rare", "size", "id", "text_sha256")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in NAMES)


def clashing(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 1, *NAMES) for i, t, s in rows], SCHEMA).repartition(3)


def said(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(n))


@pytest.mark.parametrize("stage", [quality.filter_documents, exact_dedup.dedup_documents, near_dedup.dedup_near, mixing.mix_documents])
def test_columns_of_any_name_pass(spark, stage):
    rows = [(i, said(40, i), f"s{i % 2}") for i in range(12)] + [(None, None, None), (3, "", None)]
    out = stage(clashing(spark, rows))
    assert out.columns == [c.split()[0].strip("`") for c in SCHEMA.split(", ")]
    got = out.collect()
    assert got and all(tuple(r[n] for n in NAMES) == NAMES for r in got)
    assert stage(clashing(spark, rows).filter("false")).count() == 0


def test_mix_of_repeated_rows_is_whole(spark):
    rows = [(1, said(30, 1), "a")] * 3 + [(2, said(30, 2), "a"), (None, said(30, 3), "a"), (None, said(30, 4), "a"), (7, said(20, 5), "b")]
    docs = clashing(spark, rows)
    plan, mixed = mixing.plan_mix(docs).collect(), mixing.mix_documents(docs).collect()
    assert len(plan) == len(rows)
    assert sum(len(r.text.split()) for r in mixed) == sum(r.taken for r in plan)
    again = mixing.mix_documents(docs.repartition(2)).collect()
    assert [r.text for r in again] == [r.text for r in mixed]
    most = Counter(r.text for r in mixed)
    copies = Counter(t for _, t, _ in rows)
    assert all(n <= 2 * copies[t] for t, n in most.items() if t in copies)


def test_many_copies_of_a_row_are_spread(spark):
    frame = spark.createDataFrame([("a", 3), ("b", 150_000)], "k string, n long")
    got = common.spread_copies(frame, "n", "i").groupBy("k").agg({"i": "max", "*": "count"}).collect()
    assert {r.k: (r["count(1)"], r["max(i)"]) for r in got} == {"a": (3, 2), "b": (150_000, 149_999)}


def test_every_rate_has_bounds_of_its_own_group(spark):
    r = random.Random(4)
    rows = []
    for i in range(400):
        source = f"s{i % 4}"
        junk = r.random() < (0.02, 0.1, 0.3, 0.6)[i % 4]
        rows.append((i, " ".join(("## " if junk else "") + w for w in said(40, i).split()), source))
    docs = clashing(spark, rows)
    limits = quality.bounds(quality.measured(docs)).collect()
    assert len({x.symbols_high for x in limits}) == 4
    kept = {x.doc_id for x in quality.filter_documents(docs).collect()}
    assert kept == {i for i, t, _ in rows if "#" not in t}


def test_near_with_a_class_without_ids_and_long_texts(spark):
    base = said(25_000, 9)
    rows = [(1, base), (2, base + " tail"), (None, said(60, 8)), (None, said(60, 8) + " more"), (5, said(60, 8) + " other")]
    got = near_dedup.near_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.component_id) for r in got} == {(1, 1), (2, 1), (None, 5), (5, 5)}


def test_passages_with_repeated_and_null_ids(spark):
    passage = said(40, 3)
    rows = [(2, passage), (2, "x " + passage), (1, "y"), (None, passage), (3, passage + " z"), (4, None)]
    got = sorted((r.doc_id or 0, r.n_removed > 0) for r in substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(0, False), (1, False), (2, False), (2, False), (3, True), (4, False)]


def test_long_runs_of_personal_data(spark):
    texts = ["a" * 1_000_000, "x@" + "l." * 100_000 + "1", "x@" + "ab." * 100_000 + "com", "a@" * 100_000, "1" * 1_000_000, "mail a@b.com_x@d.org now", "a@b..com a@b.com... a@b.com1"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in pii.pseudonymise(frame, "k").collect()}
    assert all(got[i].text == texts[i] for i in (0, 1, 3, 4)) and got[2].n_email == 1 and got[5].n_email == 2 and got[6].n_email == 2
    assert got[6].text.startswith("a@b..com ") and ".example... " in got[6].text and got[6].text.endswith(".example1")
    rows = pii.pseudonymise(clashing(spark, [(1, "a@b.com", "s")] * 2), "k").collect()
    assert len(rows) == 2 and rows[0] == rows[1]


def test_chat_with_clashes_repeats_and_long_texts(spark):
    rows = [(1, 0, "user", "q", "x"), (1, 1, "assistant", "a" * 200_000, "x"), (1, 1, "assistant", "a" * 200_000, "x")]
    got = chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")).collect()[0]
    assert [len(t) for _, t in chat.parse(got.formatted)] == [1, 200_000, 200_000]
    _, pieces, _ = chat.tokenizer()
    assert chat.unescape_runs([pieces[i] if m else b"\0\0" for i, m in zip(got.ids, got.loss, strict=True)]) == ["a" * 200_000] * 2


def test_pipeline_on_odd_tables(spark, tmp_path):
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    good = said(40, 1)
    for name, rows in {"empty": [], "odd": [(1, good, "en", "a", 1), (1, good, "en", "a", 1), (None, said(40, 2), None, None, None), (None, None, None, None, None), (2, "", "en", "a", 0), (3, "short", "en", "a", 1)]}.items():
        spark.createDataFrame(rows, kinds).write.parquet(f"{tmp_path}/{name}/documents.parquet")
        got = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert "ids" in got.columns and {r.doc_id for r in got.collect()} == ({1, None} if rows else set())


def test_encoding_keeps_columns_of_any_name(spark):
    """Also those that are called like the operator's own; text goes, ids are made."""
    from presslens.llm.bpe import encode_documents

    rows = spark.createDataFrame([(1, "a cat sat", 5, "r", "w", "x", 9), (2, None, 6, "s", None, "y", 8)], "doc_id long, text string, ids int, _rare string, _Which string, _folded string, _runs int")
    got = sorted(encode_documents(rows).collect(), key=lambda r: r.doc_id)
    assert got[0].__fields__ == ["doc_id", "_rare", "_Which", "_folded", "_runs", "ids"]
    assert [tuple(r)[:5] for r in got] == [(1, "r", "w", "x", 9), (2, "s", None, "y", 8)] and len(got[0].ids) >= 3 and got[1].ids == []
