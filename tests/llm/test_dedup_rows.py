"""Deduplication decides by row: one doc_id, or none, may have several texts."""

from presslens.llm import exact_dedup, near_dedup

SCHEMA = "doc_id long, text string, lang string"


def left(frame):
    return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)


def test_exact_with_shared_and_null_ids(spark):
    rows = [(1, "a copy", "x"), (2, "a copy", "x"), (2, "own of two", "x"), (2, "kept  of two", "x"), (3, "kept of two", "x"), (None, "a copy", "x"), (None, "own of none", "x"), (None, "own of none", "y"), (None, "second of none", "x"), (4, None, "x"), (4, "", "x"), (5, "a b ", "x"), (5, "a  b", "x"), (5, "ab", "x")]
    got = left(exact_dedup.dedup_documents(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    got = [(i, t or "") for i, t in got]
    want = [(1, "a copy"), (2, "own of two"), (2, "kept  of two"), (None, "own of none"), (None, "second of none"), (4, ""), (5, "a  b")]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_near_with_shared_and_null_ids(spark):
    said = lambda w: " ".join(f"{w}{i}" for i in range(60))
    rows = [(1, said("a"), "x"), (2, said("a") + " more", "x"), (2, said("b"), "x"), (None, said("a") + " other", "x"), (None, said("c"), "x"), (None, said("d"), "x"), (None, said("d") + " more", "x"), (3, said("e"), "x"), (None, None, "x"), (None, "", "x")]
    got = left(near_dedup.dedup_near(spark.createDataFrame(rows, SCHEMA).repartition(3)))
    d = [r for r in got if r[1] and r[1].startswith("d0 ")]
    assert len(d) == 1
    assert [r for r in got if r not in d] == sorted([(1, said("a")), (2, said("b")), (None, said("c")), (3, said("e")), (None, None), (None, "")], key=repr)
