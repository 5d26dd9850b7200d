"""What the pipeline's mixing stage takes, against the SQL of the plan: whole documents per pass, and a cut one at the end of a target."""

import re
from collections import defaultdict

import duckdb

import corpus_pipeline
from presslens.llm import oracles

DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_mixing_takes_what_the_plan_says(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{DIR}/documents.parquet'")
    want = db.execute(f"SELECT doc_id, size, taken, passes FROM ({oracles.MIXING})").fetchall()
    texts = dict(db.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())
    rows = corpus_pipeline.mixing_stage(spark, spark.read.parquet(f"{DIR}/documents.parquet"), DIR).collect()
    drawn = defaultdict(list)
    for r in rows:
        drawn[r.doc_id].append(r.text)
    cut = 0
    for doc_id, size, taken, passes in want:
        sizes = [len(WORD.findall(t)) for t in drawn[doc_id]]
        assert (len(sizes), sum(sizes)) == (passes, taken)
        assert all(texts[doc_id].startswith(t) for t in drawn[doc_id])
        cut += sum(n < size for n in sizes)
    assert sum(map(len, drawn.values())) == len(rows) and 0 < cut <= 20  # at most one a source
