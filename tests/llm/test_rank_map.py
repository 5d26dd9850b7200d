"""The rank map is a constant of the plan that no plan prints and no row holds."""

from __future__ import annotations

import os
import re

import pytest

from presslens.llm import bpe, common


@pytest.mark.parametrize("digests", [False, True])
def test_the_rank_map_is_not_printed_and_the_words_go(spark, tmp_path, monkeypatch, digests):
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    texts = ["the ship and the port", "the port and a xylophone's quixotry", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    made = (bpe.encode_digests if digests else bpe.encode_documents)(docs)
    plan = made._jdf.queryExecution().toString()
    assert len(plan) < 100_000  # four forms of the plan; the literal alone had some 470,000 characters in each
    optimized = made._jdf.queryExecution().optimizedPlan().toString()
    assert "array(scalar-subquery#" in optimized and not re.search(r"scalar-subquery#\S* \[\] AS _buckets", optimized)
    rows = made.orderBy("doc_id").collect()
    assert [len(texts[0].split()), 0] == [rows[0][1] if digests else len(rows[0].ids), rows[2][1] if digests else len(rows[2].ids)]
    assert not [f for _, _, files in os.walk(tmp_path) for f in files]


def test_columns_of_any_name_pass(spark):
    rows = spark.createDataFrame([(1, "the ship", 2, 3)], "doc_id long, text string, _buckets long, _folded long")
    got = bpe.encode_documents(rows).first()
    assert (got.doc_id, got["_buckets"], got["_folded"], len(got.ids)) == (1, 2, 3, 2)
