"""What goes to Python at once is bounded in rows, and the session's own setting comes back."""

from __future__ import annotations

import pyarrow as pa
import pytest

from presslens.llm import common, substring_dedup

KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_batches_are_small_inside_only(spark):
    sizes = lambda: {r[0] for r in spark.range(0, 2500, 1, 1).mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"id": [b.num_rows]}) for b in bs), "id long").collect()}
    before = spark.conf.get(KEY)
    with pytest.raises(ValueError), common.batches_of(spark, 1000):
        assert sizes() == {1000, 500}
        raise ValueError
    assert spark.conf.get(KEY) == before and sizes() == {2500}


def test_texts_of_the_suffix_steps_come_in_small_batches(spark, monkeypatch):
    seen, kept = [], substring_dedup.materialise
    monkeypatch.setattr(substring_dedup, "materialise", lambda df, tag: seen.append((tag, int(spark.conf.get(KEY)))) or kept(df, tag))
    docs = spark.createDataFrame([(i, "x%d " % (i % 3) + "same passage " * 9) for i in range(9)], "doc_id long, text string")
    assert sum(r["n_removed"] > 0 for r in substring_dedup.remove_repeats(docs).collect()) == 8
    held = dict(seen)
    assert held["shared"] <= substring_dedup.TEXTS and held["found"] <= substring_dedup.TEXTS
