"""A batch of long texts is searched without all of them as Python strings at once."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa

from presslens.operators import matching


def test_a_batch_is_not_made_into_strings_at_once(spark):
    texts = pa.array(["heat and ties " * 1000] * 1000 + [None, "", "x heat"])
    search = matching._places(("heat", "ties", "cold")).func
    search(texts[:2])
    tracemalloc.start()
    found = search(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 << 20  # of 14 MB
    assert found[0].as_py() == [{"n": 0, "pos": 1}, {"n": 1, "pos": 10}]
    assert [x.as_py() for x in found[1000:]] == [[], [], [{"n": 0, "pos": 3}]]
