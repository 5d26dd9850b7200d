"""The driver's table of frequent words is filled in place."""

from __future__ import annotations

import tracemalloc

import pyarrow as pa

from presslens.llm import bpe


def table_of(words: list[str], ids: list[list[int]]) -> pa.Table:
    return pa.table([pa.array(words, pa.string()), pa.array(ids, pa.list_(pa.int32()))], names=["word", "ids"])


def test_words_of_many_chunks_are_found():
    words, ids = ["a", "", "é", "word", "longer word"], [[1], [], [7, 8], [9], [2, 3, 4]]
    whole = table_of(words, ids)
    for table in (whole, whole.slice(1, 3), pa.concat_tables([whole.slice(3, 2), whole.slice(0, 0), whole.slice(0, 3)]), whole.slice(0, 0)):
        head = bpe.HeadTable(memoryview(bpe.pack_head(table)))
        held = table.to_pylist()
        for i, n in enumerate(head.find(pa.array([w.encode() for w in [*words, "none"]], pa.binary())).tolist()):
            mine = [r["ids"] for r in held if i < len(words) and r["word"] == words[i]]
            assert (n < 0) == (not mine)
            if mine:
                assert head.ids[head.id_ends[n] // 4 : head.id_ends[n + 1] // 4].tolist() == mine[0]


def test_the_block_is_most_of_the_memory():
    n = 200_000
    table = table_of([f"word number {i}" for i in range(n)], [[i, i + 1, i + 2] for i in range(n)])
    bpe.pack_head(table.slice(0, 10))
    tracemalloc.start()
    block = bpe.pack_head(table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * len(block)
