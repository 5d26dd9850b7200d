"""Queries that do the whole of their tables, in more tasks than one."""

from __future__ import annotations

import glob
import os

import pyarrow.parquet as pq
import pytest

from presslens.plans import archiving, registry, streaming

DIR = "/root/testdata/sf0.001"


def test_site_number_reads_every_client_and_customer(spark):
    got = registry.QUERIES["site_number"](spark, DIR)
    n_clients, n_customers = (pq.read_metadata(f"{DIR}/{t}.parquet").num_rows for t in ("clients", "customer"))
    assert {r["held"]: r["count"] for r in got.groupBy("held").count().collect()} == {"client": n_clients, "customer": n_customers, "account": n_customers}
    words = got.filter("held = 'customer' AND id % 3 = 0")
    assert words.count() > 0 and words.filter("n IS NOT NULL").count() == 0  # a word is no number


@pytest.mark.parametrize("name", ["stream_days", "stream_bounded", "stream_ingest"])
def test_what_goes_into_a_stream_is_written_by_as_many_tasks_as_read_it(spark, tmp_path, monkeypatch, name):
    """The tables in several files: a batch has them all, and no task gathers them."""
    for t in ("documents", "events", "pages"):
        rows = pq.read_table(f"{DIR}/{t}.parquet")
        os.makedirs(f"{tmp_path}/{t}.parquet")
        for i in range(4):
            pq.write_table(rows.take(list(range(i, rows.num_rows, 4))), f"{tmp_path}/{t}.parquet/{i}.parquet")
    made = []
    for module in (streaming, archiving):
        monkeypatch.setattr(module, "scratch", lambda spark, tag: made.append(f"{tmp_path}/{tag}{len(made)}") or made[-1])
    spark.conf.set("spark.sql.files.openCostInBytes", str(64 << 20))
    try:
        got = registry.QUERIES[name](spark, str(tmp_path)).collect()
        want = registry.QUERIES[name](spark, DIR).collect()
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    rows = [pq.read_metadata(f).num_rows for f in glob.glob(f"{made[0]}/in/*.parquet")]
    assert max(rows) < sum(rows) / 3.5  # the largest part had two thirds
