"""The day store's commits and the state of seen links, when things go wrong between two steps."""

import pytest
from pyspark.sql import functions as F

from presslens.sources.store import NO_DAY, Conflict, DayStore
from presslens.streaming import ingest
from presslens.streaming.seen import SeenState

SCHEMA = "id long, lien string, day date"


def rows(spark, *found):
    return spark.createDataFrame(list(found), "id long, lien string, d string").selectExpr("id", "lien", "cast(d AS date) AS day")


def ids(store, **kwargs):
    return sorted(r.id for r in store.read(**kwargs).collect())


def test_a_write_that_dies_leaves_the_old_archive(spark, tmp_path):
    store = DayStore(spark, f"{tmp_path}/a", SCHEMA)
    old = rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", None))
    assert store.replace_with(old, [F.col("id")]) == {"2024-01-01": False, "2024-01-02": False, NO_DAY: False}
    # The first day is written, then the second one's rows fail.
    broken = rows(spark, (9, "a", "2024-01-01"), (8, "b", "2024-01-02")).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        store.replace_with(broken, [F.col("id")])
    assert ids(store) == [1, 2, 3]
    # Both days are written, and the writer dies before the manifest.
    store.stage(rows(spark, (9, "a", "2024-01-01"), (8, "b", "2024-01-02")), [F.col("id")])
    assert ids(store) == [1, 2, 3] and ids(store, start="2024-01-02") == [2]
    assert store.vacuum() >= 2 and ids(store) == [1, 2, 3]


def test_only_days_that_differ_are_taken_over(spark, tmp_path):
    store = DayStore(spark, f"{tmp_path}/a", SCHEMA)
    store.replace_with(rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", "2024-01-03")), [F.col("id")])
    store.publish(lambda day, held: held.collect())
    before = store.state()
    assert store.replace_with(rows(spark, (1, "a", "2024-01-01"), (4, "b", "2024-01-02")), [F.col("id")]) == {"2024-01-02": False, "2024-01-03": True}
    now = store.state()
    assert now.days["2024-01-01"] == before.days["2024-01-01"] and ids(store) == [1, 4] and ids(store, state=before) == [1, 2, 3]
    assert sorted(now.pending) == ["2024-01-02", "2024-01-03"] and store.pending().count() == 2
    assert store.replace_with(rows(spark, (1, "a", "2024-01-01"), (4, "b", "2024-01-02")), [F.col("id")]) == {} and store.state().number == now.number


def test_two_writers_cannot_both_commit(spark, tmp_path):
    store = DayStore(spark, f"{tmp_path}/a", SCHEMA)
    seen = store.state()
    store.commit(seen)
    with pytest.raises(Conflict):
        store.commit(seen)


def test_catalog_table_prunes_days(spark, tmp_path):
    store = DayStore(spark, f"{tmp_path}/a", SCHEMA)
    store.replace_with(rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-02"), (3, "c", None)), [F.col("id")])
    store.register("held_days")
    df = spark.sql("SELECT id FROM held_days WHERE day = date'2024-01-02'")
    assert [r.id for r in df.collect()] == [2] and len(df.inputFiles()) == 1
    assert spark.table("held_days").count() == 3
    spark.sql("DROP TABLE held_days")


def test_twenty_batches_read_few_files_and_no_link_twice(spark, tmp_path):
    state, store = SeenState(spark, f"{tmp_path}/seen", digits=1, most=4), DayStore(spark, f"{tmp_path}/a", SCHEMA)
    batch = ingest.day_batch(store, state, "lien", ["id"], lambda r: r.drop("hash"))
    read = []
    for number in range(20):
        fresh = rows(spark, *[(number * 10 + i, f"l{(number * 7 + i) % 60}", f"2024-01-{number % 5 + 1:02d}") for i in range(10)])
        batch(fresh, number)
        if number % 6 == 5:
            batch(fresh, number)  # again, as after a crash
        read.append(len(state.known([f"{b:x}" for b in range(16)], number + 1).inputFiles()))
    links = [r.lien for r in store.read().collect()]
    assert len(links) == len(set(links)) == 60
    assert max(read) <= 16 * 4 and read[-1] <= max(read[:8])
    assert store.state().done == {"articles": 19}


def test_a_batch_that_died_before_its_state_is_done_again(spark, tmp_path):
    state, store = SeenState(spark, f"{tmp_path}/seen"), DayStore(spark, f"{tmp_path}/a", SCHEMA)
    fresh = rows(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-01"))
    store.add(fresh, [F.col("id")], "articles", 0)  # the archive has it, the state does not
    ingest.day_batch(store, state, "lien", ["id"], lambda r: r.drop("hash"))(fresh, 0)
    ingest.day_batch(store, state, "lien", ["id"], lambda r: r.drop("hash"))(rows(spark, (3, "a", "2024-01-02"), (4, "c", None)), 1)
    assert ids(store) == [1, 2, 4] and state.known(["86", "e9", "84"], 2).count() == 3
