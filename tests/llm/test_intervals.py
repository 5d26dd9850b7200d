"""The interval join against a brute-force version: sessions of all lengths, spans over years, open ends, broken rows."""

import datetime
import random
import zlib
from collections import defaultdict

from presslens.llm import intervals

CLICKS, SALES, LINES = "client_id long, ts timestamp_ntz, kind string", "sale_id long, client_id long, sold_at timestamp_ntz", "sale_id long, shipped_at timestamp_ntz"
BEGIN = datetime.datetime(1970, 1, 1)
HOUR = 3600 * 10**6


def micros(t):
    return (t - BEGIN) // datetime.timedelta(microseconds=1)


def brute(clicks, sales, lines):
    times = defaultdict(list)
    for client, ts, kind in clicks:
        if client is not None and ts is not None:
            times[client].append((micros(ts), kind == "purchase"))
    sessions = defaultdict(list)
    for client, ts in times.items():
        runs = []
        for t, bought in sorted(ts):
            if runs and t - runs[-1][-1][0] <= 600 * 10**6:
                runs[-1].append((t, bought))
            else:
                runs.append([(t, bought)])
        for run in runs:
            last = run[-1][0]
            sessions[client].append((run[0][0], None if any(b for t, b in run if t == last) else last // HOUR))
    out = defaultdict(lambda: [0, None, 0])
    for sale, client, sold in sales:
        if client is None or sold is None:
            continue
        mine = [s for i, s in lines if i == sale and i is not None]
        low = micros(sold) // HOUR
        high = None if None in mine else max([low, *[micros(s) // HOUR for s in mine]])
        for first, b in sessions[client]:
            a, far = first // HOUR, float("inf")
            e, f = far if high is None else high, far if b is None else b
            if a > e or f < low:
                continue
            of_end = (e > f) - (e < f) + 1
            side = 0 if low < a else 1 if low == a else 2
            name = (("overlaps", "finished_by", "contains"), ("starts", "equals", "started_by"), ("during", "finishes", "overlapped_by"))[side][of_end]
            got = out[sale, name]
            got[0] += 1
            if min(e, f) < far:
                got[1] = (got[1] or 0) + min(e, f) - max(low, a) + 1
            got[2] += zlib.crc32(str(first).encode())
    return sorted(((*k, *v) for k, v in out.items()), key=repr)


def run(spark, clicks, sales, lines):
    df = intervals.overlapping_sessions(spark.createDataFrame(sales, SALES), spark.createDataFrame(lines, LINES), spark.createDataFrame(clicks, CLICKS))
    return sorted((tuple(r) for r in df.select("sale_id", "relation", "n_pairs", "overlap_slots", "sessions_crc").collect()), key=repr)


def at(hours):
    return BEGIN + datetime.timedelta(hours=hours)


def test_sessions_of_all_lengths(spark):
    """Sessions of up to 300 hours, spans of up to two years or without end, before and after 1970."""
    rng = random.Random(3)
    clicks, sales, lines, begins = [], [], [], []
    for client in range(4):
        for _ in range(40):
            begin, length = rng.uniform(-9000, 9000), rng.choice([0, 0.1, 1, 3, 10, 40, 90, 300])
            begins.append((client, begin))
            steps = [begin + k * 0.1 for k in range(int(length * 10) + 1)]
            clicks += [(client, at(t), rng.choice(["view", "purchase", None])) for t in steps]
    for sale in range(120):
        client, sold = rng.choice([*begins, *[(rng.randrange(5), rng.uniform(-9500, 9500))] * 160])
        sales.append((sale, client, at(sold)))
        lines += [(sale, None if rng.random() < 0.2 else at(sold + rng.choice([-5, 0, 0.5, 7, 70, 500, 17000]) * rng.random())) for _ in range(rng.randrange(3))]
    assert run(spark, clicks, sales, lines) == brute(clicks, sales, lines)
    assert len({r[1] for r in brute(clicks, sales, lines)}) >= 7


def test_nulls_ties_and_repeats(spark):
    clicks = [(1, at(5), "view"), (1, at(5), "purchase"), (1, at(5), "purchase"), (1, at(5) + datetime.timedelta(minutes=10), "view"), (1, at(5) + datetime.timedelta(minutes=20, microseconds=1), "view"), (None, at(5), "view"), (1, None, "view"), (2, at(-1), "purchase"), (2, at(30), None)]
    sales = [(1, 1, at(5)), (1, 1, at(5)), (2, None, at(5)), (3, 1, None), (None, 1, at(4)), (4, 2, at(-1)), (5, 2, at(-3)), (6, 2, at(30)), (7, 2, at(31)), (8, 9, at(1))]
    lines = [(1, at(4)), (None, None), (4, None), (5, at(-1)), (5, at(-2)), (6, at(30)), (6, at(30)), (7, at(2)), (99, at(3))]
    assert run(spark, clicks, sales, lines) == brute(clicks, sales, lines)


def test_clashing_columns_and_empty_tables(spark):
    clicks, sales, lines = [(1, at(5), "view")], [(1, 1, at(5))], [(1, at(6))]
    plain = run(spark, clicks, sales, lines)
    extra = [spark.createDataFrame(rows, ddl).selectExpr("*", "1 AS key", "2 AS low", "3 AS g", "4 AS n", "5 AS at", "6 AS id") for rows, ddl in ((sales, SALES), (lines, LINES), (clicks, CLICKS))]
    assert [tuple(r) for r in intervals.overlapping_sessions(*extra).collect()] == plain == [(1, "started_by", 1, 1, zlib.crc32(str(micros(at(5))).encode()))]
    assert run(spark, [], sales, lines) == run(spark, clicks, [], lines) == []
    assert run(spark, clicks, sales, []) == [(1, "equals", 1, 1, zlib.crc32(str(micros(at(5))).encode()))]
