"""Merge rules: one-pass fold equals sequential upserts; insert-or-ignore."""

import random

from pyspark.sql import functions as F

from tripmetrics.operators import merge as MG

RULES = {"cnt": "+", "rev": "+", "avg": "half", "top": "max", "first": "old", "last": "new"}
COLS = "batch_id int, k string, cnt bigint, rev double, avg double, top double, first string, last string"


def batches(n_batches=4, seed=7):
    rnd = random.Random(seed)
    rows = []
    for b in range(n_batches):
        for k in "abcdefg":
            if rnd.random() < 0.7:
                rows.append((b, k, rnd.randint(1, 9), round(rnd.uniform(0, 50), 2), round(rnd.uniform(0, 30), 4),
                             round(rnd.uniform(0, 100), 2), f"f{b}", f"l{b}"))
    return rows


def test_fold_equals_sequential_merge(spark):
    rows = batches()
    df = spark.createDataFrame(rows, COLS)
    once = {r["k"]: r for r in MG.fold(df, ["k"], RULES).collect()}
    state = None
    for b in range(4):
        nb = df.filter(F.col("batch_id") == b).drop("batch_id")
        state = nb if state is None else MG.merge_upsert(state, nb, ["k"], RULES)
        state = spark.createDataFrame(state.collect(), state.schema)  # materialise each step
    seq = {r["k"]: r for r in state.collect()}
    assert once.keys() == seq.keys()
    for k in once:
        for c in RULES:
            a, b = once[k][c], seq[k][c]
            if c == "avg":
                assert round(b, 6) == a, (k, c, a, b)
            else:
                assert a == b, (k, c, a, b)


def test_half_rule_weights(spark):
    df = spark.createDataFrame([(0, "k", 8.0), (1, "k", 4.0), (2, "k", 2.0)], "batch_id int, k string, v double")
    got = MG.fold(df, ["k"], {"v": "half"}).first()["v"]
    assert got == ((8.0 + 4.0) / 2 + 2.0) / 2


def test_max_rule_null_if_any_null(spark):
    df = spark.createDataFrame([(0, "k", 1.0), (1, "k", None), (0, "j", 3.0), (1, "j", 2.0)],
                               "batch_id int, k string, v double")
    got = {r["k"]: r["v"] for r in MG.fold(df, ["k"], {"v": "max"}).collect()}
    assert got == {"k": None, "j": 3.0}


def test_insert_or_ignore(spark):
    batch = spark.createDataFrame(
        [("a", 1, "x", 2), ("a", 0, "y", 1), ("b", 0, None, 0), ("b", 1, "z", 0), ("c", 0, "w", 0)],
        "id string, batch_id int, v string, other int")
    target = spark.createDataFrame([("c",)], "id string")
    got = {r["id"]: r["v"] for r in MG.insert_or_ignore(batch, "id", ["v"], ["batch_id", "v"], target).collect()}
    assert got == {"a": "y", "b": "z"}   # first in batch order; NOT NULL breaker skipped; existing key ignored


def test_weekly_after_six_loads_equals_a_rollup_behind_each(spark):
    """Six loads, one without days in the window: totals are the last
    roll-up's, the other columns those of the city's first roll-up."""
    from tripmetrics.operators import marts as M
    from tripmetrics.settings import Params

    p = Params()
    day, old = p.as_of_date, "2024-01-05"
    days = [(0, "A", old, 50, 9.0), (1, "A", day, 3, 1.5), (2, "A", day, 4, 2.0), (2, "B", day, 7, 1.0),
            (4, "A", M.week_start(p), 9, 3.0), (5, "B", day, 2, 4.0), (5, "A", old, 70, 1.0)]
    hours = [(b, c, d, 8 + b, n) for b, c, d, n, _ in days]
    daily = spark.createDataFrame(days, "batch_id int, city string, date string, total_trips bigint, total_revenue double")
    hourly = spark.createDataFrame(hours, "batch_id int, city string, date string, hour int, trip_count bigint")
    got = {r["city"]: r for r in M.weekly_after_loads(daily, hourly, p).collect()}
    state = None
    for run in range(6):
        d = daily.filter(F.col("batch_id") <= run).groupBy("city", "date").agg(
            F.sum("total_trips").alias("total_trips"), F.sum("total_revenue").alias("total_revenue"))
        h = hourly.filter(F.col("batch_id") <= run).groupBy("city", "date", "hour").agg(F.sum("trip_count").alias("trip_count"))
        week = M.weekly_trends(d, h, p)
        state = week if state is None else MG.merge_upsert(state, week, MG.WEEKLY_KEYS, MG.WEEKLY_RULES)
        state = spark.createDataFrame(state.collect(), state.schema)
    want = {r["city"]: r for r in state.collect()}
    assert set(got) == {"A", "B"} and got["A"]["total_trips"] == 16 and got["A"]["avg_daily_trips"] == 3
    assert {c: r.asDict() for c, r in got.items()} == {c: r.asDict() for c, r in want.items()}


def test_first_per_key_moves_the_key_once(spark):
    rows = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 3, "z"), (None, 1, "w")], "id string, n int, t string")
    got = MG.first_per_key(rows, "id", ["n", "id", "t"])
    assert sorted(tuple(r) for r in got.collect() if r.id) == [("a", 1, "y"), ("b", 3, "z")] and got.columns == rows.columns
    assert [r.t for r in got.where("id is null").collect()] == ["w"]
    (least,) = [line for line in got._jdf.queryExecution().analyzed().toString().split("\n") if "min(struct" in line]
    assert "struct(n" in least and "id, id#" not in least


def test_shuffles_are_read_in_small_parts(spark):
    from tripmetrics.session import tune
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    other = spark.newSession()
    tune(other)
    assert other.conf.get(key) == "24MB"
    other.conf.set(key, "48MB")                         # the caller's own is kept
    tune(other)
    assert other.conf.get(key) == "48MB"
