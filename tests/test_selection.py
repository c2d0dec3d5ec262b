"""Exact ranks of groups, one of which holds most rows."""

import random
import statistics

from pyspark.sql import functions as F

from barwright.operators import selection


def test_medians_and_ranks_of_skewed_groups(spark):
    rng = random.Random(8)
    groups = {"hot": [rng.choice([1e-9, 5.0, rng.gauss(0, 1), rng.gauss(100, 1e-6), -1e300]) for _ in range(8000)], "one": [2.5], "two": [1.0, 4.0], "same": [7.0] * 90, "tie": [1.0, 2.0, 2.0, 3.0], "wide": [-1.7e308, 1.7e308, 0.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("two", None), ("empty", None), (None, 1.0)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    got = {r["k"]: r["m"] for r in selection.medians(df, ["k"], "v", "m").collect()}
    assert got == {g: statistics.median(vs) for g, vs in groups.items()}
    ranks = {"p90": lambda n: F.bround((n - 1) * F.lit(0.9)), "least": lambda n: F.lit(0), "greatest": lambda n: n - 1}
    for r in selection.at_ranks(df, ["k"], "v", ranks).collect():
        vs = sorted(groups[r["k"]])
        assert (r["n"], r["p90"], r["least"], r["greatest"]) == (len(vs), vs[round((len(vs) - 1) * 0.9)], vs[0], vs[-1])


def test_whole_numbers(spark):
    df = spark.createDataFrame([(i % 3, i * i % 17) for i in range(100)], "k int, v long")
    want = {k: statistics.median([i * i % 17 for i in range(100) if i % 3 == k]) for k in range(3)}
    assert {r["k"]: r["m"] for r in selection.medians(df, ["k"], "v", "m").collect()} == want


def test_no_group_is_collected(spark):
    df = spark.createDataFrame([("a", 1.0)], "k string, v double")
    plan = selection.medians(df, ["k"], "v", "m")._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "percentile" not in plan.lower() and "median" not in plan
