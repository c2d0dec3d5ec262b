"""Gaps of sessions as bits, against plain sets."""

import datetime as dt
import random

import pytest

from barwright.operators import coverage


@pytest.mark.parametrize("n_days", [0, 1, 63, 64, 65, 300])
def test_missing_sessions_by_sets(spark, n_days):
    rng, d0 = random.Random(n_days), dt.date(2023, 1, 2)
    days = [d0 + dt.timedelta(days=2 * i) for i in range(n_days)]
    held = {s: {d for d in days if rng.random() < share} for s, share in (("A", 0.5), ("B", 1.0), ("C", 0.0), ("D", 0.97))}
    have = [(s, d) for s, ds in held.items() for d in ds] * 2 + [("A", d0 + dt.timedelta(days=1)), ("X", d0)]
    rng.shuffle(have)
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    symbols, calendar, bars = frame([(s,) for s in "ABCDA"], "symbol string"), frame([(d,) for d in reversed(days)], "day date"), frame(have, "symbol string, day date")
    got = {r["symbol"]: r for r in coverage.day_gaps(symbols, calendar, bars.withColumnRenamed("day", "bar_date"), limit=40).collect()}
    assert sorted(got) == list("ABCD")
    for s, r in got.items():
        lacking = [d for d in days if d not in held[s]]
        assert (r["expected_days"], r["covered_days"], r["missing_days"], r["missing_dates"]) == (n_days, n_days - len(lacking), len(lacking), lacking[:40])
    pairs = sorted((d, s) for s in "ABCD" for d in days if d not in held[s])[:50]
    assert [(r["day"], r["symbol"]) for r in coverage.gap_sample(symbols, calendar, bars).collect()] == pairs


def test_no_row_for_each_symbol_and_day(spark):
    """The only rows that multiply are those of the day list itself."""
    days = spark.range(400).selectExpr("date_add(date '2023-01-01', cast(id as int)) as day")
    bars = spark.createDataFrame([("A", dt.date(2023, 1, 1))], "symbol string, bar_date date")
    plan = coverage.stock_daily_check(bars, bars.select("symbol"), days, 1)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 1 and "bit_or" in plan
