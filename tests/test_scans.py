"""Running values by blocks: long histories against plain loops, and the plans' windows."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from barwright.operators import bars, indicators, scans


def partition_keys_of_windows(df):
    """The partition keys of all windows in a plan, each as the set of their names."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [{k.split("#")[0] for k in keys.split(", ")} for keys in re.findall(r"Window \[.*?\], \[([^\[\]]*)\], \[", plan)]


def minute_bars(spark, n, symbols=("A", "B")):
    rng = random.Random(3)
    start = dt.datetime(1969, 12, 20)  # blocks before 1970, too
    rows = [(s, start + dt.timedelta(minutes=7 * i), 100 + rng.random() + i / 1000) for s in symbols for i in range(n)]
    return rows, spark.createDataFrame(rows, "symbol string, bar_time timestamp, close double").repartition(5)


def by_hand(values, window, alpha):
    out, v = [None] * len(values), None
    for i, x in enumerate(values):
        v = sum(values[:window]) / window if i == window - 1 else v if v is None else alpha * x + (1 - alpha) * v
        out[i] = v
    return out


@pytest.mark.parametrize("window", [1, 2, 10, 300])
def test_averages_of_long_histories_are_spread(spark, window):
    """Minute bars in many blocks of time and rows, fast and slow decay; no window holds all rows of a symbol."""
    rows, df = minute_bars(spark, 9000)
    got = indicators.ema(df, window, time="bar_time")
    for plan in (got, scans.numbered(df, ["symbol"], "bar_time", ["close"])):
        assert (partition_keys_of_windows(plan) or window == 1) and {"symbol"} not in partition_keys_of_windows(plan)
    for s in "AB":
        want = by_hand([c for k, _, c in rows if k == s], window, 2 / (window + 1))
        found = [r["ema"] for r in got.where(F.col("symbol") == s).orderBy("bar_time").collect()]
        assert len(found) == 9000 and all((a is None) == (b is None) and (a is None or abs(a - b) < 1e-9 * abs(b)) for a, b in zip(found, want, strict=True))


def test_relative_strength_and_macd_of_minute_bars(spark):
    rows, df = minute_bars(spark, 3000, "A")
    c = [r[2] for r in rows]
    steps = [b - a for a, b in zip(c, c[1:], strict=False)]
    up, down = (by_hand([max(s * x, 0) for x in steps], 14, 1 / 14) for s in (1, -1))
    got = [r["rsi"] for r in indicators.rsi(df, time="bar_time").orderBy("bar_time").collect()]
    assert got[:14] == [None] * 14 and all(abs(g - (100 - 100 / (1 + u / w))) < 1e-8 for g, u, w in zip(got[14:], up[13:], down[13:], strict=True))
    value = [None if b is None else a - b for a, b in zip(by_hand(c, 12, 2 / 13), by_hand(c, 26, 2 / 27), strict=True)]
    signal = by_hand(value[25:], 9, 0.2)
    got = indicators.macd(df, time="bar_time").orderBy("bar_time").collect()
    assert [r["macd"] for r in got[:25]] == [None] * 25 and all(abs(r["macd"] - v) < 1e-9 for r, v in zip(got[25:], value[25:], strict=True))
    assert all((r["signal"] is None) == (v is None) and (v is None or abs(r["signal"] - v) < 1e-9) for r, v in zip(got[25:], signal, strict=True))


def test_as_of_lookups_by_blocks(spark):
    """Bars and requests far apart, in empty blocks, on one day, before any bar; null closes stay; no window by symbol alone."""
    rng, d0 = random.Random(5), dt.date(1960, 1, 1)
    days = sorted(rng.sample(range(9000), 500)) + [30000]
    held = [("A", d0 + dt.timedelta(days=i), None if i % 7 == 0 else float(i)) for i in days]
    asks = [("A", d0 + dt.timedelta(days=rng.randrange(31000))) for _ in range(300)] + [("A", held[5][1]), ("A", d0 - dt.timedelta(days=1)), ("B", d0)]
    table, asked = spark.createDataFrame(held, "symbol string, bar_date date, close double"), spark.createDataFrame(asks, "symbol string, as_of date").distinct()
    got = bars.asof_bars(table, asked)
    want = set()
    for s, day in set(asks):
        before = [i for i, b in enumerate(held) if s == "A" and b[1] <= day]
        if before:
            want.add((s, day, *held[before[-1]][1:], held[before[-1] - 1][2] if before[-1] else None))
    assert {tuple(r) for r in got.collect()} == want
    splits = spark.createDataFrame([("A", d0 + dt.timedelta(days=i), "split", 2.0, 1.0) for i in (100, 4000, 29000)], "symbol string, ex_date date, action_type string, ratio_from double, ratio_to double")
    adjusted = bars.split_adjusted(table, splits)
    factors = {r["bar_date"]: r["factor"] for r in adjusted.collect()}
    assert all(factors[b[1]] == 2.0 ** sum(b[1] < d0 + dt.timedelta(days=i) for i in (100, 4000, 29000)) for b in held) and len(factors) == len(held)
    for df in (got, adjusted):
        assert partition_keys_of_windows(df) and {"symbol"} not in partition_keys_of_windows(df)
    assert "WindowGroupLimit" in bars.fallback_price(table)._jdf.queryExecution().optimizedPlan().toString()
