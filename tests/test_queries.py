"""Every registered query with SQL against the oracle, and the others against brute force."""

import pytest

from barwright import plans
from tests.oracle import compare


@pytest.mark.parametrize("name", sorted(plans.ORACLE_SQL))
def test_oracle(spark, sf, name):
    compare(spark, sf, plans.QUERIES[name], plans.ORACLE_SQL[name])


def closes(spark, sf, symbol):
    from barwright.plans.fixtures import Market

    rows = Market(spark, sf).stock_daily.where(f"symbol = '{symbol}'").select("bar_date", "close").orderBy("bar_date").collect()
    return [r[0] for r in rows], [r[1] for r in rows]


def by_hand_ema(values, n, alpha):
    out, v = [None] * len(values), None
    for i, x in enumerate(values):
        if i == n - 1:
            v = sum(values[:n]) / n
        elif i >= n:
            v = alpha * x + (1 - alpha) * v
        out[i] = v
    return out


def test_ema(spark, sf):
    days, c = closes(spark, sf, "UA")
    got = {r["bar_date"]: r["ema"] for r in plans.QUERIES["l2_ema"](spark, sf).where("symbol = 'UA'").collect()}
    for d, want in zip(days, by_hand_ema(c, 10, 2 / 11), strict=True):
        assert (got[d] is None) == (want is None) and (want is None or abs(got[d] - want) < 1e-5)


def test_rsi(spark, sf):
    days, c = closes(spark, sf, "UB")
    steps = [b - a for a, b in zip(c, c[1:], strict=False)]
    up, down = (by_hand_ema([max(s * x, 0) for x in steps], 14, 1 / 14) for s in (1, -1))
    got = {r["bar_date"]: r["rsi"] for r in plans.QUERIES["l3_rsi"](spark, sf).where("symbol = 'UB'").collect()}
    for d, u, w in zip(days[1:], up, down, strict=True):
        want = None if u is None else 100.0 if w == 0 else 100 - 100 / (1 + u / w)
        assert (got[d] is None) == (want is None) and (want is None or abs(got[d] - want) < 1e-4)


def test_macd(spark, sf):
    days, c = closes(spark, sf, "UC")
    short, long = by_hand_ema(c, 12, 2 / 13), by_hand_ema(c, 26, 2 / 27)
    value = [None if b is None else a - b for a, b in zip(short, long, strict=True)]
    signal = by_hand_ema([v for v in value if v is not None], 9, 0.2)
    signal = [None] * (len(value) - len(signal)) + signal
    got = {r["bar_date"]: r for r in plans.QUERIES["l4_macd"](spark, sf).where("symbol = 'UC'").collect()}
    for d, v, s in zip(days, value, signal, strict=True):
        assert (got[d]["macd"] is None) == (v is None) and (v is None or abs(got[d]["macd"] - v) < 1e-6)
        assert (got[d]["signal"] is None) == (s is None) and (s is None or abs(got[d]["signal"] - s) < 1e-6)
