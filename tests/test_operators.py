"""Literal cases with known results, and randomised cases against plain definitions."""

import datetime as dt
import random
import statistics
import time

from pyspark.sql import functions as F

from barwright.functions import columns as col
from barwright.operators import calendar, options_analytics as oa
from barwright.sources import sinks

DAY, EXP = dt.date(2024, 1, 2), dt.date(2024, 2, 16)
OI = "underlying string, trade_date date, expiry date, strike double, option_right string, open_interest int"


def test_max_pain_literals(spark):
    a = [(90, "C", 10), (100, "C", 5), (110, "C", 1), (90, "P", 1), (100, "P", 5), (110, "P", 10)]
    b = [(50, "C", 100), (55, "C", 80), (60, "C", 20), (50, "P", 20), (55, "P", 80), (60, "P", 100)]
    rows = [("A", DAY, EXP, float(k), r, q) for k, r, q in a] + [("B", DAY, EXP, float(k), r, q) for k, r, q in b] + [("C", DAY, EXP, 100.0, "C", 3), ("D", DAY, EXP, None, "C", 3), ("A", DAY, EXP, 95.5, "X", 99)]
    got = {r["underlying"]: r for r in oa.max_pain_daily(spark.createDataFrame(rows, OI)).collect()}
    assert (got["A"]["max_pain_strike"], got["A"]["total_oi"], got["A"]["total_pain_at_strike"]) == (100.0, 32, 20000.0)
    assert (got["B"]["max_pain_strike"], got["B"]["total_oi"], got["B"]["total_pain_at_strike"]) == (55.0, 400, 100000.0)
    assert (got["C"]["max_pain_strike"], got["C"]["total_pain_at_strike"]) == (100.0, 0.0) and "D" not in got


def test_max_pain_random(spark):
    rng, rows = random.Random(3), []
    for s in range(12):
        rows += [(f"S{s}", DAY, EXP, rng.randrange(20, 60) / 2, rng.choice("CP"), rng.choice([None, *range(9)])) for _ in range(rng.randrange(1, 40))]
    got = {r["underlying"]: r for r in oa.max_pain_daily(spark.createDataFrame(rows, OI)).collect()}
    for name in {r[0] for r in rows}:
        own = [(k, t, q or 0) for u, _, _, k, t, q in rows if u == name]
        pain = {k: sum(q * max(0, k - s) * 100 if t == "C" else q * max(0, s - k) * 100 for s, t, q in own) for k, _, _ in own}
        best = min(pain, key=lambda k: (pain[k], k))
        assert (got[name]["max_pain_strike"], got[name]["total_pain_at_strike"]) == (best, pain[best])


def atm(spark, rows):
    schema = "underlying string, trade_date date, expiry date, option_ticker string, iv double, underlying_price double, strike double, option_right string"
    data = [("U", DAY, EXP, f"T{i:02d}", iv, 100.0 if k > 60 else 50.0, float(k), r) for i, (k, r, iv) in enumerate(rows)]
    return oa.atm_iv_daily(spark.createDataFrame(data, schema)).first()


def test_atm_iv_literals(spark):
    r = atm(spark, [(95, "C", 0.30), (100, "C", 0.25), (105, "C", 0.22), (95, "P", 0.28), (100, "P", 0.27), (105, "P", 0.24)])
    assert (r["atm_strike"], r["call_iv"], r["put_iv"], round(r["atm_iv"], 9)) == (100.0, 0.25, 0.27, 0.26)
    r = atm(spark, [(50, "C", 0.40), (55, "C", 0.35)])
    assert (r["atm_strike"], r["atm_iv"], r["put_iv"]) == (50.0, 0.40, None)
    r = atm(spark, [(100, "C", 0.0), (100, "P", 15.0), (100, "C", 0.20)])
    assert r["atm_iv"] == 0.20


def test_iv_percentile_literals(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(i) for i in range(5)]
    daily = spark.createDataFrame([("S", d, (i + 1) / 10) for i, d in enumerate(days)] + [("F", d, 0.3) for d in days], "symbol string, trade_date date, iv double")
    last = {r["symbol"]: r for r in oa.iv_percentile_daily(daily, 5).where(F.col("trade_date") == F.lit(days[-1])).collect()}
    assert (last["S"]["iv_percentile_1y"], last["S"]["iv_rank_1y"], last["S"]["lookback_days"]) == (100.0, 100.0, 5)
    assert last["F"]["iv_rank_1y"] == 50.0


def test_iv_percentile_random(spark):
    rng = random.Random(5)
    days, d = [], dt.date(2020, 1, 1)
    for _ in range(40):
        d += dt.timedelta(rng.randrange(1, 9))
        days.append((d, rng.randrange(1, 30) / 100))
    daily = spark.createDataFrame([("S", *x) for x in days], "symbol string, trade_date date, iv double")
    got = {r["trade_date"]: r for r in oa.iv_percentile_daily(daily, 10).collect()}
    for i, (day, cur) in enumerate(days):
        h = [v for t, v in days[max(0, i - 9) : i + 1] if t >= day - dt.timedelta(50)]
        assert got[day]["lookback_days"] == len(h)
        assert abs(got[day]["iv_percentile_1y"] - 100 * sum(x <= cur for x in h) / len(h)) < 1e-3


def test_iv_percentile_of_long_histories(spark):
    """Every day against a plain loop, over several blocks, with the default window: daily, with gaps, and a symbol with far days only."""
    rng = random.Random(6)
    daily = {"D": 1, "G": 5, "F": 700, "N": 2}
    rows = []
    for s, most in daily.items():
        d = dt.date(1965, 3, 1)  # days before 1970 are negative
        for _ in range(900 if most < 700 else 12):
            d += dt.timedelta(rng.randint(1, most))
            rows.append((s, d, None if s == "N" and rng.random() < 0.4 else rng.choice([rng.random(), rng.randrange(1, 9) / 10])))
    rows += [("N", None, 0.5)]
    want = {}
    for s in daily:
        held = [(d, v) for x, d, v in rows if x == s and d and v is not None]
        for i, (d, v) in enumerate(held):
            h = [y for t, y in held[max(0, i - 251) : i + 1] if (d - t).days <= 534]
            rank = 50.0 if max(h) == min(h) else round(100 * (v - min(h)) / (max(h) - min(h)), 4)
            want[s, d] = (v, round(100 * sum(y <= v for y in h) / len(h), 4), rank, len(h))
    rng.shuffle(rows)
    got = oa.iv_percentile_daily(spark.createDataFrame(rows, "symbol string, trade_date date, iv double").repartition(5)).collect()
    assert len(got) == len(want)
    for r in got:
        x = want[r["symbol"], r["trade_date"]]
        assert (r["iv_current"], r["lookback_days"]) == (x[0], x[3]) and abs(r["iv_percentile_1y"] - x[1]) < 2e-4 and abs(r["iv_rank_1y"] - x[2]) < 2e-4


def test_iv_percentile_spreads_a_symbol(spark):
    df = spark.createDataFrame([], "symbol string, trade_date date, iv double")
    out = oa.iv_percentile_daily(df)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "_block" in plan and out.count() == 0


def test_pcr_and_rollup_literals(spark):
    r = spark.createDataFrame([(100, 50), (0, 50), (10, 0)], "p int, c int").select(col.safe_ratio(F.col("p"), F.col("c")).alias("r")).collect()
    assert [x["r"] for x in r] == [2.0, 0.0, None]
    atm_rows = [("A", DAY, x) for x in (0.2, 0.3, 0.4)] + [("B", DAY, x) for x in (0.2, 0.4, None)]
    got = {r["symbol"]: r["iv"] for r in oa.iv_rollup(spark.createDataFrame(atm_rows, "symbol string, trade_date date, atm_iv double")).collect()}
    assert abs(got["A"] - statistics.median([0.2, 0.3, 0.4])) < 1e-12 and abs(got["B"] - 0.3) < 1e-12


def test_ticker_literals(spark):
    rows = [("O:AAPL250620C00150000",), ("o:spy241220p00450000",), ("AAPL",), ("O:BAD",), ("O:X251332C00000001",)]
    p = spark.createDataFrame(rows, "t string").select("t", col.parse_option_ticker(F.col("t")).alias("p")).select("t", "p.*").collect()
    got = {r["t"]: tuple(r)[1:] for r in p}
    assert got["O:AAPL250620C00150000"] == ("AAPL", dt.date(2025, 6, 20), 150.0, "C")
    assert got["o:spy241220p00450000"] == ("SPY", dt.date(2024, 12, 20), 450.0, "P")
    assert all(got[t][0] is None for t in ("AAPL", "O:BAD", "O:X251332C00000001"))


def test_number_and_time_literals(spark):
    r = spark.range(1).select(
        col.epoch_ms_to_ts(F.lit(1704153600000)).alias("ms"), col.epoch_ns_to_ts(F.lit(1704153600000000000)).alias("ns"), col.period_label(F.lit(5), F.lit("Minute")).alias("p"), col.as_float(F.lit("1.5")).alias("f"),
        col.as_int(F.lit("10")).alias("i"), col.as_int(F.lit("10.5")).alias("j"), col.as_float(F.lit("")).alias("e"), col.as_int(F.lit(10.7)).alias("t"), col.build_contract_key(F.lit("x"), F.lit(DAY), F.lit(12345678.5), F.lit("CALL")).alias("k"),
    ).first()
    assert r["ms"] == r["ns"] == dt.datetime(2024, 1, 2)
    assert (r["p"], r["f"], r["i"], r["j"], r["e"], r["t"], r["k"]) == ("5 minute", 1.5, 10, None, None, 10, "X|OPT|20240102|12345678.5|C")


def test_trading_days_literal(spark):
    h = spark.createDataFrame([("NYSE", dt.date(2024, 7, 4), "closed"), ("NYSE", dt.date(2024, 7, 3), "early-close")], "exchange string, holiday_date date, status string")
    got = calendar.recent_trading_days(spark, h, F.lit(dt.date(2024, 7, 5)), 3).collect()
    assert sorted(r["day"] for r in got) == [dt.date(2024, 7, d) for d in (2, 3, 5)]


def test_sinks_are_idempotent(spark, tmp_path):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, None)], "k string, v int, w string")
    batch = spark.createDataFrame([("b", 3, "y", 0), ("b", None, "z", 1), ("c", 9, None, 0)], f"k string, v int, w string, {sinks.ORDINAL} int")
    for op in (lambda t: sinks.upsert_update(t, batch, ["k"]), lambda t: sinks.upsert_do_nothing(t, batch, ["k"]), lambda t: sinks.upsert_coalesce(t, batch, ["k"]).drop("inserted"), lambda t: sinks.replace_by_key(t, batch.drop(sinks.ORDINAL), "k")):
        once = op(target)
        assert sorted(map(str, once.collect())) == sorted(map(str, op(once).collect()))
    assert {(r["k"], r["v"], r["w"]) for r in sinks.upsert_update(target, batch, ["k"]).collect()} == {("a", 1, "x"), ("b", None, "z"), ("c", 9, None)}
    assert {(r["k"], r["v"], r["w"]) for r in sinks.upsert_coalesce(target, batch, ["k"]).collect()} == {("a", 1, "x"), ("b", 3, "z"), ("c", 9, None)}
    path = str(tmp_path / "t")
    sinks.write_partitions(sinks.with_partition(spark.createDataFrame([(DAY, 1), (EXP, 2)], "d date, v int"), "d", "month"), path, "month")
    sinks.write_partitions(sinks.with_partition(spark.createDataFrame([(EXP, 3)], "d date, v int"), "d", "month"), path, "month")
    assert sorted(r["v"] for r in spark.read.parquet(path).collect()) == [1, 3]


def test_sink_width_mismatch(spark):
    import pytest

    with pytest.raises(ValueError):
        sinks.upsert_update(spark.range(1).toDF("k"), spark.createDataFrame([(1, 2)], "k long, other int"), ["k"])


def test_stream_state_does_not_depend_on_batches(spark, tmp_path):
    from barwright.streaming import feed

    lines = ['{"ev":"Q","sym":"O:UA240119C00100000","t":5,"bp":1.0}', '[{"ev":"T","sym":"O:UA240119C00100000","t":7,"p":2.0},{"sym":"x"}]', "broken", '{"ev":"Q","sym":"short","t":1}', '{"ev":"Q","sym":"O:UB240119P00050000","t":3,"bp":4.0}']
    seen = []
    for files in (1, 5):
        src = tmp_path / f"in{files}"
        src.mkdir()
        for i in range(files):
            (src / f"{i}.json").write_text("\n".join(lines[i::files]) + "\n")
        raw = spark.readStream.option("maxFilesPerTrigger", 1).text(str(src))
        q = feed.latest_quotes(feed.normalized(feed.decoded(raw)).select("contract_key", "t", "ev"), ["t"])
        seen.append(sorted(map(str, feed.run_to_files(q, f"latest{files}", "complete").collect())))
    assert seen[0] == seen[1] and len(seen[0]) == 2


def test_stream_results_are_files(spark, sf, tmp_path):
    """Log and state are read from files, not from the driver's memory, also where the stream has no rows."""
    from barwright.plans.registry import QUERIES
    from barwright.streaming import feed

    for name in ("k3_latest_quote_state", "k4_event_log_sink"):
        assert QUERIES[name](spark, sf).inputFiles()
    (tmp_path / "none").mkdir()
    rows = spark.readStream.schema("a long").parquet(str(tmp_path / "none"))
    for stream, mode in ((rows, "append"), (rows.groupBy("a").count(), "complete")):
        assert feed.run_to_files(stream, "none", mode).count() == 0


def test_merged_results(spark):
    """Results of all pages in order; an empty page stays, and a next page beyond the limit is reported."""
    from barwright.sources import landing

    pages = [("a", 1, '{"results": ["x", "y"], "next_url": "u"}'), ("a", 2, '{"results": ["z"], "next_url": "u"}'), ("a", 3, '{"results": ["late"]}'), ("b", 1, '{"results": []}')]
    got = landing.merged_results(spark.createDataFrame(pages, "request string, page_no int, payload string"), 2).collect()
    assert sorted(map(tuple, got), key=str) == sorted([("a", 1, 0, "x", 2, True), ("a", 1, 1, "y", 2, True), ("a", 2, 0, "z", 2, True), ("b", 1, None, None, 1, False)], key=str)


def test_upsert_touches_its_partitions_only(spark, tmp_path):
    """Files of other partitions stay as they are, the staged copy goes, and the scan is pruned to the batch's partitions."""
    path = str(tmp_path / "bars")
    rows = [("A", dt.date(2024, m, 1), float(m)) for m in (1, 2, 3)]
    schema = "symbol string, bar_date date, close double"
    sinks.write_partitions(sinks.with_partition(spark.createDataFrame(rows, schema), "bar_date", "month"), path, "month")
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "bars").rglob("part-*")}
    batch = sinks.with_partition(spark.createDataFrame([("A", dt.date(2024, 2, 1), 9.0), ("B", dt.date(2024, 2, 5), 5.0)], schema), "bar_date", "month")
    sinks.upsert_partitions(path, batch, ["symbol", "bar_date", "month"], "month")
    got = sorted((r["symbol"], r["bar_date"].month, r["close"]) for r in spark.read.parquet(path).collect())
    assert got == [("A", 1, 1.0), ("A", 2, 9.0), ("A", 3, 3.0), ("B", 2, 5.0)]
    assert all(p.exists() and p.stat().st_mtime_ns == t for p, t in before.items() if "month=2024-02" not in str(p))
    assert [p.name for p in tmp_path.iterdir()] == ["bars"]


def test_partitioned_upsert_keeps_what_the_batch_lacks(spark, tmp_path):
    """Columns that the batch has not, its order, and rows without a partition."""
    path = str(tmp_path / "table")
    schema = "k string, v int, w int, part string"
    spark.createDataFrame([("a", 1, 10, "x"), ("b", 2, 20, "x"), ("c", 3, 30, None), ("d", 4, 40, "y")], schema).write.partitionBy("part").parquet(path)
    batch = spark.createDataFrame([("a", 5, "x", 1), ("a", 6, "x", 2), ("e", 7, None, 1), ("c", 8, None, 1)], f"k string, v int, part string, {sinks.ORDINAL} int")
    sinks.upsert_partitions(path, batch, ["k", "part"], "part")
    table = sinks.read_partitioned(spark, path)
    assert sorted(table.columns) == ["k", "part", "v", "w"]
    rows = sorted((r["k"], r["v"], r["w"], r["part"]) for r in table.collect())
    assert rows == [("a", 6, 10, "x"), ("b", 2, 20, "x"), ("c", 8, 30, None), ("d", 4, 40, "y"), ("e", 7, None, None)]
    sinks.upsert_partitions(path, batch.drop(sinks.ORDINAL).limit(1), ["k"], "part", sinks.upsert_coalesce)
    assert sinks.read_partitioned(spark, path).where("part is null").count() == 2


def test_stale_open_interest_gives_way_to_snapshots(spark):
    d = dt.date
    oi = spark.createDataFrame([("A", d(2020, 1, 2), "P", 9), ("B", d(2024, 1, 3), "P", 4), ("B", d(2024, 1, 3), "C", 2)], "underlying string, trade_date date, option_right string, open_interest long")
    contracts = spark.createDataFrame([("a1", "A", d(2024, 2, 1), "P"), ("a2", "A", d(2024, 2, 1), "C"), ("b1", "B", d(2024, 2, 1), "P")], "option_ticker string, underlying string, expiry date, option_right string")
    at = lambda day, h: dt.datetime(2024, 1, day, h)
    snaps = [("a1", at(4, 15), d(2024, 1, 4), 3), ("a1", at(4, 18), d(2024, 1, 4), None), ("a1", at(5, 15), d(2024, 1, 5), 6), ("a2", at(5, 15), d(2024, 1, 5), 4), ("b1", at(5, 15), d(2024, 1, 5), 50)]
    got = oa.pcr_trend(oi, spark.createDataFrame(snaps, "option_ticker string, snapshot_ts timestamp, ny_date date, open_interest long"), contracts, 90, F.lit(d(2024, 1, 8))).collect()
    assert sorted((r["underlying"], r["trade_date"].day, r["put"], r["call"], r["ratio"], r["latest_ratio"]) for r in got) == [("A", 4, 0, 0, None, 1.5), ("A", 5, 6, 4, 1.5, 1.5), ("B", 3, 4, 2, 2.0, 2.0)]


def test_first_seen_and_readiness(spark):
    old = spark.createDataFrame([("a", 1, "x", "x"), ("b", 1, "x", "x")], "k string, v int, first_seen_at string, updated_at string")
    got = sinks.first_seen(old, spark.createDataFrame([("b", 2), ("c", 3)], "k string, v int"), ["k"], F.lit("now")).collect()
    assert sorted(map(tuple, got)) == [("a", 1, "x", "x"), ("b", 2, "x", "now"), ("c", 3, "now", "now")]
    found = spark.createDataFrame([("b", None), ("z", 5)], "k string, v int")
    got = sinks.readiness_update(old.select("k", "v", "updated_at"), found, ["k"]).collect()
    assert sorted(map(tuple, got)) == [("a", 1, "x"), ("b", None, "x")]


def test_empty_expirations_are_rejected(spark):
    import pytest

    target = spark.createDataFrame([("A", EXP), ("B", EXP)], "underlying string, expiry date")
    asked = target.select("underlying").distinct()
    assert sinks.replace_expirations(target, target, asked).count() == 2
    with pytest.raises(ValueError, match="B"):
        sinks.replace_expirations(target, target.where("underlying = 'A'"), asked)


def test_landed_files(spark, tmp_path):
    """Decoders read JSON documents from a folder, one a line, with context from folder names; broken ones give no row."""
    from barwright.sources import landing

    for symbol, lines in (("aa", ['{"results": [{"t": 1704171600000, "o": 1, "h": 2, "l": 0.5, "c": 1.5, "v": 10}]}', "broken", '{"results": null}']), ("bb", ['{"results": [{"o": 1}, {"t": 1704258000000, "c": 3}]}'])):
        (tmp_path / f"symbol={symbol}").mkdir()
        (tmp_path / f"symbol={symbol}" / "pages.json").write_text("\n".join(lines) + "\n")
    got = landing.stock_daily(landing.read_pages(spark, str(tmp_path), "symbol string")).select("symbol", "bar_date", "close").collect()
    assert sorted(map(tuple, got)) == [("AA", dt.date(2024, 1, 2), 1.5), ("BB", dt.date(2024, 1, 3), 3.0)]


def test_ticker_details(spark):
    from barwright.sources import landing

    pages = ['{"results": {"ticker": " ab ", "market_cap": "12.5", "active": false, "currency_name": "", "currency_symbol": "USD", "list_date": "2020-01-02", "total_employees": 7}}', '{"symbol": "cd", "type": "", "instrument_type": "CS"}', '{"results": {"name": "no symbol"}}', "broken"]
    got = {r["symbol"]: r for r in landing.ticker_details(spark.createDataFrame([(p,) for p in pages], "payload string")).collect()}
    assert set(got) == {"AB", "CD"} and len(got["AB"]) == 18
    assert (got["AB"]["market_cap"], got["AB"]["active"], got["AB"]["currency"], got["AB"]["list_date"]) == (12.5, False, "USD", dt.date(2020, 1, 2))
    assert (got["CD"]["active"], got["CD"]["instrument_type"], got["CD"]["total_employees"]) == (True, "CS", None)


def test_filters_reach_below_the_newest_row(spark, sf):
    """Requested contracts are picked before the newest snapshot of a day is: the join with them stands below that aggregate on the plan."""
    from barwright.plans.registry import QUERIES

    lines = QUERIES["g5_chain_eod_by_keys"](spark, sf)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    top = next(i for i, line in enumerate(lines) if "max(struct" in line)
    below = next((i for i, line in enumerate(lines) if i > top and depth(line) <= depth(lines[top])), len(lines))
    assert any("Union" in line for line in lines[top:below])


def test_fill_rate_parses_a_document_once(spark):
    from barwright.operators import fundamentals as fun

    keys = [f"k{i}" for i in range(40)]
    rows = [("A", "r", '{"k1": 5, "k2": "", "k3": null, "k4": {"x": 1}}'), ("B", "r", '{"k1": 0}'), ("A", "r", '{"k1": 7}'), ("C", "s", "broken"), ("D", "s", None)]
    df = fun.fill_rate(spark.createDataFrame(rows, "symbol string, report_type string, data string"), keys)
    got = {(r["report_type"], r["key"]): r["symbols"] for r in df.collect()}
    assert len(got) == 80 and {k: n for k, n in got.items() if n} == {("r", "k1"): 2, ("r", "k4"): 1}
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


ODD_PAGE = """{"results":[5,{"t":1700000000000.0,"o":"1.5","h":"junk","l":{},"c":2,"v":7.9,"n":4.0},"str",null,[{"t":1}],{"o":1,"t":null},{"t":"1700086400000","n":"12","c":"1e3"}]}"""


def test_odd_elements_cost_only_themselves(spark):
    """An array with a number, a price in text, 4.0 in an integer field and a broken element keeps all other values."""
    from barwright.sources import landing

    clean = '{"results":[{"t":1700000000000,"c":3.5}]}'
    pages = spark.createDataFrame([("a", ODD_PAGE), ("b", clean), ("c", '{"results":[{"t":1'), ("d", None), ("e", '{"results":{"t":1}}')], "symbol string, payload string")
    got = {(r["symbol"], str(r["bar_date"])): r for r in landing.stock_daily(pages).collect()}
    assert sorted(got) == [("A", "2023-11-14"), ("A", "2023-11-15"), ("B", "2023-11-14")]
    first, second = got["A", "2023-11-14"], got["A", "2023-11-15"]
    assert (first["open"], first["high"], first["low"], first["close"], first["volume"], first["trade_count"]) == (1.5, None, None, 2.0, 7, 4)
    assert (second["close"], second["trade_count"]) == (1000.0, 12) and got["B", "2023-11-14"]["close"] == 3.5
    day = '{"tickers":["x",{"ticker":"ua","day":{"o":1.5,"h":"high","c":"2"},"prevDay":"none","todaysChange":"0.5"},{"ticker":7}]}'
    rows = landing.stock_snapshot(spark.createDataFrame([(day, None)], "payload string, session_date date")).collect()
    assert [(r["symbol"], r["open"], r["high"], r["close"], r["change"]) for r in rows] == [("UA", 1.5, None, 2.0, 0.5), ("7", None, None, None, None)]
    chain = '{"results":[9,{"details":{"ticker":"O:UA240119C00100000","strike_price":"100"},"greeks":5,"open_interest":3.0,"day":{"volume":"x"}},{"details":"none","ticker":"O:UB240119P00050000"}]}'
    rows = landing.option_snapshots(spark.createDataFrame([(chain, None)], "payload string, fetched_at timestamp")).collect()
    assert sorted((r["option_ticker"], r["underlying"], r["open_interest"]) for r in rows) == [("O:UA240119C00100000", "UA", 3), ("O:UB240119P00050000", "UB", None)]


def test_odd_messages_cost_only_themselves(spark):
    from barwright.streaming import feed

    quote = '{"ev":"Q","sym":"O:UA240119C00100000","t":5.0,"bp":"1.25","ap":"junk"}'
    raw = spark.createDataFrame([(f'[{quote},7,null,"x",[1],{{"ev":""}},{quote}]',), (quote,), ("[broken",), ('{"sym":"x"}',), (None,)], "value string")
    got = feed.normalized(feed.decoded(raw)).collect()
    assert len(got) == 3 and all((r["t"], r["bid"], r["ask"]) == (5, 1.25, None) for r in got)


def test_slot_adherence_of_repeated_fires(spark, sf, tmp_path):
    """Fires that occur more than once are one row each, as in SQL, and jobs at the ends of a window count at its start only."""
    import duckdb

    from barwright.operators import joblog
    from barwright.plans import ORACLE_SQL, QUERIES
    from tests.oracle import compare

    duckdb.sql(f"copy (select event_id + 1000000 * k as event_id, * exclude (event_id) from '{sf}/events.parquet', range(3) r(k)) to '{tmp_path}/events.parquet'")
    for name in ("i4_slot_adherence", "i4_slot_adherence_all"):
        compare(spark, str(tmp_path), QUERIES[name], ORACLE_SQL[name])
    at = dt.datetime(2024, 1, 1, 12)
    hours = lambda *hs: [at + dt.timedelta(hours=h) for h in hs]
    fires = spark.createDataFrame([("s", "k", t) for t in hours(0, 9, 100)] + [("s", None, at), ("s", "k", None)], "slot string, kind string, fire timestamp_ntz")
    jobs = spark.createDataFrame([("k", t) for t in [at, at, *hours(2.5, -1, 11.5)]] + [("k", None), (None, at)], "kind string, created_at timestamp_ntz")
    got = joblog.slot_adherence(fires, jobs, F.lit("2024-01-04 00:00:00").cast("timestamp_ntz"), 30)
    assert sorted((str(r["kind"]), str(r["fire"]), r["jobs"], r["state"]) for r in got.collect()) == [
        ("None", str(at), 0, "missed"), ("k", "2024-01-01 12:00:00", 2, "on_plan"), ("k", "2024-01-01 21:00:00", 0, "missed"), ("k", "2024-01-05 16:00:00", 0, "due"), ("k", "None", 0, "missed"),
    ]
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in text.splitlines() if "Join" in line and ("<" in line or ">=" in line)]  # no job meets a fire


def test_requests_are_parsed_once(spark, sf):
    """Contract keys are read above the rows that requests are made of, not in filters on these."""
    from barwright.plans import QUERIES

    for name in ("d7_tolerance_join", "g4_chain_latest_by_keys", "g5_chain_eod_by_keys"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert not [line for line in plan if "Filter" in line and "split(" in line]
