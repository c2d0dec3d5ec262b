"""Coverage, gaps, quality and readiness of the tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .chains import us_equity_universe
from .latest import chain_latest, latest_per_day, one_latest


def bar_aggregate(bars: DataFrame, as_of: Column, window_days: int = 420) -> DataFrame:
    """Rows, first and last day, and null closes and volumes per symbol in the window."""
    rows = bars.where(F.col("bar_date").between(F.date_sub(as_of, window_days), as_of))
    return rows.groupBy("symbol").agg(
        F.count("*").alias("bar_rows"), F.min("bar_date").alias("first_date"), F.max("bar_date").alias("last_date"),
        F.count_if(F.col("close").isNull()).alias("null_close_rows"), F.count_if(F.col("volume").isNull()).alias("null_volume_rows"),
    )


def readiness(bars: DataFrame, as_of: Column, least: int = 240) -> DataFrame:
    """Per symbol whether its bars are deep enough."""
    return bar_aggregate(bars, as_of).select("symbol", "bar_rows", "last_date", (F.col("bar_rows") >= least).alias("price_ready"))


def latest_bar_per_symbol(bars: DataFrame, since: Column | None = None) -> DataFrame:
    rows = bars if since is None else bars.where(F.col("bar_date") >= since)
    return one_latest(rows.select("symbol", "bar_date", "close"), ["symbol"], ["bar_date"])


def low_coverage_dates(bars: DataFrame, as_of: Column, days_back: int, min_symbols: int) -> DataFrame:
    """Days before as_of with fewer distinct symbols than wanted."""
    rows = bars.where(F.col("bar_date").between(F.date_sub(as_of, days_back), F.date_sub(as_of, 1)))
    return rows.groupBy("bar_date").agg(F.count_distinct("symbol").alias("symbols")).where(F.col("symbols") < min_symbols)


def snapshot_coverage(snapshots: DataFrame, tickers: DataFrame) -> DataFrame:
    """In the newest session: symbols with a snapshot against all symbols, per instrument type."""
    newest = snapshots.agg(F.max("session_date").alias("session_date"))
    seen = snapshots.join(F.broadcast(newest), "session_date", "left_semi").select("symbol").distinct().withColumn("seen", F.lit(True))  # one row
    kind = F.coalesce("instrument_type", F.lit("UNKNOWN")).alias("instrument_type")
    return tickers.join(seen, "symbol", "left").groupBy(kind).agg(F.count_if(F.col("seen")).alias("snapshot_rows"), F.count("*").alias("universe_rows"))


def vendor_gap(snapshots: DataFrame, bars: DataFrame, tickers: DataFrame) -> DataFrame:
    """Newest session closes of the equity universe that have no bar (fallback_gap), or whose bar is older and differs (vendor_gap).

    Warrants do not count, and a snapshot without a close is no gap.
    """
    newest = F.broadcast(snapshots.agg(F.max("session_date").alias("session_date")))  # one row
    listed = us_equity_universe(tickers).where(F.upper(F.coalesce("instrument_type", F.lit(""))) != "WARRANT").select("symbol")
    rows = snapshots.join(newest, "session_date", "left_semi").where("close is not null").join(listed, "symbol", "left_semi").select("symbol", "session_date", F.col("close").alias("snapshot_close"))
    last = latest_bar_per_symbol(bars).select("symbol", F.col("bar_date").alias("last_bar_date"), F.col("close").alias("last_bar_close"))
    stale = (F.col("last_bar_date") < F.col("session_date")) & (F.abs(F.col("snapshot_close") - F.col("last_bar_close")) >= 1e-4)
    reason = F.when(F.col("last_bar_date").isNull(), "fallback_gap").when(stale, "vendor_gap")
    return rows.join(last, "symbol", "left").withColumn("reason", reason).where("reason is not null")


WORD_BITS = 64


def _bit(i: Column) -> Column:
    """A word with bit i."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))


def missing_sessions(symbols: DataFrame, days: DataFrame, have: DataFrame, others: bool = False) -> DataFrame:
    """Rows (symbol, expected_days, missing_days, missing, days): for each symbol the sessions it lacks, as bits of words over the ordered days.

    A symbol's days are bits of 64-bit words, put together before the shuffle, so no row is made for a pair of a symbol and a day. days is a list of
    sessions (column day): its ordinals, one row for each day, go to all tasks; have: (symbol, day). With others, the symbols of have that are not
    asked for come too, and columns asked and has tell which symbols are asked for and which have any day at all.
    """
    listed = days.agg(F.array_sort(F.collect_set("day")).alias("days"))  # one row
    ordinals = listed.select(F.posexplode("days").alias("pos", "day"))  # one row for each session looked back on
    ordinals = ordinals.select("day", F.floor(F.col("pos") / WORD_BITS).cast("int").alias("word"), _bit(F.col("pos") % WORD_BITS).alias("bit"))
    held = have.select("symbol", "day").join(F.broadcast(ordinals), "day", "left" if others else "inner").groupBy("symbol", "word").agg(F.bit_or("bit").alias("bits"))
    words_held = F.collect_list(F.when(F.col("word").isNotNull(), F.struct("word", "bits")))  # a 64th of the days
    held = held.groupBy("symbol").agg(F.map_from_entries(words_held).alias("held")).withColumn("has", F.lit(True))
    rows = symbols.select("symbol").distinct().withColumn("asked", F.lit(True)).join(held, "symbol", "full" if others else "left").join(F.broadcast(listed))
    n = F.size("days")
    words = F.sequence(F.lit(0), F.floor((n - 1) / WORD_BITS).cast("int"))
    full = lambda w: F.when((w + 1) * WORD_BITS <= n, F.lit(-1).cast("long")).otherwise(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), (n % WORD_BITS).cast("int"))))
    lacking = F.transform(words, lambda w: full(w).bitwiseAND(F.bitwise_not(F.coalesce(F.col("held")[w], F.lit(0).cast("long")))))
    rows = rows.withColumn("missing", F.when(n > 0, lacking).otherwise(F.array().cast("array<bigint>")))
    count = F.aggregate("missing", F.lit(0).cast("long"), lambda s, w: s + F.bit_count(w))
    flags = [F.coalesce(c, F.lit(False)).alias(c) for c in ("asked", "has") if others]
    return rows.select("symbol", n.cast("long").alias("expected_days"), count.alias("missing_days"), "missing", "days", *flags)


def missing_dates() -> Column:
    """The days whose bits are set in rows of `missing_sessions`."""
    is_set = lambda i: F.get("missing", F.floor(i / WORD_BITS).cast("int")).bitwiseAND(_bit(i % WORD_BITS)) != 0
    return F.filter("days", lambda day, i: is_set(i))


def check_row(name: str, df: DataFrame, passed: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check"), passed.alias("passed"))


def stock_daily_check(bars: DataFrame, watchlist: DataFrame, days: DataFrame, min_symbols: int) -> DataFrame:
    """Enough symbols, and no hole of a watched symbol on a trading day; both by one pass over the bars."""
    rows = missing_sessions(watchlist, days, bars.select("symbol", F.col("bar_date").alias("day")), others=True)
    both = rows.agg(F.count(F.when(F.col("has"), F.col("symbol"))).alias("n"), F.coalesce(F.sum(F.when(F.col("asked"), F.col("missing_days"))), F.lit(0)).alias("gaps"))
    return both.select(F.lit("stock_daily_coverage").alias("check"), ((F.col("n") > min_symbols) & (F.col("gaps") == 0)).alias("passed"), F.col("gaps"))


def holes(symbols: DataFrame, days: DataFrame, have: DataFrame) -> DataFrame:
    """Pairs (symbol, day) that are expected but absent; no others are made on the way."""
    return missing_sessions(symbols, days, have).where("missing_days > 0").select("symbol", F.explode(missing_dates()).alias("day"))


def gap_sample(symbols: DataFrame, days: DataFrame, have: DataFrame, limit: int = 50) -> DataFrame:
    """The first missing pairs (symbol, day), for a report."""
    return holes(symbols, days, have).orderBy("day", "symbol").limit(limit)


def day_gaps(symbols: DataFrame, days: DataFrame, bars: DataFrame, limit: int = 120) -> DataFrame:
    """Per symbol the expected, covered and missing days, and its first missing ones."""
    rows = missing_sessions(symbols, days, bars.select("symbol", F.col("bar_date").alias("day")))
    return rows.select("symbol", "expected_days", (F.col("expected_days") - F.col("missing_days")).alias("covered_days"), "missing_days", F.slice(missing_dates(), 1, limit).alias("missing_dates"))


def optionable(watchlist: DataFrame, contracts: DataFrame) -> DataFrame:
    return watchlist.select("symbol").distinct().join(contracts.select(F.col("underlying").alias("symbol")), "symbol", "left_semi")


def option_snapshot_check(watchlist: DataFrame, contracts: DataFrame, snapshots: DataFrame, session: Column) -> DataFrame:
    """Every optionable watched symbol has a snapshot in the session; a list without any passes."""
    seen = snapshots.where(F.col("ny_date") == session).select(F.col("underlying").alias("symbol"))
    gaps = optionable(watchlist, contracts).join(seen, "symbol", "left_anti").agg(F.count("*").alias("gaps"))
    return gaps.select(F.lit("option_snapshot_coverage").alias("check"), (F.col("gaps") == 0).alias("passed"), "gaps")


def option_oi_check(watchlist: DataFrame, contracts: DataFrame, oi: DataFrame, days: DataFrame) -> DataFrame:
    """Every optionable watched symbol has open interest on every completed day; an empty watchlist fails."""
    lacking = missing_sessions(optionable(watchlist, contracts), days, oi.select(F.col("underlying").alias("symbol"), F.col("trade_date").alias("day")))
    gaps = lacking.agg(F.coalesce(F.sum("missing_days"), F.lit(0)).alias("gaps"))
    n = watchlist.agg(F.count("*").alias("n"))
    return gaps.join(n).select(F.lit("option_oi_coverage").alias("check"), ((F.col("gaps") == 0) & (F.col("n") > 0)).alias("passed"), "gaps")  # one row each


def freshness_rows(freshness: DataFrame, expected: Iterable[str], now: Column, hours: int = 24) -> DataFrame:
    """Each expected dimension with its state: missing, bad status, stale (age not under the limit) or ok."""
    want = freshness.sparkSession.createDataFrame([(d,) for d in expected], "dimension string")
    age = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("last_run_at").cast("timestamp"))) / 3.6e9
    state = F.when(F.col("status").isNull(), "missing").when(F.col("status") != "ok", "status").when(F.col("age") >= hours, "stale").otherwise("ok")
    return want.join(freshness, "dimension", "left").withColumn("age", age).select("dimension", state.alias("state"))


def freshness_check(freshness: DataFrame, expected: Iterable[str], now: Column, hours: int = 24) -> DataFrame:
    rows = freshness_rows(freshness, expected, now, hours)
    return rows.agg(F.count_if(F.col("state") != "ok").alias("gaps")).select(F.lit("freshness").alias("check"), (F.col("gaps") == 0).alias("passed"), "gaps")


def quality_report(*checks: DataFrame) -> DataFrame:
    """All checks, under distinct names, and a row that says whether each passed. Each check is worked out once."""
    rows = checks[0]
    for c in checks[1:]:
        rows = rows.unionByName(c)
    totals = rows.rollup("check").agg(F.bool_and("passed").alias("passed"), F.sum("gaps").alias("gaps"), F.grouping("check").alias("_all"))
    return totals.select(F.when(F.col("_all") == 1, "all").otherwise(F.col("check")).alias("check"), "passed", "gaps")


def inventory(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Distinct keys, rows, first and last day of each table, given as name -> (table, key, day)."""
    out = None
    for name, (df, key, day) in tables.items():
        row = df.agg(F.lit(name).alias("name"), F.count_distinct(key).alias("symbols"), F.count("*").alias("n_rows"), F.min(F.col(day).cast("date")).alias("first_day"), F.max(F.col(day).cast("date")).alias("last_day"))
        out = row if out is None else out.union(row)
    return out


def table_stats(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and newest day of each table, given as name -> (table, day)."""
    out = None
    for name, (df, day) in tables.items():
        row = df.agg(F.lit(name).alias("name"), F.count("*").alias("row_count"), F.max(F.col(day).cast("date")).alias("latest"))
        out = row if out is None else out.union(row)
    return out


def status_summary(freshness: DataFrame, limit: int = 20) -> DataFrame:
    """The dimensions that ran last, for a status page."""
    return freshness.select("dimension", "last_run_at", "status", "rows_written").orderBy(F.col("last_run_at").desc_nulls_last(), "dimension").limit(limit)


def distributions(df: DataFrame, column: str, limit: int) -> DataFrame:
    return df.where(F.trim(F.coalesce(column, F.lit(""))) != "").groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(limit)


def watchlist_coverage(watchlist: DataFrame, contracts: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Contracts, expirations and newest snapshot day per watched symbol, zeros for those without."""
    c = contracts.groupBy(F.col("underlying").alias("symbol")).agg(F.count("*").alias("contracts"), F.count_distinct("expiry").alias("expiries"))
    s = snapshots.groupBy(F.col("underlying").alias("symbol")).agg(F.max("ny_date").alias("newest"))
    out = watchlist.select("symbol").join(c, "symbol", "left").join(s, "symbol", "left")
    return out.na.fill(0, ["contracts", "expiries"])


def greeks_coverage(snapshots: DataFrame) -> DataFrame:
    """Newest snapshots per underlying: how many have IV, delta, and all Greeks."""
    cols = ("iv", "delta", "gamma", "theta", "vega")
    rows = chain_latest(snapshots.select("option_ticker", "underlying", "snapshot_ts", *cols))
    full = F.col("delta").isNotNull() & F.col("gamma").isNotNull() & F.col("theta").isNotNull() & F.col("vega").isNotNull()
    return rows.groupBy("underlying").agg(F.count("*").alias("contracts"), F.count("iv").alias("with_iv"), F.count("delta").alias("with_delta"), F.count_if(full).alias("full_greeks"))


def contracts_coverage(contracts: DataFrame) -> DataFrame:
    return contracts.groupBy("underlying").agg(F.count("*").alias("contracts"), F.count_distinct("expiry").alias("expiries"), F.count_distinct("strike").alias("strikes"), F.min("expiry").alias("first_expiry"), F.max("expiry").alias("last_expiry"))


def contract_reference_gap(contracts: DataFrame) -> DataFrame:
    """Contracts whose identity is incomplete."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    return contracts.where(blank("underlying") | F.col("expiry").isNull() | F.col("strike").isNull() | blank("option_right"))


def contracts_without(contracts: DataFrame, rows: DataFrame, since: Column, day: str) -> DataFrame:
    """Contracts without a row (snapshot or bar) since a day."""
    return contracts.join(rows.where(F.col(day) >= since).select("option_ticker"), "option_ticker", "left_anti")


def bar_quality_detail(bars: DataFrame, since: Column) -> DataFrame:
    whole = F.col("open").isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull() & F.col("close").isNotNull()
    return bars.where(F.col("bar_date") >= since).select("symbol", "bar_date", whole.alias("ohlc_complete"))


def bar_quality_summary(bars: DataFrame, since: Column) -> DataFrame:
    """Per symbol all rows with first and last day, and the rows since a day that are whole."""
    whole = F.col("open").isNotNull() & F.col("high").isNotNull() & F.col("low").isNotNull() & F.col("close").isNotNull()
    recent = F.col("bar_date") >= since
    return bars.groupBy("symbol").agg(
        F.count("*").alias("row_count"), F.min("bar_date").alias("min_date"), F.max("bar_date").alias("max_date"), F.count_if(recent).alias("recent_rows"), F.count_if(recent & whole).alias("recent_whole"),
    )


def snapshot_quality_daily(snapshots: DataFrame) -> DataFrame:
    """Per New York day: contracts, and shares in percent (1 place) with IV, all Greeks, and open interest."""
    rows = latest_per_day(snapshots)
    full = F.col("delta").isNotNull() & F.col("gamma").isNotNull() & F.col("theta").isNotNull() & F.col("vega").isNotNull()
    share = lambda n: F.round(F.lit(100.0) * n / F.count("*"), 1)
    return rows.groupBy("ny_date").agg(F.count("*").alias("contracts"), share(F.count("iv")).alias("iv_pct"), share(F.count_if(full)).alias("greeks_pct"), share(F.count("open_interest")).alias("oi_pct"))


CORE = ("name", "sector", "industry", "market_cap")


def _filled(columns: Iterable[str] = CORE) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & (F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) != "")
    return out


def overview_coverage(tickers: DataFrame) -> DataFrame:
    filled = F.count_if(_filled())
    return tickers.agg(F.count("*").alias("total"), filled.alias("filled"), (F.count("*") - filled).alias("missing"))


def missing_overview(tickers: DataFrame, limit: int, offset: int) -> DataFrame:
    return tickers.where(~_filled()).select("symbol").orderBy("symbol").offset(offset).limit(limit)


def related_coverage(tickers: DataFrame, related: DataFrame) -> DataFrame:
    have = related.select(F.col("from_symbol").alias("symbol")).distinct().withColumn("have", F.lit(True))
    filled = F.count_if(F.coalesce("have", F.lit(False)))
    return tickers.select("symbol").join(have, "symbol", "left").agg(F.count("*").alias("total"), filled.alias("filled"), (F.count("*") - filled).alias("missing"))


def missing_related(tickers: DataFrame, related: DataFrame, limit: int, offset: int = 0) -> DataFrame:
    return tickers.select("symbol").join(related.select(F.col("from_symbol").alias("symbol")), "symbol", "left_anti").orderBy("symbol").offset(offset).limit(limit)


def daily_checklist(symbols: DataFrame, day: Column, bars: DataFrame, oi: DataFrame, actions: DataFrame) -> DataFrame:
    """Rows of each symbol on a day in daily bars, open interest and corporate actions."""
    count = lambda df, key, on, name: df.where(F.col(on) == day).groupBy(F.col(key).alias("symbol")).agg(F.count("*").alias(name))
    out = symbols.select("symbol")
    for part in (count(bars, "symbol", "bar_date", "daily"), count(oi, "underlying", "trade_date", "oi"), count(actions, "symbol", "ex_date", "actions")):
        out = out.join(part, "symbol", "left")
    return out.na.fill(0)


def checklist_with_freshness(checklist: DataFrame, freshness: DataFrame, sources: dict[str, str]) -> DataFrame:
    """The checklist one row for each source, with the state of its dimension (null where none ran); sources: column of the checklist -> dimension."""
    long = checklist.select("symbol", F.explode(F.array(*(F.struct(F.lit(c).alias("source"), F.lit(d).alias("dimension"), F.col(c).alias("n")) for c, d in sources.items()))).alias("s"))
    return long.select("symbol", "s.*").join(freshness.select("dimension", "status", "rows_written"), "dimension", "left")
