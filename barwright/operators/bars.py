"""Bars and prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import epoch_seconds
from .latest import n_latest
from .scans import carried, total_after


def daily_bars(bars: DataFrame, symbols: list[str], days: int, as_of: Column) -> DataFrame:
    """OHLCV of symbols over the days up to as_of, with their source. Sort by symbol and day where an order is wanted."""
    rows = bars.where(F.col("symbol").isin(symbols) & F.col("bar_date").between(F.date_sub(as_of, days), as_of))
    return rows.select("symbol", "bar_date", "open", "high", "low", "close", "volume", F.lit("stock_daily").alias("source"))


def daily_close(bars: DataFrame, symbol: str = "SPY") -> DataFrame:
    return bars.where((F.col("symbol") == symbol) & F.col("close").isNotNull()).select("bar_date", "close")


def bars_newest_first(bars: DataFrame, keys: list[str], time: str, limit: int) -> DataFrame:
    return n_latest(bars, keys, [F.desc(time)], limit)


def latest_bar_time(bars: DataFrame, time: str = "bar_time") -> DataFrame:
    return bars.groupBy("symbol").agg(F.max(epoch_seconds(F.col(time))).alias("latest"))


def bar_times_in_range(bars: DataFrame, start: Column, end: Column) -> DataFrame:
    return bars.where(F.col("bar_time").between(start, end)).select("symbol", epoch_seconds(F.col("bar_time")).alias("t"))


def asof_bars(bars: DataFrame, requests: DataFrame) -> DataFrame:
    """The newest bar on or before each requested day with the close before it (rows symbol, as_of).

    Bars and requests are laid on one time line, which is cut into blocks of time (see `scans.carried`).
    """
    rows = carried(bars.select("symbol", "bar_date", "close"), ["symbol"], ["bar_date"], ["bar_date", "close"], F.lit(True), "prev", strict=True)
    line = rows.select("symbol", F.col("bar_date").alias("day"), F.lit(0).alias("kind"), "bar_date", "close", F.col("prev.close").alias("prev_close"))
    asks = requests.select("symbol", F.col("as_of").alias("day"), F.lit(1).alias("kind"))
    line = line.unionByName(asks, allowMissingColumns=True)
    out = carried(line, ["symbol"], ["day", "kind"], ["bar_date", "close", "prev_close"], F.col("kind") == 0, "bar").where("kind = 1 and bar is not null")
    return out.select("symbol", F.col("day").alias("as_of"), "bar.bar_date", "bar.close", "bar.prev_close")


def fallback_price(bars: DataFrame) -> DataFrame:
    """Last close, its day and the close before, per symbol; symbols whose last close is null are not found.

    The two newest bars are found first (Spark prunes the others before the shuffle), then laid side by side.
    """
    two = n_latest(bars.select("symbol", "bar_date", "close"), ["symbol"], [F.desc("bar_date")], 2).withColumn("newest", F.max("bar_date").over(Window.partitionBy("symbol")))
    first = F.col("bar_date") == F.col("newest")
    out = two.groupBy("symbol").agg(F.max("bar_date").alias("bar_date"), F.max(F.when(first, F.col("close"))).alias("close"), F.max(F.when(~first, F.col("close"))).alias("prev_close"))
    return out.where("close is not null")


def bars_stats(daily: DataFrame, minute: DataFrame) -> DataFrame:
    """Row counts per symbol, one column for each period."""
    rows = daily.select("symbol", F.lit("1 day").alias("period")).union(minute.select("symbol", "period"))
    return rows.groupBy("symbol").pivot("period", ["1 day", "1 minute"]).count().na.fill(0).withColumnsRenamed({"1 day": "daily", "1 minute": "minute"})


def bars_coverage(bars: DataFrame, symbols: DataFrame, day: str = "bar_date") -> DataFrame:
    """Count and first and last day per listed symbol, zero for symbols without bars."""
    found = bars.groupBy("symbol").agg(F.count("*").alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return symbols.join(found, "symbol", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def caret_symbols(*bars: DataFrame) -> DataFrame:
    """Distinct symbols that start with a caret, half or full width."""
    out = bars[0].select("symbol")
    for b in bars[1:]:
        out = out.union(b.select("symbol"))
    return out.where(F.col("symbol").rlike("^[\\^＾]")).distinct()


def option_bars(bars: DataFrame, underlying: str, expiry: Column, since: Column, limit: int = 5000) -> DataFrame:
    rows = bars.where((F.col("underlying") == underlying) & (F.col("expiry") == expiry) & (F.col("bar_date") >= since))
    return rows.orderBy("bar_date", "strike", "option_right", "option_ticker").limit(limit)


def option_bar_dates(bars: DataFrame) -> DataFrame:
    return bars.select("underlying", "bar_date").distinct()


def corporate_actions(actions: DataFrame, kind: str) -> DataFrame:
    return actions.where(F.col("action_type") == kind)


def resample_bars(bars: DataFrame, width: str) -> DataFrame:
    """Tumbling bars of a width: first open, extremes, last close, summed volume, volume-weighted close."""
    v = F.col("volume")
    out = bars.groupBy("symbol", F.window("bar_time", width).alias("w")).agg(
        F.min_by("open", "bar_time").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "bar_time").alias("close"),
        F.sum(v).alias("volume"), F.try_divide(F.sum(F.col("close") * v), F.sum(v).cast("double")).alias("vwap"),
    )
    return out.select("symbol", F.col("w.start").alias("bar_time"), "open", "high", "low", "close", "volume", "vwap")


def split_adjusted(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Closes divided by the ratio of all splits after their day.

    The splits of a symbol and its bars are laid on one time line; the ratios after a bar are a running product over blocks of time, from the last one back.
    """
    splits = actions.where("action_type = 'split' and ratio_from > 0 and ratio_to > 0").select("symbol", F.col("ex_date").alias("day"), F.lit(1).alias("kind"), (F.col("ratio_from") / F.col("ratio_to")).alias("ratio"))
    line = bars.select("symbol", F.col("bar_date").alias("day"), F.lit(2).alias("kind"), F.lit(1.0).alias("ratio"), "close").unionByName(splits, allowMissingColumns=True)
    out = total_after(line, ["symbol"], ["day", "kind"], "ratio", "factor").where("kind = 2")
    return out.select("symbol", F.col("day").alias("bar_date"), "close", "factor", (F.col("close") / F.col("factor")).alias("adjusted_close"))


def movers(snapshots: DataFrame, n: int) -> DataFrame:
    """The n largest gains and losses of each session."""
    rows = snapshots.where("change_pct is not null").select("session_date", "symbol", "change_pct", F.col("close").alias("price"), "volume")
    up = n_latest(rows, ["session_date"], [F.desc("change_pct"), F.col("symbol")], n).withColumn("direction", F.lit("gainers"))
    down = n_latest(rows, ["session_date"], [F.col("change_pct"), F.col("symbol")], n).withColumn("direction", F.lit("losers"))
    return up.union(down)
