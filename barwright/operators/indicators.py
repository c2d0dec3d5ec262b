"""Technical indicators per symbol over daily closes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored
from .scans import numbered, smoothed


def sma(bars: DataFrame, window: int) -> DataFrame:
    """Simple moving average, null until `window` rows."""
    w = Window.partitionBy("symbol").orderBy("bar_date").rowsBetween(-(window - 1), 0)
    return bars.select("symbol", "bar_date", F.when(F.count("close").over(w) == window, F.avg("close").over(w)).alias("sma"))


def _closes(bars: DataFrame, time: str) -> tuple[DataFrame, int]:
    """Closes numbered by symbol, with the one before; and the greatest number. They are read several times, so they are stored."""
    rows = stored(numbered(bars.where("close is not null").select("symbol", time, "close"), ["symbol"], time, ["close"]))
    return rows, rows.agg(F.max("n")).first()[0] or 1


def ema(bars: DataFrame, window: int, time: str = "bar_date") -> DataFrame:
    """Exponential moving average from the mean of the first `window` closes on, null before."""
    rows, longest = _closes(bars, time)
    found = smoothed(rows, ["symbol"], time, window, 2 / (window + 1), "close", longest=longest).withColumnRenamed("close", "ema")
    early = rows.where(F.col("n") < window).select("symbol", time, F.lit(None).cast("double").alias("ema"))
    return found.select("symbol", time, "ema").unionByName(early)


def rsi(bars: DataFrame, window: int = 14, time: str = "bar_date") -> DataFrame:
    """Relative strength with Wilder's smoothing; 100 where nothing fell."""
    rows, longest = _closes(bars, time)
    step = F.col("close") - F.col("prev_close")
    steps = rows.where("n > 1").select("symbol", time, (F.col("n") - 1).alias("n"), F.greatest(step, F.lit(0.0)).alias("up"), F.greatest(-step, F.lit(0.0)).alias("down"))
    value = F.when(F.col("down") == 0, 100.0).otherwise(100 - 100 / (1 + F.col("up") / F.col("down")))
    found = smoothed(steps, ["symbol"], time, window, 1 / window, "up", "down", longest=longest).select("symbol", time, value.alias("rsi"))
    return found.unionByName(rows.where(F.col("n") <= window).select("symbol", time, F.lit(None).cast("double").alias("rsi")))


def macd(bars: DataFrame, short: int = 12, long: int = 26, signal: int = 9, time: str = "bar_date") -> DataFrame:
    """Difference of a short and a long exponential average, its own average (signal), and what it is above that; null until there is one."""
    (rows, longest), key = _closes(bars, time), ["symbol", time, "n"]
    fast, slow = (smoothed(rows, ["symbol"], time, w, 2 / (w + 1), "close", longest=longest).withColumnRenamed("close", name) for w, name in ((short, "fast"), (long, "slow")))
    value = stored(fast.join(slow, key).select(*key, (F.col("fast") - F.col("slow")).alias("macd")))
    line = value.withColumns({"n": F.col("n") - max(short, long) + 1, "signal": F.col("macd")}).select(*key, "signal")
    line = smoothed(line, ["symbol"], time, signal, 2 / (signal + 1), "signal", longest=longest).select("symbol", time, "signal")
    out = rows.select("symbol", time).join(value.drop("n"), ["symbol", time], "left").join(line, ["symbol", time], "left")
    return out.withColumn("histogram", F.col("macd") - F.col("signal"))
