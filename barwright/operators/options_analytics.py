"""Daily option analytics for all underlyings, dates and expiries at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import is_call, is_put, parse_option_right, parse_option_ticker, safe_ratio, valid_iv
from .latest import chain_latest, latest_per_day
from .selection import medians

SERIES = ["underlying", "trade_date", "expiry"]


def max_pain_curve(oi: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """Pain at every strike present: 100 * sum of open interest times intrinsic value, split into calls and puts.

    Strikes are whole thousandths, so sums are exact. Running sums over strikes in both directions replace the pairing of all strikes.
    """
    kind = F.upper(F.trim("option_right"))
    rows = oi.where(F.col("strike").isNotNull()).withColumn("milli", F.round(F.col("strike") * 1000).cast("long"))
    q = F.coalesce("open_interest", F.lit(0)).cast("long")
    grid = rows.groupBy(*keys, "milli").agg(F.sum(F.when(kind == "C", q).otherwise(0)).alias("call_oi"), F.sum(F.when(kind == "P", q).otherwise(0)).alias("put_oi"))
    up = Window.partitionBy(*keys).orderBy("milli").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(*keys).orderBy("milli").rowsBetween(0, Window.unboundedFollowing)
    k, c, p = F.col("milli"), F.col("call_oi"), F.col("put_oi")
    tenth = lambda x: (x / 10).cast("double")  # noqa: E731  thousandths times 100
    pain_call = k * F.sum(c).over(up) - F.sum(c * k).over(up)
    pain_put = F.sum(p * k).over(down) - k * F.sum(p).over(down)
    out = grid.withColumns({"_pc": pain_call, "_pp": pain_put})
    return out.select(*keys, (k / 1000).alias("strike"), "call_oi", "put_oi", tenth(F.col("_pc")).alias("pain_call"), tenth(F.col("_pp")).alias("pain_put"), tenth(F.col("_pc") + F.col("_pp")).alias("pain"))


def max_pain_daily(oi: DataFrame, keys: list[str] = SERIES) -> DataFrame:
    """The strike with least pain of every series (ties: the lowest), total open interest, and the pain there."""
    best = F.min(F.struct("pain", "strike"))
    out = max_pain_curve(oi, keys).groupBy(*keys).agg(best.alias("b"), F.sum(F.col("call_oi") + F.col("put_oi")).alias("total_oi"))
    return out.select(*keys, F.col("b.strike").alias("max_pain_strike"), "total_oi", F.col("b.pain").alias("total_pain_at_strike"))


def newest_dates(df: DataFrame, keys: list[str], lookback_days: int = 0, day: str = "trade_date") -> DataFrame:
    """Rows whose day is within lookback_days of the newest one of their key."""
    newest = F.max(day).over(Window.partitionBy(*keys))
    return df.withColumn("_newest", newest).where(F.col(day) >= F.date_sub("_newest", lookback_days)).drop("_newest")


def max_pain_history(oi: DataFrame, lookback_days: int = 90) -> DataFrame:
    return max_pain_daily(newest_dates(oi, ["underlying", "expiry"], lookback_days))


def with_stock(snapshots: DataFrame, stock_daily: DataFrame) -> DataFrame:
    """Snapshots with the close of their underlying on the New York day (null where there is none)."""
    close = stock_daily.select(F.col("symbol").alias("underlying"), F.col("bar_date").alias("ny_date"), F.col("close").alias("underlying_price"))
    return snapshots.join(close, ["underlying", "ny_date"], "left")


def atm_iv_rows(snapshots: DataFrame, contracts: DataFrame, stock_daily: DataFrame) -> DataFrame:
    """Newest snapshot of each contract and day among those with IV and underlying price, with the contract's identity."""
    rows = with_stock(snapshots.select("option_ticker", "underlying", "snapshot_ts", "ny_date", "iv"), stock_daily)
    newest = latest_per_day(rows, F.col("iv").isNotNull() & F.col("underlying_price").isNotNull())
    return newest.join(contracts.select("option_ticker", "expiry", "strike", "option_right"), "option_ticker").withColumnRenamed("ny_date", "trade_date")


def atm_iv_daily(rows: DataFrame) -> DataFrame:
    """IV at the money per series: spot is the median price; the nearest call and the nearest put (ties: by ticker) count, each alone if need be."""
    spot = rows.where("underlying_price > 0").groupBy(*SERIES).agg(F.median("underlying_price").alias("spot"))
    good = rows.withColumns({"v": valid_iv(F.col("iv")), "side": parse_option_right(F.col("option_right"))}).where("v is not null and strike > 0 and side is not null")
    near = F.struct(F.abs(F.col("strike") - F.col("spot")), F.col("option_ticker"))
    side = lambda s: F.min_by(F.when(F.col("side") == s, F.col("v")), F.when(F.col("side") == s, near))
    out = good.join(spot, SERIES).groupBy(*SERIES).agg(F.min_by("strike", near).alias("atm_strike"), side("C").alias("call_iv"), side("P").alias("put_iv"), F.first("spot").alias("underlying_price"))
    mean = F.coalesce((F.col("call_iv") + F.col("put_iv")) / 2, "call_iv", "put_iv")
    return out.withColumns({"atm_iv": mean, "iv_source": F.lit("snapshot")})


def pcr_totals(rows: DataFrame, value: str, keys: list[str], right: str = "option_right") -> DataFrame:
    """Put and call sums of a value per key."""
    v = F.coalesce(F.col(value), F.lit(0)).cast("long")
    side = lambda test, n: F.sum(F.when(test, v).otherwise(0)).alias(n)
    return rows.groupBy(*keys).agg(side(is_put(F.col(right)), "put"), side(is_call(F.col(right)), "call"))


def newest_rows(snapshots: DataFrame, contracts: DataFrame, value: str) -> DataFrame:
    """Newest snapshot of each contract and day whatever its value, with the contract's underlying, expiry and right."""
    newest = latest_per_day(snapshots.select("option_ticker", "snapshot_ts", "ny_date", value))
    return newest.join(contracts.select("option_ticker", "underlying", "expiry", "option_right"), "option_ticker").withColumnRenamed("ny_date", "trade_date")


def volume_rows(snapshots: DataFrame, contracts: DataFrame) -> DataFrame:
    return newest_rows(snapshots, contracts, "day_volume")


def pcr_daily(oi: DataFrame, snapshots: DataFrame, contracts: DataFrame) -> DataFrame:
    """Put/call ratios of open interest and volume per underlying and date; a missing side is 0, all-zero rows go."""
    keys = ["underlying", "trade_date"]
    a = pcr_totals(oi, "open_interest", keys).withColumnsRenamed({"put": "total_put_oi", "call": "total_call_oi"})
    b = pcr_totals(volume_rows(snapshots, contracts), "day_volume", keys).withColumnsRenamed({"put": "total_put_volume", "call": "total_call_volume"})
    sums = ["total_put_oi", "total_call_oi", "total_put_volume", "total_call_volume"]
    out = a.join(b, keys, "full_outer").select(*keys, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in sums)).where(" + ".join(sums) + " > 0")
    return out.withColumns({"pcr_oi": safe_ratio(F.col(sums[0]), F.col(sums[1])), "pcr_volume": safe_ratio(F.col(sums[2]), F.col(sums[3]))})


def iv_rollup(atm: DataFrame) -> DataFrame:
    """Median IV over expiries of each symbol and date."""
    return medians(atm, ["symbol", "trade_date"], "atm_iv", "iv")


def iv_percentile_daily(daily: DataFrame, window: int = 252) -> DataFrame:
    """Percentile and rank of each day's IV among the last `window` values within 2 * window + 30 days, that day included.

    daily has one row for each symbol and day; rows without an IV or a day are left out. Days are cut into blocks as long as that span, so a day's
    values lie in its own block and the one before: a block's values, and the earlier one's, are held once for the whole block, and a
    long history is spread over tasks.
    """
    span = 2 * window + 30
    block = lambda day: F.floor(day / (span + 1))
    rows = daily.where("iv is not null and trade_date is not null").select("symbol", F.unix_date("trade_date").alias("day"), "iv")
    rows = rows.select("*", F.explode(F.array(block(F.col("day")), block(F.col("day")) + 1)).alias("_block"))
    blocks = rows.groupBy("symbol", "_block").agg(F.array_sort(F.collect_list(F.struct("day", "iv"))).alias("h"))  # 2 * (span + 1) values at most
    blocks = blocks.select("symbol", "_block", F.col("h.day").alias("days"), F.col("h.iv").alias("ivs"))

    def placed(day: Column, i: Column) -> Column:
        most, since = F.least(i + 1, F.lit(window)), day - span
        recent = F.size(F.filter(F.slice("days", i + 2 - most, most), lambda y: y >= since))
        n = F.when(F.get("days", i + 1 - most) >= since, most).otherwise(recent)
        return F.struct(day.alias("day"), F.get("ivs", i).alias("iv"), F.slice("ivs", i + 2 - n, n).alias("v"))

    def counted(x: Column) -> Column:
        return F.struct(x["day"].alias("day"), x["iv"].alias("iv"), F.size(x["v"]).alias("n"), F.array_min(x["v"]).alias("low"), F.array_max(x["v"]).alias("high"), F.size(F.filter(x["v"], lambda y: y <= x["iv"])).alias("upto"))

    own = lambda day, i: F.when(block(day) == F.col("_block"), F.transform(F.array(placed(day, i)), counted)[0])  # noqa: E731  one day's values at a time
    rows = blocks.select("symbol", F.explode(F.filter(F.transform("days", own), lambda x: x.isNotNull())).alias("x")).select("symbol", "x.*")
    percentile = F.round(100.0 * F.col("upto") / F.col("n"), 4)
    rank = F.when(F.col("high") > F.col("low"), F.round(100.0 * F.try_divide(F.col("iv") - F.col("low"), F.col("high") - F.col("low")), 4)).otherwise(50.0)
    return rows.select("symbol", F.date_from_unix_date("day").alias("trade_date"), F.col("iv").alias("iv_current"), percentile.alias("iv_percentile_1y"), rank.alias("iv_rank_1y"), F.col("n").alias("lookback_days"))


def oi_extract(snapshots: DataFrame, contracts: DataFrame) -> DataFrame:
    """Open interest per contract and New York day from the newest snapshot that has one; identity from the contract, else from the ticker."""
    rows = latest_per_day(snapshots.select("option_ticker", "underlying", "snapshot_ts", "ny_date", "open_interest"), F.col("open_interest").isNotNull())
    c = contracts.select("option_ticker", *(F.col(x).alias(f"c_{x}") for x in ("underlying", "expiry", "strike", "option_right")))
    t = parse_option_ticker(F.col("option_ticker"))
    rows = rows.join(c, "option_ticker", "left").withColumn("t", t)
    pick = lambda x: F.coalesce(f"c_{x}", f"t.{x}").alias(x)
    out = rows.select("option_ticker", F.col("ny_date").alias("trade_date"), F.coalesce("c_underlying", "t.underlying", "underlying").alias("underlying"), pick("expiry"), pick("strike"), pick("option_right"), "open_interest")
    return out.where("expiry is not null and strike is not null and option_right in ('C', 'P')")


def _trend(rows: DataFrame, value: str) -> DataFrame:
    """Ratios (3 places) per underlying and date, and the last one of each underlying."""
    out = pcr_totals(rows, value, ["underlying", "trade_date"]).withColumn("ratio", safe_ratio(F.col("put"), F.col("call"), 3))
    newest = Window.partitionBy("underlying").orderBy("trade_date").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)  # days of the lookback
    return out.withColumn("latest_ratio", F.last("ratio").over(newest))


def _lookback(days: int) -> int:
    return min(max(days, 30), 400)


def pcr_trend(oi: DataFrame, snapshots: DataFrame, contracts: DataFrame, lookback_days: int, as_of: Column) -> DataFrame:
    """Put/call ratio of open interest per underlying and date since lookback_days (30 to 400) before as_of, and its latest value.

    Underlyings without open interest in that time take that of their snapshots, the newest of each contract and day; null counts as 0.
    """
    since = F.date_sub(as_of, _lookback(lookback_days))
    cols = ["underlying", "trade_date", "option_right", "open_interest"]
    held = oi.select(*cols).where(F.col("trade_date") >= since)
    recent = newest_rows(snapshots.where(F.col("snapshot_ts") >= since), contracts, "open_interest").select(*cols)
    return _trend(held.unionByName(recent.join(held.select("underlying").distinct(), "underlying", "left_anti")), "open_interest")


def pcr_volume_trend(snapshots: DataFrame, contracts: DataFrame, lookback_days: int, as_of: Column) -> DataFrame:
    """The same of volume, from the newest snapshot of each contract and day."""
    since = F.date_sub(as_of, _lookback(lookback_days))
    return _trend(volume_rows(snapshots.where(F.col("snapshot_ts") >= since), contracts), "day_volume")


def chain_or_open_interest(snapshots: DataFrame, contracts: DataFrame, oi: DataFrame, fallback: Column) -> DataFrame:
    """`chain_by_expiry` with the newest New York day of its snapshots; underlyings without contracts take open interest of the fallback date."""
    days = chain_latest(snapshots.select("option_ticker", "snapshot_ts", "ny_date")).join(contracts.select("option_ticker", "underlying", "expiry"), "option_ticker")
    days = days.groupBy("underlying", "expiry").agg(F.max("ny_date").alias("snap_day"))
    chain = chain_by_expiry(snapshots, contracts).join(days, ["underlying", "expiry"], "left").withColumn("basis", F.lit("option_snapshot"))
    rest = oi.where(F.col("trade_date") == fallback).join(contracts.select("underlying"), "underlying", "left_anti")
    none = F.lit(0).cast("long")
    rest = pcr_totals(rest, "open_interest", ["underlying", "expiry"]).select(
        "underlying", "expiry", F.col("put").alias("put_oi"), F.col("call").alias("call_oi"), none.alias("put_volume"), none.alias("call_volume"), fallback.alias("snap_day"), F.lit("option_open_interest").alias("basis"),
    )
    return chain.unionByName(rest)


def on_days(df: DataFrame, days: DataFrame, day: str = "trade_date") -> DataFrame:
    """The rows of some sessions (column day), for jobs that work on several days again."""
    return df.join(days.select(F.col("day").alias(day)), day, "left_semi")


def chain_by_expiry(snapshots: DataFrame, contracts: DataFrame) -> DataFrame:
    """Put and call open interest and volume per underlying and expiry from the newest snapshot of each contract, zero where there is none."""
    newest = chain_latest(snapshots.select("option_ticker", "snapshot_ts", "open_interest", "day_volume"))
    rows = contracts.join(newest, "option_ticker", "left")
    side = lambda test, v, n: F.sum(F.when(test, F.coalesce(F.col(v), F.lit(0))).otherwise(0)).cast("long").alias(n)
    put, call = is_put(F.col("option_right")), is_call(F.col("option_right"))
    return rows.groupBy("underlying", "expiry").agg(side(put, "open_interest", "put_oi"), side(call, "open_interest", "call_oi"), side(put, "day_volume", "put_volume"), side(call, "day_volume", "call_volume"))


def nearest_rank(values: Column, p: float) -> Column:
    """Element of an ascending array at round-half-even((n - 1) * p)."""
    return F.element_at(values, (F.bround((F.size(values) - 1) * F.lit(p)) + 1).cast("int"))


def liquidity_summary(snapshots: DataFrame, limit: int) -> DataFrame:
    """Count, sum and nearest-rank p50 and p90 of open interest and volume over the first `limit` contracts of each underlying by ticker."""
    from .latest import n_latest

    rows = n_latest(chain_latest(snapshots.select("underlying", "option_ticker", "snapshot_ts", "open_interest", "day_volume")), ["underlying"], [F.col("option_ticker")], limit)
    arrays = rows.groupBy("underlying").agg(F.count("*").alias("contracts"), F.array_sort(F.collect_list("open_interest")).alias("oi"), F.array_sort(F.collect_list("day_volume")).alias("vol"))  # limit values
    total = lambda a: F.aggregate(a, F.lit(0).cast("long"), lambda s, x: s + x)
    cols = {f"{n}_{k}": f for n in ("oi", "vol") for k, f in (("count", F.size(n)), ("sum", total(F.col(n))), ("p50", nearest_rank(F.col(n), 0.5)), ("p90", nearest_rank(F.col(n), 0.9)))}
    return arrays.select("underlying", "contracts", *(c.alias(k) for k, c in cols.items()))


def iv_curve(snapshots: DataFrame, contracts: DataFrame) -> DataFrame:
    """Strike against IV of the newest snapshots."""
    newest = chain_latest(snapshots.select("option_ticker", "snapshot_ts", "iv")).withColumn("iv", valid_iv(F.col("iv"))).where("iv is not null")
    return newest.join(contracts, "option_ticker").select("underlying", "expiry", "option_right", "strike", "iv", "option_ticker")


def read_daily(df: DataFrame, key: str = "symbol", end: Column | None = None, lookback_days: int | None = None, limit: int = 500) -> DataFrame:
    """Derived daily rows: a window that ends at a date, else the given date, else each key's newest; newest first, limited."""
    if lookback_days is not None:
        last = F.current_date() if end is None else end
        rows = df.where(F.col("trade_date").between(F.date_sub(last, lookback_days), last))
    else:
        rows = df.where(F.col("trade_date") == end) if end is not None else newest_dates(df, [key])
    return rows.orderBy(F.desc("trade_date"), key, *(["expiry"] if "expiry" in df.columns else [])).limit(limit)
