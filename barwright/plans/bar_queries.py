"""Queries of bars, indicators, chains, reference lookups and the calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import bars, calendar, chains, indicators
from .registry import query

D = lambda y, m, d: F.lit(dt.date(y, m, d))


@query(
    "f1_daily_bars",
    """select symbol, bar_date, open, high, low, close, volume, 'stock_daily' as source from stock_daily where symbol in ('UA', 'UB', 'UBC')
    and bar_date between date '2000-12-31' - 365 and date '2000-12-31'""",
)
def _(m):
    return bars.daily_bars(m.stock_daily, ["UA", "UB", "UBC"], 365, D(2000, 12, 31))


@query("f2_daily_close", "select bar_date, close from stock_daily where symbol = 'UC' and close is not null")
def _(m):
    return bars.daily_close(m.stock_daily, "UC")


@query(
    "f3_bars_newest_first",
    """select symbol, bar_date, open, high, low, close, volume from stock_daily qualify row_number() over (partition by symbol
    order by bar_date desc) <= 30""",
)
def _(m):
    return bars.bars_newest_first(m.stock_daily, ["symbol"], "bar_date", 30).select("symbol", "bar_date", "open", "high", "low", "close", "volume")


@query(
    "f3_minute_bars_newest_first",
    """select symbol, period, epoch_us(bar_time) as t, close from stock_minute qualify row_number() over (partition by symbol, period
    order by bar_time desc) <= 20""",
)
def _(m):
    return bars.bars_newest_first(m.stock_minute, ["symbol", "period"], "bar_time", 20).select("symbol", "period", F.unix_micros(F.col("bar_time").cast("timestamp")).alias("t"), "close")


@query("f4_latest_bar_time", "select symbol, max(epoch_us(bar_time)) / 1e6 as latest from stock_minute group by symbol")
def _(m):
    return bars.latest_bar_time(m.stock_minute)


@query(
    "f5_bar_times_in_range",
    """select symbol, epoch_us(bar_time) / 1e6 as t from stock_minute where bar_time between timestamp '2024-01-05 00:00:00'
    and timestamp '2024-01-12 00:00:00'""",
)
def _(m):
    return bars.bar_times_in_range(m.stock_minute, F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz"))


@query(
    "f6_asof_bar_with_prev",
    """with p as (select symbol, bar_date, close, lag(close) over (partition by symbol order by bar_date) as prev_close from stock_daily),
    r as (select distinct symbol, ex_date as as_of from corporate_action) select r.symbol, r.as_of, p.bar_date, p.close, p.prev_close from r asof join p on p.symbol = r.symbol and p.bar_date <= r.as_of""",
)
def _(m):
    return bars.asof_bars(m.stock_daily, m.corporate_action.select("symbol", F.col("ex_date").alias("as_of")).distinct())


@query(
    "f7_fallback_price",
    """select symbol, bar_date, close, lead(close) over w as prev_close from stock_daily window w as (partition by symbol order by bar_date desc)
    qualify row_number() over w = 1""",
)
def _(m):
    return bars.fallback_price(m.stock_daily)


@query(
    "f8_bars_stats",
    """select symbol, coalesce(d, 0) as daily, coalesce(n, 0) as minute from (select symbol, count(*) as d from stock_daily group by symbol) a full
    join (select symbol, count(*) as n from stock_minute group by symbol) b using (symbol)""",
)
def _(m):
    return bars.bars_stats(m.stock_daily, m.stock_minute)


@query(
    "f9_bars_coverage",
    """select t.symbol, count(d.bar_date) as n, min(d.bar_date) as first_day, max(d.bar_date) as last_day from (select symbol from ticker union
    select 'ZZZ') t left join stock_daily d using (symbol) group by t.symbol""",
)
def _(m):
    return bars.bars_coverage(m.stock_daily, m.ticker.select("symbol").union(m.spark.createDataFrame([("ZZZ",)], "symbol string")))


@query(
    "f10_caret_symbols",
    """select distinct case when symbol like 'UB%' then '^' || symbol else symbol end as symbol from (select symbol from stock_daily union
    select symbol from stock_minute) x where symbol like 'UB%'""",
)
def _(m):
    caret = lambda df: df.select(F.when(F.col("symbol").startswith("UB"), F.concat(F.lit("^"), "symbol")).otherwise(F.col("symbol")).alias("symbol"))
    return bars.caret_symbols(caret(m.stock_daily), caret(m.stock_minute))


OPTION_DAILY = "ob as (select s.option_ticker, s.underlying, c.expiry, c.strike, c.option_right, s.ny_date as bar_date, max(s.iv) as close, cast(max(s.day_volume) as bigint) as volume from option_snapshot s join option_contract c on c.option_ticker = s.option_ticker group by all)"


def option_daily(m):
    c = m.option_contract.select("option_ticker", "expiry", "strike", "option_right")
    rows = m.option_snapshot.join(c, "option_ticker").withColumnRenamed("ny_date", "bar_date")
    return rows.groupBy("option_ticker", "underlying", "expiry", "strike", "option_right", "bar_date").agg(F.max("iv").alias("close"), F.max("day_volume").alias("volume"))


@query(
    "f11_option_daily_bars",
    f"""with {OPTION_DAILY} select * from ob where underlying = 'UA' and expiry = date '2004-01-16' and bar_date >= date '1999-01-01'
    order by bar_date, strike, option_right, option_ticker limit 5000""",
)
def _(m):
    return bars.option_bars(option_daily(m), "UA", D(2004, 1, 16), D(1999, 1, 1))


@query("f11_option_daily_dates", f"with {OPTION_DAILY} select distinct underlying, bar_date from ob")
def _(m):
    return bars.option_bar_dates(option_daily(m))


@query(
    "f12_option_minute_bars",
    """select option_ticker, epoch_us(snapshot_ts) as t, iv from option_snapshot qualify row_number() over (partition by option_ticker
    order by snapshot_ts desc) <= 5""",
)
def _(m):
    return bars.bars_newest_first(m.option_snapshot, ["option_ticker"], "snapshot_ts", 5).select("option_ticker", F.unix_micros("snapshot_ts").alias("t"), "iv")


@query("f13_corporate_actions", "select symbol, action_type, ex_date, ratio_from, ratio_to, amount from corporate_action where action_type = 'dividend'")
def _(m):
    return bars.corporate_actions(m.corporate_action, "dividend")


@query(
    "l1_sma",
    """select symbol, bar_date, case when count(*) over w = 20 then round(avg(close) over w, 6) end as sma
    from stock_daily window w as (partition by symbol order by bar_date rows between 19 preceding and current row)""",
)
def _(m):
    return indicators.sma(m.stock_daily, 20).withColumn("sma", F.round("sma", 6))


CLOSES = """b as materialized (select symbol, bar_date, close, row_number() over (partition by symbol order by bar_date) as k
    from stock_daily where close is not null)"""


def smoothed(name: str, rows: str, value: str, window: int, alpha: str) -> str:
    """Recursive SQL for exponential smoothing of a column from the mean of its first values; rows have symbol and k = 1, 2, ..."""
    return f"""{name} as (select symbol, cast({window} as bigint) as k, avg({value}) as v from {rows} where k <= {window} group by symbol having count(*) = {window}
    union all select n.symbol, n.k, {alpha} * n.{value} + (1 - {alpha}) * s.v from {name} s join {rows} n on n.symbol = s.symbol and n.k = s.k + 1)"""


@query("l2_ema", f"with recursive {CLOSES}, {smoothed('r', 'b', 'close', 10, '(2 / 11)')} select symbol, bar_date, round(r.v, 6) as ema from b left join r using (symbol, k)")
def _(m):
    return indicators.ema(m.stock_daily, 10).withColumn("ema", F.round("ema", 6))


@query(
    "l3_rsi",
    f"""with recursive {CLOSES}, d as (select symbol, k - 1 as k, close - lag(close) over (partition by symbol order by k) as d from b),
    steps as materialized (select symbol, k, greatest(d, 0) as up, greatest(-d, 0) as down from d where k > 0),
    {smoothed('u', 'steps', 'up', 14, '(1 / 14)')}, {smoothed('w', 'steps', 'down', 14, '(1 / 14)')}
    select b.symbol, b.bar_date, round(case when w.v = 0 then 100 else 100 - 100 / (1 + u.v / w.v) end, 6) as rsi
    from b left join u on u.symbol = b.symbol and u.k = b.k - 1 left join w on w.symbol = b.symbol and w.k = b.k - 1""",
)
def _(m):
    return indicators.rsi(m.stock_daily).withColumn("rsi", F.round("rsi", 6))


@query(
    "l4_macd",
    f"""with recursive {CLOSES}, {smoothed('s', 'b', 'close', 12, '(2 / 13)')}, {smoothed('l', 'b', 'close', 26, '(2 / 27)')},
    m as materialized (select s.symbol, s.k - 25 as k, s.v - l.v as d from s join l using (symbol, k)), {smoothed('g', 'm', 'd', 9, '(2 / 10)')}
    select b.symbol, b.bar_date, round(m.d, 6) as macd, round(g.v, 6) as signal, round(m.d - g.v, 6) as histogram
    from b left join m on m.symbol = b.symbol and m.k = b.k - 25 left join g on g.symbol = b.symbol and g.k = b.k - 25""",
)
def _(m):
    out = indicators.macd(m.stock_daily)
    return out.withColumns({c: F.round(c, 6) for c in ("macd", "signal", "histogram")})


@query(
    "l5_resample_bars",
    """select symbol, epoch_us(time_bucket(interval '1 hour', bar_time)) as t, arg_min(open, bar_time) as open, max(high) as high, min(low) as low,
        arg_max(close, bar_time) as close, cast(sum(volume) as bigint) as volume, round(sum(close * volume) / sum(volume), 6) as vwap
    from stock_minute group by symbol, time_bucket(interval '1 hour', bar_time)""",
)
def _(m):
    out = bars.resample_bars(m.stock_minute, "1 hour")
    return out.select("symbol", F.unix_micros(F.col("bar_time").cast("timestamp")).alias("t"), "open", "high", "low", "close", "volume", F.round("vwap", 6).alias("vwap"))


@query(
    "l6_open_close",
    """select symbol, bar_date, open, close, lag(close) over (partition by symbol order by bar_date) as prev_close from stock_daily
    qualify bar_date = date '2000-03-01'""",
)
def _(m):
    asked = m.stock_daily.select("symbol").distinct().withColumn("as_of", D(2000, 3, 1))
    found = bars.asof_bars(m.stock_daily, asked).where("bar_date = as_of")
    return found.join(m.stock_daily.select("symbol", "bar_date", "open"), ["symbol", "bar_date"]).select("symbol", "bar_date", "open", "close", "prev_close")


@query("l6_grouped_daily", "select symbol, open, high, low, close, volume from stock_daily where bar_date = date '2000-03-01'")
def _(m):
    return m.stock_daily.where(F.col("bar_date") == D(2000, 3, 1)).select("symbol", "open", "high", "low", "close", "volume")


@query(
    "l7_movers",
    """with r as (select session_date, symbol, change_pct, close as price, volume from stock_snapshot where change_pct is not null)
    select *, 'gainers' as direction from (select * from r qualify row_number() over (partition by session_date order by change_pct desc, symbol) <= 3) a
    union all select *, 'losers' from (select * from r qualify row_number() over (partition by session_date order by change_pct, symbol) <= 3) b""",
)
def _(m):
    return bars.movers(m.stock_snapshot, 3)


@query(
    "l8_split_adjusted_bars",
    """select b.symbol, b.bar_date, b.close, coalesce(product(a.ratio_from / a.ratio_to), 1) as factor,
        b.close / coalesce(product(a.ratio_from / a.ratio_to), 1) as adjusted_close
    from stock_daily b left join corporate_action a on a.symbol = b.symbol and a.action_type = 'split' and a.ex_date > b.bar_date group by b.symbol, b.bar_date, b.close""",
)
def _(m):
    return bars.split_adjusted(m.stock_daily, m.corporate_action)


@query("g1_expirations", """with n as (select underlying, count(distinct expiry) as n_expirations, coalesce(min(expiry) filter (expiry >= date '2004-03-01'), min(expiry)) as nearest from option_contract group by underlying)
    select n.underlying, n.n_expirations, n.nearest, count(distinct c.strike) as n_strikes, min(c.strike) as lowest from n join option_contract c on c.underlying = n.underlying and c.expiry = n.nearest group by all""")
def _(m):
    table = m.option_contract.where("underlying < 'UF'").select("underlying", "expiry").distinct()
    out = chains.expirations(table, m.option_contract, D(2004, 3, 1))
    return out.select("underlying", F.size("expirations").cast("long").alias("n_expirations"), "nearest", F.size("strikes").cast("long").alias("n_strikes"), F.array_min("strikes").alias("lowest"))


CHAIN = "chain as (select * from option_snapshot qualify row_number() over (partition by option_ticker order by snapshot_ts desc) = 1)"


@query(
    "g2_snapshots_latest",
    f"""with {CHAIN} select s.option_ticker, s.iv, c.expiry, c.strike, c.option_right from chain s join option_contract c
    on c.option_ticker = s.option_ticker where s.underlying = 'UB' order by c.expiry, c.strike, c.option_right, s.option_ticker limit 40""",
)
def _(m):
    return chains.snapshots_latest(m.option_snapshot, m.option_contract, "UB", 40).select("option_ticker", "iv", "expiry", "strike", "option_right")


@query(
    "g3_oi_rows",
    """select option_ticker, trade_date, expiry, strike, open_interest from option_open_interest where underlying = 'UC'
    and trade_date >= date '2000-01-01'""",
)
def _(m):
    rows = m.option_open_interest.where((F.col("underlying") == "UC") & (F.col("trade_date") >= D(2000, 1, 1)))
    return rows.select("option_ticker", "trade_date", "expiry", "strike", "open_interest")


def asked(m):
    """Mixed requests: tickers of some contracts, contract keys with slightly wrong strikes of others, and one malformed."""
    c = m.option_contract
    keys = c.where("pk % 3 = 1").select(F.concat_ws("|", "underlying", F.lit("OPT"), F.date_format("expiry", "yyyyMMdd"), (F.col("strike") + 0.00001).cast("string"), "option_right").alias("key"))
    return c.where("pk % 3 = 0").select(F.col("option_ticker").alias("key")).union(keys).union(m.spark.createDataFrame([("UA|OPT|x|1|C",)], "key string"))


@query(
    "g4_chain_latest_by_keys",
    f"""with {CHAIN} select s.option_ticker, c.pk % 3 = 0 as vendor, epoch_us(s.snapshot_ts) as t, s.iv from chain s join option_contract c
    on c.option_ticker = s.option_ticker where c.pk % 3 < 2""",
)
def _(m):
    return chains.chain_latest_by_keys(asked(m), m.option_contract, m.option_snapshot).select("option_ticker", "vendor", F.unix_micros("snapshot_ts").alias("t"), "iv")


@query(
    "g5_chain_eod_by_keys",
    """select s.option_ticker, s.ny_date, s.iv, d.close as underlying_price from option_snapshot s join option_contract c
        on c.option_ticker = s.option_ticker left join stock_daily d on d.symbol = s.underlying and d.bar_date = s.ny_date
    where c.pk % 3 < 2 and s.ny_date >= date '2001-01-01' qualify row_number() over (partition by s.option_ticker, s.ny_date order by s.snapshot_ts desc) = 1""",
)
def _(m):
    return chains.chain_eod_by_keys(asked(m), m.option_contract, m.option_snapshot, m.stock_daily, D(2001, 1, 1)).select("option_ticker", "ny_date", "iv", "underlying_price")


@query(
    "g6_contracts_list",
    """select option_ticker, underlying, expiry, strike, option_right, underlying || '|OPT|' || strftime(expiry,
    '%Y%m%d') || '|' || cast(strike as varchar) || '|' || option_right as contract_key from option_contract""",
)
def _(m):
    return chains.contracts_list(m.option_contract)


@query("g6_strikes", "select distinct underlying, expiry, strike from option_contract")
def _(m):
    return m.option_contract.select("underlying", "expiry", "strike").distinct()


@query("g6_expirations_yyyymmdd", "select distinct underlying, strftime(expiry, '%Y%m%d') as expiry from option_contract")
def _(m):
    return m.option_contract.select("underlying", F.date_format("expiry", "yyyyMMdd").alias("expiry")).distinct()


@query(
    "g7_ticker_search",
    """select symbol, name, case when symbol = 'UB' then 0 when symbol like 'UB%' then 1 else 2 end as match from ticker where symbol like 'UB%'
    or upper(name) like '%UB%' order by match, symbol limit 8""",
)
def _(m):
    return chains.ticker_search(m.ticker, "ub", 8).select("symbol", "name", "match")


@query("g8_ticker_batch", "select symbol, name, market, locale, instrument_type from ticker where symbol in ('UA', 'UBB')")
def _(m):
    wanted = m.spark.createDataFrame([("UA",), ("UBB",), ("NONE",)], "symbol string")
    return m.ticker.join(wanted, "symbol", "left_semi").select("symbol", "name", "market", "locale", "instrument_type")


@query("g9_ticker_types", "select instrument_type, market, locale, count(*) as n from ticker group by all")
def _(m):
    return chains.ticker_types(None, m.ticker)


@query("g10_ticker_related", "select r.from_symbol, r.to_symbol, r.rank, t.name from ticker_related r left join ticker t on t.symbol = r.to_symbol")
def _(m):
    return chains.related_with_names(m.ticker_related, m.ticker).select("from_symbol", "to_symbol", "rank", "name")


UNIVERSE = "active and lower(coalesce(locale, '')) = 'us' and lower(coalesce(market, '')) = 'stocks' and lower(coalesce(instrument_type, '')) = 'cs'"


@query("d1_us_equity_universe", f"select symbol, name from ticker where {UNIVERSE}")
def _(m):
    return chains.us_equity_universe(m.ticker).select("symbol", "name")


@query("g11_universe_count", f"select count(*) as n from ticker where {UNIVERSE}")
def _(m):
    return chains.us_equity_universe(m.ticker).agg(F.count("*").alias("n"))


@query("d5_semi_filter_by_list", "select option_ticker, strike from option_contract where underlying in ('UA', 'UD')")
def _(m):
    return m.option_contract.join(m.spark.createDataFrame([("UA",), ("UD",)], "underlying string"), "underlying", "left_semi").select("option_ticker", "strike")


@query("d6_anti_join_missing", "select symbol from ticker where symbol not in (select from_symbol from ticker_related)")
def _(m):
    return m.ticker.join(m.ticker_related.select(F.col("from_symbol").alias("symbol")), "symbol", "left_anti").select("symbol")


@query("d7_tolerance_join", "select option_ticker from option_contract where pk % 3 < 2")
def _(m):
    return chains.resolve_keys(asked(m), m.option_contract).select("option_ticker").distinct()


@query(
    "d8_lateral_latest",
    f"""with {CHAIN} select c.option_ticker, s.iv, s.day_volume from option_contract c left join chain s on s.option_ticker = c.option_ticker""",
)
def _(m):
    from ..operators.latest import chain_latest

    return m.option_contract.select("option_ticker").join(chain_latest(m.option_snapshot), "option_ticker", "left").select("option_ticker", "iv", "day_volume")


@query("d9_optionable_filter", "select symbol from ticker where symbol in (select underlying from option_contract where strike > 200)")
def _(m):
    return m.ticker.join(m.option_contract.where("strike > 200").select(F.col("underlying").alias("symbol")), "symbol", "left_semi").select("symbol")


@query(
    "d10_resolve_watchlist",
    """select underlying as symbol, 'contracts' as source from option_contract group by underlying order by count(*) desc, underlying limit 7""",
)
def _(m):
    return chains.resolve_watchlist(m.ticker.where("false"), m.option_contract, 7)


@query("d11_union_benchmarks", "select distinct symbol from (select symbol from ticker union select unnest(['SPY', 'QQQ', 'IWM'])) x")
def _(m):
    return chains.union_benchmarks(m.ticker)


@query(
    "j1_closed_holidays",
    """select holiday_date from us_market_holiday where status = 'closed' and holiday_date between date '1996-01-01' and date '1999-12-31'""",
)
def _(m):
    return calendar.closed_holidays(m.us_market_holiday, D(1996, 1, 1), D(1999, 12, 31))


OPEN = "dayofweek(day) between 1 and 5 and day not in (select holiday_date from us_market_holiday where status = 'closed')"


@query(
    "j2_recent_trading_days",
    f"""select day from (select cast(unnest(generate_series(date '1998-01-01', date '1998-07-08', interval 1 day)) as date) as day) x where {OPEN}
    order by day desc limit 30""",
)
def _(m):
    return calendar.recent_trading_days(m.spark, m.us_market_holiday, D(1998, 7, 8), 30)


@query(
    "j3_expected_trading_days",
    f"""select day from (select cast(unnest(generate_series(date '1996-01-01', date '2001-12-31', interval 1 day)) as date) as day) x where {OPEN}""",
)
def _(m):
    return calendar.expected_trading_days(m.spark, m.us_market_holiday, D(1996, 1, 1), D(2001, 12, 31))


@query(
    "c27_is_trading_day",
    """select day, dayofweek(day) between 1 and 5 and day not in (select holiday_date from us_market_holiday where status = 'closed') as is_trading
    from (select distinct bar_date as day from stock_daily) x""",
)
def _(m):
    return calendar.is_trading_day(m.stock_daily.select(F.col("bar_date").alias("day")).distinct(), m.us_market_holiday)


@query(
    "c28_resolve_target_date",
    """select distinct epoch_us(snapshot_ts) as t, case dayofweek(ny_date) when 6 then ny_date - 1 when 0 then ny_date - 2 else ny_date end as target
    from option_snapshot""",
)
def _(m):
    return m.option_snapshot.select(F.unix_micros("snapshot_ts").alias("t"), calendar.resolve_target_date(F.col("snapshot_ts")).alias("target")).distinct()
