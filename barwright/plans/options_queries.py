"""Queries of option analytics, latest rows and chains."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..operators import calendar, latest, options_analytics as oa
from .registry import query

PAIN = """curve as (
    select k.underlying, k.trade_date, k.expiry, k.strike, sum(case when o.option_right = 'C' then o.open_interest * greatest(k.strike - o.strike,
        0) * 100 else 0 end) as pain_call,
        sum(case when o.option_right = 'P' then o.open_interest * greatest(o.strike - k.strike, 0) * 100 else 0 end) as pain_put,
            sum(o.open_interest) as total_oi,
        sum(case when o.option_right = 'C' and o.strike = k.strike then o.open_interest else 0 end) as call_oi, sum(case when o.option_right = 'P'
            and o.strike = k.strike then o.open_interest else 0 end) as put_oi
    from (select distinct underlying, trade_date, expiry, strike from option_open_interest) k join option_open_interest o using (underlying, trade_date, expiry)
    group by k.underlying, k.trade_date, k.expiry, k.strike)"""
BEST = """best as (select underlying, trade_date, expiry, arg_min(strike, (pain_call + pain_put, strike)) as max_pain_strike, cast(any_value(total_oi) as bigint) as total_oi, min(pain_call + pain_put) as total_pain_at_strike
    from curve group by underlying, trade_date, expiry)"""


@query("max_pain_daily", f"with {PAIN}, {BEST} select * from best")
def _(m):
    return oa.max_pain_daily(m.option_open_interest)


@query(
    "e2_max_pain_curve",
    f"""with {PAIN} select underlying, trade_date, expiry, strike, cast(call_oi as bigint) as call_oi, cast(put_oi as bigint) as put_oi, pain_call,
    pain_put, pain_call + pain_put as pain from curve qualify trade_date = max(trade_date) over (partition by underlying, expiry)""",
)
def _(m):
    return oa.max_pain_curve(oa.newest_dates(m.option_open_interest, ["underlying", "expiry"]))


@query("e3_max_pain_history", f"with {PAIN}, {BEST} select * from best qualify trade_date >= max(trade_date) over (partition by underlying, expiry) - 90")
def _(m):
    return oa.max_pain_history(m.option_open_interest, 90)


ATM_ROWS = """rows as (
    select s.option_ticker, s.underlying, s.snapshot_ts, s.ny_date as trade_date, s.iv, d.close as underlying_price, c.expiry, c.strike, c.option_right
    from option_snapshot s join stock_daily d on d.symbol = s.underlying and d.bar_date = s.ny_date join option_contract c on c.option_ticker = s.option_ticker
    where s.iv is not null qualify row_number() over (partition by s.option_ticker, s.ny_date order by s.snapshot_ts desc) = 1)"""
ATM = """spots as (select underlying, trade_date, expiry, median(underlying_price) as spot from rows group by all),
good as (select r.*, spot, abs(strike - spot) as dist from rows r join spots using (underlying, trade_date, expiry) where iv > 0 and iv < 10),
atm as (select underlying, trade_date, expiry, arg_min(strike, (dist, option_ticker)) as atm_strike, arg_min(iv, (dist,
    option_ticker)) filter (option_right = 'C') as call_iv,
    arg_min(iv, (dist, option_ticker)) filter (option_right = 'P') as put_iv, any_value(spot) as underlying_price from good group by all)"""


@query(
    "e4_atm_iv_rows",
    f"""with {ATM_ROWS} select underlying, trade_date, option_ticker, epoch_us(snapshot_ts) as ts_us, iv, underlying_price, expiry, strike,
    option_right from rows""",
)
def _(m):
    rows = oa.atm_iv_rows(m.option_snapshot, m.option_contract, m.stock_daily)
    return rows.select("underlying", "trade_date", "option_ticker", F.unix_micros("snapshot_ts").alias("ts_us"), "iv", "underlying_price", "expiry", "strike", "option_right")


@query("e5_atm_iv_daily", f"with {ATM_ROWS}, {ATM} select *, coalesce((call_iv + put_iv) / 2, call_iv, put_iv) as atm_iv, 'snapshot' as iv_source from atm")
def _(m):
    return oa.atm_iv_daily(oa.atm_iv_rows(m.option_snapshot, m.option_contract, m.stock_daily))


@query(
    "e6_pcr_oi_totals",
    """select underlying, trade_date, cast(sum(case when option_right = 'P' then open_interest else 0 end) as bigint) as put, cast(sum(case
    when option_right = 'C' then open_interest else 0 end) as bigint) as call from option_open_interest group by all""",
)
def _(m):
    return oa.pcr_totals(m.option_open_interest, "open_interest", ["underlying", "trade_date"])


VOLUME = """vol as (select c.underlying, s.ny_date as trade_date, cast(sum(case when c.option_right = 'P' then coalesce(s.day_volume, 0) else 0 end) as bigint) as put_v, cast(sum(case when c.option_right = 'C' then coalesce(s.day_volume, 0) else 0 end) as bigint) as call_v
    from (select * from option_snapshot qualify row_number() over (partition by option_ticker, ny_date order by snapshot_ts desc) = 1) s join option_contract c on c.option_ticker = s.option_ticker group by all)"""


@query("e7_pcr_volume_totals", f"with {VOLUME} select underlying, trade_date, put_v as put, call_v as call from vol")
def _(m):
    return oa.pcr_totals(oa.volume_rows(m.option_snapshot, m.option_contract), "day_volume", ["underlying", "trade_date"])


@query(
    "e8_pcr_daily",
    f"""with {VOLUME}, oi as (select underlying, trade_date, sum(case when option_right = 'P' then open_interest else 0 end) as put, sum(case
        when option_right = 'C' then open_interest else 0 end) as call from option_open_interest group by all),
    sums as (select underlying, trade_date, cast(coalesce(put, 0) as bigint) as total_put_oi, cast(coalesce(call, 0) as bigint) as total_call_oi,
        coalesce(put_v, 0) as total_put_volume, coalesce(call_v, 0) as total_call_volume from oi full join vol using (underlying, trade_date))
    select *, case when total_call_oi > 0 then round(cast(total_put_oi as double) / total_call_oi, 6) end as pcr_oi, case
        when total_call_volume > 0 then round(cast(total_put_volume as double) / total_call_volume, 6) end as pcr_volume
    from sums where total_put_oi + total_call_oi + total_put_volume + total_call_volume > 0""",
)
def _(m):
    return oa.pcr_daily(m.option_open_interest, m.option_snapshot, m.option_contract)


@query("e9_iv_rollup", "select symbol, trade_date, median(atm_iv) as iv from atm_iv group by all")
def _(m):
    return oa.iv_rollup(m.atm_iv)


@query(
    "e10_iv_percentile_daily",
    """with daily as (select symbol, trade_date, median(atm_iv) as iv, row_number() over (partition by symbol order by trade_date) as n from atm_iv
        group by symbol, trade_date)
    select d.symbol, d.trade_date, d.iv as iv_current, round(100.0 * count(*) filter (h.iv <= d.iv) / count(*), 4) as iv_percentile_1y,
        case when max(h.iv) > min(h.iv) then round(100.0 * (d.iv - min(h.iv)) / (max(h.iv) - min(h.iv)), 4) else 50.0 end as iv_rank_1y,
            cast(count(*) as int) as lookback_days
    from daily d join daily h on h.symbol = d.symbol and h.n between d.n - 251 and d.n and h.trade_date >= d.trade_date - 534 group by d.symbol, d.trade_date, d.iv""",
)
def _(m):
    return oa.iv_percentile_daily(oa.iv_rollup(m.atm_iv))


@query(
    "e11_multi_day_max_pain",
    f"""with {PAIN}, {BEST}, days as (select distinct d.trade_date from option_open_interest d where dayofweek(d.trade_date) between 1 and 5
        and not exists (select 1 from us_market_holiday h where h.holiday_date = d.trade_date and h.status = 'closed') order by 1 desc limit 3)
    select best.* from best join days using (trade_date)""",
)
def _(m):
    days = calendar.is_trading_day(m.option_open_interest.select("trade_date").distinct(), m.us_market_holiday, "trade_date").where("is_trading").orderBy(F.desc("trade_date")).limit(3)
    return oa.max_pain_daily(m.option_open_interest.join(days.select("trade_date"), "trade_date", "left_semi"))


EXTRACT = """newest as (select * from option_snapshot where open_interest is not null qualify row_number() over (partition by option_ticker, ny_date order by snapshot_ts desc) = 1)"""


@query(
    "e12_oi_extract",
    f"""with {EXTRACT} select n.option_ticker, n.ny_date as trade_date, c.underlying, c.expiry, c.strike, c.option_right, n.open_interest
    from newest n join option_contract c on c.option_ticker = n.option_ticker""",
)
def _(m):
    # Half of the contracts are withheld: their identity has to come from the ticker.
    return oa.oi_extract(m.option_snapshot, m.option_contract.where("pk % 2 = 0"))


SINCE = "date '2001-10-01' - 120"
TREND = f"""inside as (select underlying, trade_date, option_right, open_interest from held where trade_date >= {SINCE}),
    recent as (select * from option_snapshot where snapshot_ts >= {SINCE} qualify row_number() over (partition by option_ticker, ny_date order by snapshot_ts desc) = 1),
    base as (select * from inside union all select c.underlying, r.ny_date, c.option_right, coalesce(r.open_interest, 0) from recent r join option_contract c
        on c.option_ticker = r.option_ticker where c.underlying not in (select underlying from inside)),
    sums as (select underlying, trade_date, cast(sum(case when option_right = 'P' then open_interest else 0 end) as bigint) as put,
        cast(sum(case when option_right = 'C' then open_interest else 0 end) as bigint) as call from base group by all),
    ratios as (select *, case when call > 0 then round(cast(put as double) / call, 3) end as ratio from sums)
    select *, last_value(ratio) over (partition by underlying order by trade_date rows between unbounded preceding and unbounded following) as latest_ratio from ratios"""


def as_of() -> Column:
    return F.lit("2001-10-01").cast("date")


@query(
    "e13_pcr_trend",
    f"with held as (select * from option_open_interest where underlying <> 'UA' and not (underlying < 'UF' and trade_date >= date '2001-01-01')), {TREND}",
)
def _(m):
    """One underlying without open interest and some whose open interest is stale."""
    held = m.option_open_interest.where("underlying <> 'UA' and not (underlying < 'UF' and trade_date >= date '2001-01-01')")
    return oa.pcr_trend(held, m.option_snapshot, m.option_contract, 120, as_of())


@query("e13_pcr_trend_all", f"with held as (select * from option_open_interest), {TREND}")
def _(m):
    return oa.pcr_trend(m.option_open_interest, m.option_snapshot, m.option_contract, 120, as_of())


@query(
    "e13_pcr_trend_volume",
    f"""with recent as (select * from option_snapshot where snapshot_ts >= {SINCE} qualify row_number() over (partition by option_ticker, ny_date order by snapshot_ts desc) = 1),
    sums as (select c.underlying, r.ny_date as trade_date, cast(sum(case when c.option_right = 'P' then coalesce(r.day_volume, 0) else 0 end) as bigint) as put,
        cast(sum(case when c.option_right = 'C' then coalesce(r.day_volume, 0) else 0 end) as bigint) as call
        from recent r join option_contract c on c.option_ticker = r.option_ticker group by all),
    ratios as (select *, case when call > 0 then round(cast(put as double) / call, 3) end as ratio from sums)
    select *, last_value(ratio) over (partition by underlying order by trade_date rows between unbounded preceding and unbounded following) as latest_ratio from ratios""",
)
def _(m):
    return oa.pcr_volume_trend(m.option_snapshot, m.option_contract, 120, as_of())


SESSIONS = """days as (select distinct s.ny_date as trade_date from option_snapshot s where dayofweek(s.ny_date) between 1 and 5
    and not exists (select 1 from us_market_holiday h where h.holiday_date = s.ny_date and h.status = 'closed') order by 1 desc limit 3)"""


def sessions(m):
    """The last three sessions that have snapshots, column day."""
    held = m.option_snapshot.select(F.col("ny_date").alias("day")).distinct()
    return calendar.is_trading_day(held, m.us_market_holiday, "day").where("is_trading").orderBy(F.desc("day")).limit(3).select("day")


@query(
    "e11_multi_day_atm_iv",
    f"""with {ATM_ROWS}, {ATM}, {SESSIONS} select atm.*, coalesce((call_iv + put_iv) / 2, call_iv, put_iv) as atm_iv, 'snapshot' as iv_source from atm
    join days using (trade_date)""",
)
def _(m):
    return oa.atm_iv_daily(oa.atm_iv_rows(oa.on_days(m.option_snapshot, sessions(m), "ny_date"), m.option_contract, m.stock_daily))


@query(
    "e11_multi_day_pcr",
    f"""with {VOLUME}, {SESSIONS}, oi as (select underlying, trade_date, sum(case when option_right = 'P' then open_interest else 0 end) as put,
        sum(case when option_right = 'C' then open_interest else 0 end) as call from option_open_interest group by all),
    sums as (select underlying, trade_date, cast(coalesce(put, 0) as bigint) as total_put_oi, cast(coalesce(call, 0) as bigint) as total_call_oi,
        coalesce(put_v, 0) as total_put_volume,
        coalesce(call_v, 0) as total_call_volume from oi full join vol using (underlying, trade_date))
    select sums.*, case when total_call_oi > 0 then round(cast(total_put_oi as double) / total_call_oi, 6) end as pcr_oi,
        case when total_call_volume > 0 then round(cast(total_put_volume as double) / total_call_volume, 6) end as pcr_volume
    from sums join days using (trade_date) where total_put_oi + total_call_oi + total_put_volume + total_call_volume > 0""",
)
def _(m):
    days = sessions(m)
    return oa.pcr_daily(oa.on_days(m.option_open_interest, days), oa.on_days(m.option_snapshot, days, "ny_date"), m.option_contract)


IV_RANK = """daily as (select symbol, trade_date, median(atm_iv) as iv, row_number() over (partition by symbol order by trade_date) as n from atm_iv group by symbol, trade_date),
    ranked as (select d.symbol, d.trade_date, d.iv as iv_current, round(100.0 * count(*) filter (h.iv <= d.iv) / count(*), 4) as iv_percentile_1y,
        case when max(h.iv) > min(h.iv) then round(100.0 * (d.iv - min(h.iv)) / (max(h.iv) - min(h.iv)), 4) else 50.0 end as iv_rank_1y,
            cast(count(*) as int) as lookback_days
    from daily d join daily h on h.symbol = d.symbol and h.n between d.n - 251 and d.n and h.trade_date >= d.trade_date - 534 group by d.symbol, d.trade_date, d.iv)"""


@query("e11_multi_day_iv_percentile", f"with {IV_RANK}, {SESSIONS} select ranked.* from ranked join days using (trade_date)")
def _(m):
    return oa.on_days(oa.iv_percentile_daily(oa.iv_rollup(m.atm_iv)), sessions(m))


@query(
    "e18_read_iv_percentile",
    f"""with {IV_RANK} select * from ranked where trade_date between date '2001-06-01' - 30 and date '2001-06-01' order by trade_date desc,
    symbol limit 500""",
)
def _(m):
    return oa.read_daily(oa.iv_percentile_daily(oa.iv_rollup(m.atm_iv)), "symbol", F.lit(dt.date(2001, 6, 1)), 30)


@query(
    "e18_read_pcr",
    f"""with {VOLUME}, oi as (select underlying, trade_date, sum(case when option_right = 'P' then open_interest else 0 end) as put,
        sum(case when option_right = 'C' then open_interest else 0 end) as call from option_open_interest group by all),
    sums as (select underlying, trade_date, cast(coalesce(put, 0) as bigint) as total_put_oi, cast(coalesce(call, 0) as bigint) as total_call_oi,
        coalesce(put_v, 0) as total_put_volume,
        coalesce(call_v, 0) as total_call_volume from oi full join vol using (underlying, trade_date)),
    pcr as (select *, case when total_call_oi > 0 then round(cast(total_put_oi as double) / total_call_oi, 6) end as pcr_oi,
        case when total_call_volume > 0 then round(cast(total_put_volume as double) / total_call_volume, 6) end as pcr_volume
        from sums where total_put_oi + total_call_oi + total_put_volume + total_call_volume > 0)
    select * from pcr qualify trade_date = max(trade_date) over (partition by underlying) order by trade_date desc, underlying limit 500""",
)
def _(m):
    return oa.read_daily(oa.pcr_daily(m.option_open_interest, m.option_snapshot, m.option_contract), "underlying")


CHAIN = "chain as (select * from option_snapshot qualify row_number() over (partition by option_ticker order by snapshot_ts desc) = 1)"


@query(
    "e14_chain_by_expiry",
    f"""with {CHAIN} select c.underlying, c.expiry, cast(sum(case when c.option_right = 'P' then coalesce(s.open_interest, 0)
        else 0 end) as bigint) as put_oi, cast(sum(case when c.option_right = 'C' then coalesce(s.open_interest, 0) else 0 end) as bigint) as call_oi,
        cast(sum(case when c.option_right = 'P' then coalesce(s.day_volume, 0) else 0 end) as bigint) as put_volume, cast(sum(case
            when c.option_right = 'C' then coalesce(s.day_volume, 0) else 0 end) as bigint) as call_volume
    from option_contract c left join chain s on s.option_ticker = c.option_ticker group by c.underlying, c.expiry""",
)
def _(m):
    return oa.chain_by_expiry(m.option_snapshot, m.option_contract)


@query(
    "e14_chain_or_open_interest",
    f"""with {CHAIN}, known as (select * from option_contract where ascii(substr(underlying, 2, 1)) % 2 = 0)
    select c.underlying, c.expiry, cast(sum(case when c.option_right = 'P' then coalesce(s.open_interest, 0) else 0 end) as bigint) as put_oi,
        cast(sum(case when c.option_right = 'C' then coalesce(s.open_interest, 0) else 0 end) as bigint) as call_oi,
        cast(sum(case when c.option_right = 'P' then coalesce(s.day_volume, 0) else 0 end) as bigint) as put_volume,
        cast(sum(case when c.option_right = 'C' then coalesce(s.day_volume, 0) else 0 end) as bigint) as call_volume, max(s.ny_date) as snap_day,
            'option_snapshot' as basis
    from known c left join chain s on s.option_ticker = c.option_ticker group by c.underlying, c.expiry
    union all select underlying, expiry, cast(sum(case when option_right = 'P' then open_interest else 0 end) as bigint), cast(sum(case
        when option_right = 'C' then open_interest else 0 end) as bigint),
        0, 0, date '2001-06-01', 'option_open_interest' from option_open_interest
    where trade_date = date '2001-06-01' and underlying not in (select underlying from known) group by underlying, expiry""",
)
def _(m):
    # Half of the underlyings are withheld: theirs has to come from open interest.
    known = m.option_contract.where(F.ascii(F.substring("underlying", 2, 1)) % 2 == 0)
    return oa.chain_or_open_interest(m.option_snapshot, known, m.option_open_interest, F.lit(dt.date(2001, 6, 1)))


@query("e15_atm_iv_term", "select symbol, trade_date, expiry, atm_iv from atm_iv qualify trade_date = max(trade_date) over (partition by symbol)")
def _(m):
    return oa.newest_dates(m.atm_iv, ["symbol"])


@query(
    "e16_liquidity_summary",
    f"""with {CHAIN}, few as (select * from chain qualify row_number() over (partition by underlying order by option_ticker) <= 50),
    lists as (select underlying, count(*) as contracts, list(open_interest order by open_interest) filter (open_interest is not null) as oi,
        list(day_volume order by day_volume) as vol from few group by underlying)
    select underlying, contracts, cast(len(oi) as int) as oi_count, cast(list_sum(oi) as bigint) as oi_sum,
        oi[1 + cast(round_even((len(oi) - 1) * 0.5, 0) as int)] as oi_p50, oi[1 + cast(round_even((len(oi) - 1) * 0.9, 0) as int)] as oi_p90,
        cast(len(vol) as int) as vol_count, cast(list_sum(vol) as bigint) as vol_sum, vol[1 + cast(round_even((len(vol) - 1) * 0.5, 0) as int)] as vol_p50, vol[1 + cast(round_even((len(vol) - 1) * 0.9, 0) as int)] as vol_p90 from lists""",
)
def _(m):
    return oa.liquidity_summary(m.option_snapshot, 50)


@query(
    "e17_iv_curve",
    f"""with {CHAIN} select c.underlying, c.expiry, c.option_right, c.strike, s.iv, s.option_ticker from chain s join option_contract c
    on c.option_ticker = s.option_ticker where s.iv > 0 and s.iv < 10""",
)
def _(m):
    return oa.iv_curve(m.option_snapshot, m.option_contract)


@query(
    "e18_read_max_pain",
    f"""with {PAIN}, {BEST} select * from best where trade_date between date '2000-06-01' - 60 and date '2000-06-01' order by trade_date desc,
    underlying, expiry limit 500""",
)
def _(m):
    return oa.read_daily(oa.max_pain_daily(m.option_open_interest), "underlying", F.lit(dt.date(2000, 6, 1)), 60)


@query(
    "e18_read_atm_iv",
    """select * from (select symbol, trade_date, expiry, atm_iv from atm_iv qualify trade_date = max(trade_date) over (partition by symbol)) x
    order by trade_date desc, symbol, expiry limit 500""",
)
def _(m):
    return oa.read_daily(m.atm_iv)


@query("d2_chain_latest", f"with {CHAIN} select option_ticker, underlying, epoch_us(snapshot_ts) as ts_us, iv, open_interest, day_volume from chain")
def _(m):
    return latest.chain_latest(m.option_snapshot).select("option_ticker", "underlying", F.unix_micros("snapshot_ts").alias("ts_us"), "iv", "open_interest", "day_volume")


@query(
    "d3_snapshot_with_stock",
    """select s.option_ticker, epoch_us(s.snapshot_ts) as ts_us, s.ny_date, s.iv, d.close as underlying_price from option_snapshot s left
    join stock_daily d on d.symbol = s.underlying and d.bar_date = s.ny_date""",
)
def _(m):
    return oa.with_stock(m.option_snapshot, m.stock_daily).select("option_ticker", F.unix_micros("snapshot_ts").alias("ts_us"), "ny_date", "iv", "underlying_price")


@query(
    "d4_latest_per_day",
    """select option_ticker, ny_date, epoch_us(max(snapshot_ts)) as ts_us, arg_max(day_volume, snapshot_ts) as day_volume from option_snapshot
    group by option_ticker, ny_date""",
)
def _(m):
    return latest.latest_per_day(m.option_snapshot).select("option_ticker", "ny_date", F.unix_micros("snapshot_ts").alias("ts_us"), "day_volume")


@query(
    "d12_near_term_contracts",
    """select option_ticker, underlying, expiry, strike, option_right from option_contract where expiry between date '2004-01-01'
    and date '2004-01-01' + 120 qualify row_number() over (partition by underlying order by expiry, strike, option_right, option_ticker) <= 10""",
)
def _(m):
    return latest.near_term_contracts(m.option_contract, F.lit(dt.date(2004, 1, 1)), 120, 10).select("option_ticker", "underlying", "expiry", "strike", "option_right")


@query(
    "d13_full_outer_merge",
    f"""with {VOLUME}, oi as (select underlying, trade_date, cast(sum(open_interest) as bigint) as oi from option_open_interest group by all)
    select underlying, trade_date, coalesce(oi, 0) as oi, coalesce(put_v + call_v, 0) as volume from oi full join vol using (underlying, trade_date)""",
)
def _(m):
    oi = m.option_open_interest.groupBy("underlying", "trade_date").agg(F.sum("open_interest").alias("oi"))
    volume = oa.volume_rows(m.option_snapshot, m.option_contract).groupBy("underlying", "trade_date").agg(F.sum("day_volume").alias("volume"))
    return oi.join(volume, ["underlying", "trade_date"], "full_outer").select("underlying", "trade_date", F.coalesce("oi", F.lit(0)).cast("long").alias("oi"), F.coalesce("volume", F.lit(0)).cast("long").alias("volume"))
