"""Queries of coverage, quality, fundamentals and the job log."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import calendar, coverage as cov, fundamentals as fun, joblog
from ..sources import sinks
from .bar_queries import OPTION_DAILY, option_daily
from .registry import query

D = lambda y, m, d: F.lit(dt.date(y, m, d))
NOW = "2024-01-30 12:00:00"
T = "timestamp '2024-01-30 12:00:00'"


@query(
    "h1_bar_aggregate",
    """select symbol, count(*) as bar_rows, min(bar_date) as first_date, max(bar_date) as last_date,
    count(*) filter (close is null) as null_close_rows, count(*) filter (volume is null) as null_volume_rows from stock_daily
    where bar_date between date '2001-06-30' - 420 and date '2001-06-30' group by symbol""",
)
def _(m):
    return cov.bar_aggregate(m.stock_daily, D(2001, 6, 30))


@query(
    "b13_readiness_update",
    """select symbol, count(*) as bar_rows, max(bar_date) as last_date, count(*) >= 240 as price_ready from stock_daily
    where bar_date between date '2001-06-30' - 420 and date '2001-06-30' group by symbol""",
)
def _(m):
    return cov.readiness(m.stock_daily, D(2001, 6, 30))


@query("h2_latest_bar_per_symbol", "select symbol, max(bar_date) as bar_date, arg_max(close, bar_date) as close from stock_daily group by symbol")
def _(m):
    return cov.latest_bar_per_symbol(m.stock_daily)


@query(
    "h2_latest_bar_bounded",
    """select symbol, max(bar_date) as bar_date, arg_max(close, bar_date) as close from stock_daily where bar_date >= date '2001-10-01'
    group by symbol""",
)
def _(m):
    return cov.latest_bar_per_symbol(m.stock_daily, D(2001, 10, 1))


@query(
    "h3_financials_coverage_symbols",
    """select symbol, report_type, count(*) filter (period_type = 'quarterly') as quarterly, count(*) filter (period_type = 'annual') as annual
    from stock_financials group by symbol, report_type""",
)
def _(m):
    return fun.coverage_symbols(m.stock_financials)


KEYS = ["short_interest", "avg_daily_volume", "revenue", "eps"]


@query(
    "h4_financials_fill_rate",
    f"""select report_type, k.key as key, count(distinct symbol) filter (coalesce(json_extract_string(data, '$.' || k.key), '') <> '') as symbols
    from stock_financials, (select unnest({KEYS}) as key) k group by report_type, k.key""",
)
def _(m):
    return fun.fill_rate(m.stock_financials, KEYS)


@query(
    "h5_low_coverage_dates",
    """select bar_date, count(distinct symbol) as symbols from stock_daily where bar_date between date '2002-01-01' - 1500 and date '2002-01-01' - 1
    group by bar_date having count(distinct symbol) < 14""",
)
def _(m):
    return cov.low_coverage_dates(m.stock_daily, D(2002, 1, 1), 1500, 14)


@query(
    "h6_financials_symbol_counts",
    """select count(distinct symbol) filter (report_type = 'income_statement') as income_statement,
    count(distinct symbol) filter (report_type = 'balance_sheet') as balance_sheet,
    count(distinct symbol) filter (report_type = 'cash_flow_statement') as cash_flow_statement,
    count(distinct symbol) filter (report_type = 'ratios') as ratios from stock_financials""",
)
def _(m):
    return fun.symbol_counts(m.stock_financials, ["income_statement", "balance_sheet", "cash_flow_statement", "ratios"])


@query(
    "h7_snapshot_coverage",
    """select coalesce(instrument_type, 'UNKNOWN') as instrument_type, count(*) filter (symbol in (select symbol from stock_snapshot
    where session_date = (select max(session_date) from stock_snapshot))) as snapshot_rows, count(*) as universe_rows from ticker group by 1""",
)
def _(m):
    return cov.snapshot_coverage(m.stock_snapshot, m.ticker)


VENDOR_GAP = """b as (select symbol, max(bar_date) as last_bar_date, arg_max(close, bar_date) as last_bar_close from held group by symbol)
    select s.symbol, s.session_date, s.close as snapshot_close, b.last_bar_date, b.last_bar_close, case when b.symbol is null then 'fallback_gap'
        else 'vendor_gap' end as reason
    from snap s left join b using (symbol) where s.session_date = (select max(session_date) from stock_snapshot) and s.close is not null
        and s.symbol in (select symbol from ticker where active and locale = 'us' and market = 'stocks' and lower(instrument_type) = 'cs')
        and (b.symbol is null or (b.last_bar_date < s.session_date and abs(s.close - b.last_bar_close) >= 1e-4))"""


@query(
    "h8_vendor_gap",
    f"""with held as (select * from stock_daily where symbol <> 'UA' and bar_date < (select max(bar_date) from stock_daily)), snap as (select symbol, session_date,
        case when symbol <> 'UE' then close end as close from stock_snapshot), {VENDOR_GAP}""",
)
def _(m):
    """One symbol without bars, one whose snapshots have no close."""
    newest = m.stock_daily.agg(F.max("bar_date").alias("last"))
    held = m.stock_daily.where("symbol <> 'UA'").join(F.broadcast(newest)).where("bar_date < last").drop("last")  # one row
    snap = m.stock_snapshot.withColumn("close", F.when(F.col("symbol") != "UE", F.col("close")))
    return cov.vendor_gap(snap, held, m.ticker).select("symbol", "session_date", "snapshot_close", "last_bar_date", "last_bar_close", "reason")


DAYS = "days as (select day from (select cast(unnest(generate_series(date '2000-01-01', date '2000-06-15', interval 1 day)) as date) as day) x where dayofweek(day) between 1 and 5 and day not in (select holiday_date from us_market_holiday where status = 'closed') order by day desc limit 30)"
DAILY_GAPS = "select count(*) from (select distinct symbol from ticker) t, days d where not exists (select 1 from stock_daily b where b.symbol = t.symbol and b.bar_date = d.day)"
SNAP_GAPS = "select count(*) from (select distinct symbol from ticker where symbol in (select underlying from option_contract)) t where not exists (select 1 from option_snapshot s where s.underlying = t.symbol and s.ny_date = date '2000-06-15')"
OI_GAPS = "select count(*) from (select distinct symbol from ticker where symbol in (select underlying from option_contract)) t, days d where not exists (select 1 from option_open_interest o where o.underlying = t.symbol and o.trade_date = d.day)"
STALE = f"select count(*) from (select unnest(['click', 'view', 'error', 'none']) as dimension) w left join freshness f using (dimension) where f.status is null or f.status <> 'ok' or epoch_us({T}) - epoch_us(f.last_run_at) >= 86400000000"
CHECKS = {
    "stock_daily_coverage": f"((select count(distinct symbol) from stock_daily) > 15 and ({DAILY_GAPS}) = 0) as passed, ({DAILY_GAPS}) as gaps",
    "option_snapshot_coverage": f"(({SNAP_GAPS}) = 0) as passed, ({SNAP_GAPS}) as gaps",
    "option_oi_coverage": f"(({OI_GAPS}) = 0) as passed, ({OI_GAPS}) as gaps",
    "freshness": f"(({STALE}) = 0) as passed, ({STALE}) as gaps",
}


def days30(m):
    return calendar.recent_trading_days(m.spark, m.us_market_holiday, D(2000, 6, 15), 30)


def check(m, name):
    if name == "stock_daily_coverage":
        return cov.stock_daily_check(m.stock_daily, m.ticker, days30(m), 15)
    if name == "option_snapshot_coverage":
        return cov.option_snapshot_check(m.ticker, m.option_contract, m.option_snapshot, D(2000, 6, 15))
    if name == "option_oi_coverage":
        return cov.option_oi_check(m.ticker, m.option_contract, m.option_open_interest, days30(m))
    return cov.freshness_check(m.freshness, ["click", "view", "error", "none"], F.lit(NOW).cast("timestamp_ntz"))


for _id, _name in (("h9", "stock_daily_coverage"), ("h10", "option_snapshot_coverage"), ("h11", "option_oi_coverage"), ("h12", "freshness")):
    query(f"{_id}_{_name}_check", f"with {DAYS} select '{_name}' as \"check\", {CHECKS[_name]}")(lambda m, n=_name: check(m, n))


@query(
    "h13_quality_report",
    f"with {DAYS}, c as (" + " union all ".join(f"select '{n}' as \"check\", {s}" for n, s in CHECKS.items()) + ") select * from c union all select 'all', bool_and(passed), cast(sum(gaps) as bigint) from c",
)
def _(m):
    return cov.quality_report(*(check(m, n) for n in CHECKS))


TABLES = {"stock_daily": ("symbol", "bar_date"), "option_snapshot": ("underlying", "ny_date"), "option_open_interest": ("underlying", "trade_date"), "atm_iv": ("symbol", "trade_date"), "stock_financials": ("symbol", "period_date")}


@query("h14_inventory", " union all ".join(f"select '{n}' as name, count(distinct {k}) as symbols, count(*) as n_rows, min({d}) as first_day, max({d}) as last_day from {n}" for n, (k, d) in TABLES.items()))
def _(m):
    return cov.inventory({n: (getattr(m, n), k, d) for n, (k, d) in TABLES.items()})


@query(
    "h15_db_summary",
    """select 'corporate_action' as name, count(distinct symbol) as symbols, count(*) as n_rows, min(ex_date) as first_day, max(ex_date) as last_day
    from corporate_action union all select 'job_log', count(distinct kind), count(*), min(cast(created_at as date)), max(cast(created_at as date))
    from job_log""",
)
def _(m):
    return cov.inventory({"corporate_action": (m.corporate_action, "symbol", "ex_date"), "job_log": (m.job_log, "kind", "created_at")})


@query(
    "h16_distributions",
    """select sector as value, count(*) as n from ticker where trim(coalesce(sector, '')) <> '' group by sector order by n desc, value limit 10""",
)
def _(m):
    return cov.distributions(m.ticker, "sector", 10)


@query("h16_rows_per_symbol", "select symbol as value, count(*) as n from stock_daily group by symbol order by n desc, value limit 12")
def _(m):
    return cov.distributions(m.stock_daily, "symbol", 12)


@query(
    "h17_watchlist_coverage",
    "select w.symbol, coalesce(c.contracts, 0) as contracts, coalesce(c.expiries, 0) as expiries, s.newest from (select symbol from ticker union select 'ZZZ') w left join (select underlying, count(*) as contracts, count(distinct expiry) as expiries from option_contract group by underlying) c on c.underlying = w.symbol left join (select underlying, max(ny_date) as newest from option_snapshot group by underlying) s on s.underlying = w.symbol",
)
def _(m):
    return cov.watchlist_coverage(m.ticker.select("symbol").union(m.spark.createDataFrame([("ZZZ",)], "symbol string")), m.option_contract, m.option_snapshot)


@query(
    "h18_greeks_coverage",
    """select underlying, count(*) as contracts, count(iv) as with_iv, count(delta) as with_delta, count(*) filter (delta is not null
    and gamma is not null and theta is not null and vega is not null) as full_greeks from (select * from option_snapshot
    qualify row_number() over (partition by option_ticker order by snapshot_ts desc) = 1) x group by underlying""",
)
def _(m):
    return cov.greeks_coverage(m.option_snapshot)


@query(
    "h19_contracts_coverage",
    """select underlying, count(*) as contracts, count(distinct expiry) as expiries, count(distinct strike) as strikes, min(expiry) as first_expiry,
    max(expiry) as last_expiry from option_contract group by underlying""",
)
def _(m):
    return cov.contracts_coverage(m.option_contract)


@query("h20_contract_reference_gap", "select option_ticker from option_contract where pk % 11 = 0 or pk % 13 = 0")
def _(m):
    broken = m.option_contract.withColumns({"strike": F.when(F.col("pk") % 11 != 0, F.col("strike")), "underlying": F.when(F.col("pk") % 13 == 0, "  ").otherwise(F.col("underlying"))})
    return cov.contract_reference_gap(broken).select("option_ticker")


@query(
    "h21_snapshot_contract_gap",
    """select option_ticker from option_contract where option_ticker not in (select option_ticker from option_snapshot
    where ny_date >= date '2001-09-01')""",
)
def _(m):
    return cov.contracts_without(m.option_contract, m.option_snapshot, D(2001, 9, 1), "ny_date").select("option_ticker")


@query(
    "h21_bar_contract_gap",
    f"""with {OPTION_DAILY} select option_ticker from option_contract where option_ticker not in (select option_ticker from ob
    where bar_date >= date '2001-10-15')""",
)
def _(m):
    return cov.contracts_without(m.option_contract, option_daily(m), D(2001, 10, 15), "bar_date").select("option_ticker")


@query(
    "h22_bar_quality_detail",
    """select symbol, bar_date, open is not null and high is not null and low is not null and close is not null as ohlc_complete from stock_daily
    where bar_date >= date '2001-01-01'""",
)
def _(m):
    return cov.bar_quality_detail(m.stock_daily, D(2001, 1, 1))


@query(
    "h23_snapshot_quality_daily",
    """select ny_date, count(*) as contracts, round(100.0 * count(iv) / count(*), 1) as iv_pct, round(100.0 * count(*) filter (delta is not null
        and gamma is not null and theta is not null and vega is not null) / count(*), 1) as greeks_pct, round(100.0 * count(open_interest) / count(*),
        1) as oi_pct
    from (select * from option_snapshot qualify row_number() over (partition by option_ticker, ny_date order by snapshot_ts desc) = 1) x group by ny_date""",
)
def _(m):
    return cov.snapshot_quality_daily(m.option_snapshot)


@query(
    "h24_stock_day_gap",
    """select t.symbol, d.day from (select distinct symbol from ticker) t, (select day from (select cast(unnest(generate_series(date '2000-01-01',
    date '2000-12-31', interval 1 day)) as date) as day) x where dayofweek(day) between 1 and 5 and day not in (select holiday_date
    from us_market_holiday where status = 'closed')) d where not exists (select 1 from stock_daily b where b.symbol = t.symbol and b.bar_date = d.day)""",
)
def _(m):
    days = calendar.expected_trading_days(m.spark, m.us_market_holiday, D(2000, 1, 1), D(2000, 12, 31))
    return cov.holes(m.ticker, days, m.stock_daily.select("symbol", F.col("bar_date").alias("day")))


FILLED = "trim(coalesce(name, '')) <> '' and trim(coalesce(sector, '')) <> '' and trim(coalesce(industry, '')) <> '' and market_cap is not null"


@query("h25_overview_coverage", f"select count(*) as total, count(*) filter ({FILLED}) as filled, count(*) filter (not ({FILLED})) as missing from ticker")
def _(m):
    return cov.overview_coverage(m.ticker)


@query("h25_missing_overview", f"select symbol from ticker where not ({FILLED}) order by symbol limit 5 offset 2")
def _(m):
    return cov.missing_overview(m.ticker, 5, 2)


@query(
    "h26_related_coverage",
    """select count(*) as total, count(*) filter (symbol in (select from_symbol from ticker_related)) as filled,
    count(*) filter (symbol not in (select from_symbol from ticker_related)) as missing from ticker""",
)
def _(m):
    return cov.related_coverage(m.ticker, m.ticker_related)


@query("h26_missing_related", "select symbol from ticker where symbol not in (select from_symbol from ticker_related) order by symbol limit 3 offset 1")
def _(m):
    return cov.missing_related(m.ticker, m.ticker_related, 3, 1)


@query("h26_filled_related", "select distinct from_symbol as symbol from ticker_related")
def _(m):
    return m.ticker_related.select(F.col("from_symbol").alias("symbol")).distinct()


@query(
    "h27_daily_checklist",
    "select t.symbol, (select count(*) from stock_daily b where b.symbol = t.symbol and b.bar_date = date '2000-03-01') as daily, (select count(*) from option_open_interest o where o.underlying = t.symbol and o.trade_date = date '2000-03-01') as oi, (select count(*) from corporate_action a where a.symbol = t.symbol and a.ex_date = date '2000-03-01') as actions from ticker t",
)
def _(m):
    return cov.daily_checklist(m.ticker, D(2000, 3, 1), m.stock_daily, m.option_open_interest, m.corporate_action)


FIN = "symbol, report_type, period_date, period_type, data"


@query(
    "h28_financials_batch",
    f"""select {FIN} from stock_financials where report_type = 'balance_sheet' and period_type = 'quarterly'
    qualify row_number() over (partition by symbol order by period_date desc, period_type, report_type) <= 8""",
)
def _(m):
    return fun.newest_rows(m.stock_financials, "balance_sheet", 8, "quarterly").select(*FIN.split(", "))


@query(
    "h28_financials_ext",
    f"""select {FIN} from stock_financials where report_type = 'cash_flow_statement' qualify row_number() over (partition by symbol
    order by period_date desc, period_type, report_type) <= 5""",
)
def _(m):
    return fun.newest_rows(m.stock_financials, "cash_flow", 5).select(*FIN.split(", "))


@query(
    "h29_income_rows",
    """select symbol, period_date, period_type, cast(fiscal_year as int) as fiscal_year, cast(fiscal_quarter as int) as fiscal_quarter
    from stock_financials where report_type = 'income_statement' and period_type in ('quarterly', 'annual')""",
)
def _(m):
    return fun.income_rows(m.stock_financials).select("symbol", "period_date", "period_type", "fiscal_year", "fiscal_quarter")


@query(
    "h30_ratios_latest",
    f"""select {FIN} from stock_financials where report_type = 'ratios' qualify row_number() over (partition by symbol order by period_date desc,
    period_type desc) = 1""",
)
def _(m):
    return fun.ratios_latest(m.stock_financials).select(*FIN.split(", "))


@query(
    "h31_short_interest_latest",
    f"""select {FIN} from stock_financials where report_type = 'short_interest' qualify row_number() over (partition by symbol
    order by period_date desc, period_type) <= 2""",
)
def _(m):
    return fun.newest_rows(m.stock_financials, "short_interest", 2).select(*FIN.split(", "))


@query(
    "h32_short_interest_fields",
    """with f as (select *, cast(json_extract_string(data, '$.short_interest') as bigint) as short_interest, cast(json_extract_string(data,
        '$.avg_daily_volume') as bigint) as avg_daily_volume from stock_financials where report_type = 'short_interest'
        qualify row_number() over (partition by symbol order by period_date desc, period_type) <= 10)
    select symbol, period_date, period_type, short_interest, avg_daily_volume, round(cast(short_interest as double) / nullif(avg_daily_volume, 0), 4) as days_to_cover from f""",
)
def _(m):
    return fun.short_interest_fields(m.stock_financials, 10)


@query("h33_financials_generic", f"select {FIN} from stock_financials where symbol = 'UA' and report_type = 'income_statement' and period_type = 'annual'")
def _(m):
    return fun.generic(m.stock_financials, "UA", "income", "annual").select(*FIN.split(", "))


@query(
    "h34_fundamentals_gaps",
    """with held as (select * from stock_financials where period_date < date '1996-01-15'),
    n as (select symbol, report_type, count(*) filter (period_type = 'quarterly') as q, count(*) filter (period_type = 'annual') as a,
        max(period_date) as last from held group by all),
    g as (select u.symbol, t.report_type, coalesce(q, 0) as q, coalesce(a, 0) as a, last from ticker u cross join (select unnest(['income_statement',
        'balance_sheet', 'cash_flow_statement', 'ratios', 'short_interest']) as report_type) t left join n on n.symbol = u.symbol
        and n.report_type = t.report_type)
    select symbol, report_type from g where case report_type when 'income_statement' then q < 5 or a < 4 when 'balance_sheet' then q < 4 when 'cash_flow_statement' then q < 4 else last is null or last < date '1996-01-15' - 45 end""",
)
def _(m):
    types = ("income_statement", "balance_sheet", "cash_flow_statement", "ratios", "short_interest")
    return fun.gaps(m.ticker, m.stock_financials.where(F.col("period_date") < D(1996, 1, 15)), D(1996, 1, 15), types)


@query(
    "h34_fundamentals_gaps_all",
    """with reports as (select symbol, report_type, period_date, period_type from stock_financials union all select symbol, report_type, period_date,
        period_type from short_volume_reports),
    n as (select symbol, report_type, count(*) filter (period_type = 'quarterly') as q, count(*) filter (period_type = 'annual') as a, count(*) as n,
        max(period_date) as last
        from reports group by all),
    u as (select symbol from ticker union select 'ZZZ'),
    g as (select u.symbol, t.report_type, coalesce(q, 0) as q, coalesce(a, 0) as a, coalesce(n, 0) as n, last
        from u cross join (select unnest(['income_statement', 'balance_sheet', 'cash_flow_statement', 'ratios', 'short_interest',
            'short_volume']) as report_type) t
        left join n on n.symbol = u.symbol and n.report_type = t.report_type)
    select symbol, report_type from g where case report_type when 'income_statement' then q < 5 or a < 4 when 'balance_sheet' then q < 4
        when 'cash_flow_statement' then q < 4
        when 'short_volume' then n < 5 or last < date '2001-11-20' - 14 else last is null or last < date '2001-11-20' - 45 end or (report_type = 'short_volume' and last is null)""",
)
def _(m):
    columns = ["symbol", "report_type", "period_date", "period_type"]
    reports = m.stock_financials.select(*columns).union(m.short_volume_reports.select(*columns))
    return fun.gaps(m.ticker.select("symbol").union(m.spark.createDataFrame([("ZZZ",)], "symbol string")), reports, D(2001, 11, 20))


@query(
    "h31_short_volume_recent",
    """select symbol, period_date as trade_date, data from short_volume_reports qualify row_number() over (partition by symbol
    order by period_date desc) <= 10""",
)
def _(m):
    return fun.short_volume_recent(m.short_volume_reports, 10)


@query(
    "h32_short_volume_fields",
    """select symbol, period_date as trade_date, cast(json_extract_string(data, '$.short_volume') as bigint) as short_volume,
        cast(json_extract_string(data, '$.short_volume_ratio') as double) as short_volume_ratio, cast(json_extract_string(data,
            '$.total_volume') as bigint) as total_volume
    from short_volume_reports qualify row_number() over (partition by symbol order by period_date desc) <= 20""",
)
def _(m):
    return fun.short_volume_fields(m.short_volume_reports, 20)


@query(
    "b13_readiness_update_table",
    """with found as (select symbol, count(*) as bar_rows, max(bar_date) as last_date, count(*) >= 240 as price_ready from stock_daily
        where bar_date between date '2001-06-30' - 420 and date '2001-06-30' group by symbol)
    select t.symbol, case when f.symbol is not null then f.bar_rows else -1 end as bar_rows, f.last_date, coalesce(f.price_ready,
        false) as price_ready, t.name as note
    from (select symbol, name from ticker union all select 'ZZZ', 'not traded') t left join found f on f.symbol = t.symbol""",
)
def _(m):
    held = m.ticker.select("symbol", "name").union(m.spark.createDataFrame([("ZZZ", "not traded")], "symbol string, name string"))
    old = [F.lit(-1).cast("long").alias("bar_rows"), F.lit(None).cast("date").alias("last_date"), F.lit(False).alias("price_ready"), F.col("name").alias("note")]
    return sinks.readiness_update(held.select("symbol", *old), cov.readiness(m.stock_daily, D(2001, 6, 30)), ["symbol"])


@query(
    "h9_gap_sample",
    f"with {DAYS} select t.symbol, d.day from (select distinct symbol from ticker) t, days d where not exists (select 1 from stock_daily b where b.symbol = t.symbol and b.bar_date = d.day) "
    "order by d.day, t.symbol limit 50",
)
def _(m):
    return cov.gap_sample(m.ticker, days30(m), m.stock_daily.select("symbol", F.col("bar_date").alias("day")), 50)


@query(
    "h24_stock_day_gap_counts",
    """with days as (select day from (select cast(unnest(generate_series(date '2000-01-01', date '2000-12-31', interval 1 day)) as date) as day) x
        where dayofweek(day) between 1 and 5 and day not in (select holiday_date from us_market_holiday where status = 'closed')),
    g as (select t.symbol, d.day, exists (select 1 from stock_daily b where b.symbol = t.symbol and b.bar_date = d.day) as have
        from (select distinct symbol from ticker) t, days d)
    select symbol, count(*) as expected_days, count(*) filter (have) as covered_days, count(*) filter (not have) as missing_days,
        coalesce(array_to_string((list(day order by day) filter (not have))[1:120], ' '), '') as missing_dates from g group by symbol""",
)
def _(m):
    days = calendar.expected_trading_days(m.spark, m.us_market_holiday, D(2000, 1, 1), D(2000, 12, 31))
    gaps = cov.day_gaps(m.ticker, days, m.stock_daily, 120)
    return gaps.withColumn("missing_dates", F.array_join(F.col("missing_dates").cast("array<string>"), " "))


@query(
    "h22_bar_quality_summary",
    """select symbol, count(*) as row_count, min(bar_date) as min_date, max(bar_date) as max_date,
        count(*) filter (bar_date >= date '2001-01-01') as recent_rows,
        count(*) filter (bar_date >= date '2001-01-01' and open is not null and high is not null and low is not null and close is not null) as recent_whole from stock_daily group by symbol""",
)
def _(m):
    return cov.bar_quality_summary(m.stock_daily, D(2001, 1, 1))


STATS = {"stock_daily": "bar_date", "stock_financials": "period_date", "corporate_action": "ex_date", "stock_snapshot": "session_date"}


@query("h15_sepa_stats", " union all ".join(f"select '{n}' as name, count(*) as row_count, max({d}) as latest from {n}" for n, d in STATS.items()))
def _(m):
    return cov.table_stats({n: (getattr(m, n), d) for n, d in STATS.items()})


@query(
    "h15_status_summary",
    """select dimension, epoch_us(last_run_at) as ran_us, status, rows_written from freshness order by last_run_at desc nulls last,
    dimension limit 20""",
)
def _(m):
    return cov.status_summary(m.freshness).select("dimension", F.unix_micros(F.col("last_run_at").cast("timestamp")).alias("ran_us"), "status", "rows_written")


@query(
    "h27_daily_checklist_freshness",
    """with c as (select t.symbol, (select count(*) from stock_daily b where b.symbol = t.symbol and b.bar_date = date '2000-03-01') as daily,
        (select count(*) from option_open_interest o where o.underlying = t.symbol and o.trade_date = date '2000-03-01') as oi,
        (select count(*) from corporate_action a where a.symbol = t.symbol and a.ex_date = date '2000-03-01') as actions from ticker t),
    l as (select symbol, 'daily' as source, 'click' as dimension, daily as n from c union all select symbol, 'oi', 'error', oi from c union all
        select symbol, 'actions', 'none', actions from c)
    select l.symbol, l.source, l.dimension, l.n, f.status, f.rows_written from l left join freshness f using (dimension)""",
)
def _(m):
    checklist = cov.daily_checklist(m.ticker, D(2000, 3, 1), m.stock_daily, m.option_open_interest, m.corporate_action)
    return cov.checklist_with_freshness(checklist, m.freshness, {"daily": "click", "oi": "error", "actions": "none"})


@query(
    "h8_vendor_gap_all",
    f"with held as (select * from stock_daily where bar_date < (select max(bar_date) from stock_daily)), snap as (select * from stock_snapshot), {VENDOR_GAP}",
)
def _(m):
    newest = m.stock_daily.agg(F.max("bar_date").alias("last"))
    held = m.stock_daily.join(F.broadcast(newest)).where("bar_date < last").drop("last")  # one row
    return cov.vendor_gap(m.stock_snapshot, held, m.ticker).select("symbol", "session_date", "snapshot_close", "last_bar_date", "last_bar_close", "reason")


@query(
    "i1_queue_composition",
    """select kind, count(*) filter (status = 'pending') as pending, count(*) filter (status = 'running') as running, count(*) as total from job_log
    group by kind""",
)
def _(m):
    return joblog.queue_composition(m.job_log)


COUNTS = ", ".join(f"count(*) filter (status = '{s}' and finished_at between {T} - interval {n} minute and {T}) as {s}_{n}" for n in (5, 15, 60) for s in ("done", "failed"))


@query("i2_throughput", f"with c as (select count(*) filter (status = 'pending') as pending, {COUNTS} from job_log) select *, round((done_60 + failed_60) / 60.0, 4) as per_minute, round(pending / nullif((done_60 + failed_60) / 60.0, 0), 2) as eta_minutes from c".replace("/ 60.0", "/ cast(60 as double)"))
def _(m):
    return joblog.throughput(m.job_log, F.lit(NOW).cast("timestamp_ntz"))


@query("i3_oldest_pending_age", f"select (epoch_us({T}) - min(epoch_us(created_at)) filter (status = 'pending')) / 1e6 as age_sec from job_log")
def _(m):
    return joblog.oldest_pending_age(m.job_log, F.lit(NOW).cast("timestamp_ntz"))


@query(
    "i4_slot_adherence",
    f"""with f as (select 'slot' || cast(event_id % 5 as varchar) as slot, event_type as kind, ts + interval 1 minute as fire from events),
    n as (select f.slot, f.kind, f.fire, count(j.id) as jobs from f left join job_log j on j.kind = f.kind and j.created_at >= f.fire
        and j.created_at < least({T}, f.fire + interval 10 minute + interval 2 hour) group by all)
    select slot, kind, epoch_us(fire) as fire_us, jobs, case when jobs > 0 then 'on_plan' when {T} < fire + interval 10 minute then 'due' else 'missed' end as state from n""",
)
def _(m):
    fires = m.events.select(F.concat(F.lit("slot"), (F.col("event_id") % 5).cast("string")).alias("slot"), F.col("event_type").alias("kind"), (F.col("ts") + F.expr("interval 1 minute")).alias("fire"))
    return joblog.slot_adherence(fires, m.job_log, F.lit(NOW).cast("timestamp_ntz"), 10).select("slot", "kind", F.unix_micros(F.col("fire").cast("timestamp")).alias("fire_us"), "jobs", "state")


@query(
    "i4_slot_adherence_all",
    f"""with f as (select 'slot' || cast(event_id % 5 as varchar) as slot, event_type as kind, ts + interval 1 minute as fire from events),
    n as (select f.slot, f.kind, f.fire, count(j.id) as jobs from f left join job_log j on j.kind = f.kind and j.created_at >= f.fire
        and j.created_at < least({T}, f.fire + interval 30 minute + interval 2 hour) group by all)
    select slot, kind, epoch_us(fire) as fire_us, jobs, case when jobs > 0 then 'on_plan' when {T} < fire + interval 30 minute then 'due' else 'missed' end as state from n""",
)
def _(m):
    fires = m.events.select(F.concat(F.lit("slot"), (F.col("event_id") % 5).cast("string")).alias("slot"), F.col("event_type").alias("kind"), (F.col("ts") + F.expr("interval 1 minute")).alias("fire"))
    return joblog.slot_adherence(fires, m.job_log, F.lit(NOW).cast("timestamp_ntz"), 30).select("slot", "kind", F.unix_micros(F.col("fire").cast("timestamp")).alias("fire_us"), "jobs", "state")


@query(
    "i5_job_list",
    """select id, kind, status from job_log where status = 'failed' qualify row_number() over (partition by kind order by created_at desc,
    id desc) <= 25""",
)
def _(m):
    return joblog.job_list(m.job_log, "failed", 25).select("id", "kind", "status")
