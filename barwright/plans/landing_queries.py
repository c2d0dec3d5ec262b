"""Queries of the landing decoders and the sinks. Pages are made from the market views, decoded again, and compared with the views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import landing, scratch, sinks
from .registry import query

D = lambda y, m, d: F.lit(dt.date(y, m, d))


def soiled(payload: Column) -> Column:
    """A page as vendors send it at times: with elements that are no objects, numbers in text, and whole numbers with a decimal point."""
    text = F.regexp_replace(payload, r'"(o|c|v|strike_price|implied_volatility|market_cap|split_from|cash_amount|todaysChange)":(-?[0-9.E+-]+)', '"$1":"$2"')
    text = F.regexp_replace(text, r'"(t|n|open_interest|sip_timestamp|last_updated)":([0-9]+)([,}])', '"$1":$2.0$3')
    return F.regexp_replace(text, r"\]\}$", ',5,"odd",null,[1,{"t":1}],true]}')


def pages(rows: DataFrame, keys: list[str], item: Column, order: str, field: str = "results") -> DataFrame:
    """One JSON page per key with the items in order, every other one soiled; a page is a symbol's year or less."""
    by_key = lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1).otherwise(0)  # noqa: E731  items may hold maps, which have no order
    listed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), item.alias("i"))), by_key)
    return rows.groupBy(*keys).agg(F.transform(listed, lambda x: x["i"]).alias(field)).select(*keys, F.to_json(F.struct(field)).alias("payload")).withColumn("payload", F.when(F.crc32(F.col("payload").cast("binary")) % 2 == 0, soiled(F.col("payload"))).otherwise(F.col("payload")))


def bar_item(ms: Column, symbol: bool = False, volume: str = "volume") -> Column:
    cols = [ms.alias("t"), F.col("open").alias("o"), F.col("high").alias("h"), F.col("low").alias("l"), F.col("close").alias("c"), F.col(volume).alias("v")]
    return F.struct(*cols, *([F.col("symbol").alias("T")] if symbol else []))


def day_ms(c: str) -> Column:
    return F.unix_date(c).cast("long") * 86400000 + 18000000


OHLCV = "open, high, low, close, volume"


def landed(m, rows: DataFrame, context: str) -> DataFrame:
    """Pages written as JSON documents, one a line, in a folder for each value of a context column, and read again."""
    path = scratch.new_folder(m.spark, "landed")
    rows.select(context, "payload").repartition(context).write.partitionBy(context).text(path)
    return landing.read_pages(m.spark, path, f"{context} string")


@query("a1_landed_stock_daily", f"select symbol, bar_date, {OHLCV} from stock_daily")
def _(m):
    p = pages(m.stock_daily.withColumn("year", F.year("bar_date")), ["symbol", "year"], bar_item(day_ms("bar_date")), "bar_date")
    return landing.stock_daily(landed(m, p, "symbol")).select("symbol", "bar_date", *OHLCV.split(", "))


@query("a10_landed_option_expiration", "select distinct underlying, expiry from option_contract")
def _(m):
    item = F.struct(F.struct(F.col("option_ticker").alias("ticker")).alias("details"), F.struct(F.col("underlying").alias("ticker")).alias("underlying_asset"))
    p = pages(m.option_contract, ["underlying"], item, "option_ticker")
    return landing.option_expirations(landed(m, p, "underlying").select("payload", F.lit(dt.datetime(2024, 1, 2)).alias("fetched_at")))


@query("a1_ingest_stock_daily", f"select symbol, bar_date, {OHLCV} from stock_daily where day(bar_date) <> 13")
def _(m):
    t = F.when(F.day("bar_date") != 13, day_ms("bar_date"))
    p = pages(m.stock_daily.withColumn("year", F.year("bar_date")), ["symbol", "year"], bar_item(t), "bar_date").withColumn("symbol", F.concat(F.lit(" "), F.lower("symbol")))
    return landing.stock_daily(p).select("symbol", "bar_date", *OHLCV.split(", "))


MINUTE = "select symbol, '1 minute' as period, epoch_us(bar_time) as t, open, high, low, close, cast(volume as bigint) as volume from stock_minute"


@query("a2_ingest_stock_minute", MINUTE)
def _(m):
    p = pages(m.stock_minute.withColumn("d", F.to_date("bar_time")), ["symbol", "d"], bar_item(F.unix_millis(F.col("bar_time").cast("timestamp"))), "bar_time").withColumns({"multiplier": F.lit(1), "timespan": F.lit("Minute")})
    return landing.stock_minute(p).select("symbol", "period", F.unix_micros("bar_time").alias("t"), *OHLCV.split(", "))


@query("a3_ingest_grouped_daily", f"select symbol, bar_date, {OHLCV} from stock_daily")
def _(m):
    p = pages(m.stock_daily.withColumn("d", F.col("bar_date")), ["d"], bar_item(day_ms("bar_date"), symbol=True), "symbol")
    return landing.grouped_daily(p).select("symbol", "bar_date", *OHLCV.split(", "))


def option_rows(m) -> DataFrame:
    rows = m.option_snapshot.groupBy("option_ticker", "ny_date").agg(F.min("iv").alias("low"), F.max("iv").alias("high"), F.max("day_volume").alias("volume"))
    return rows.withColumns({"open": F.col("low"), "close": F.col("high"), "year": F.year("ny_date")})


OPTION = "o as (select option_ticker, ny_date, min(iv) as low, max(iv) as high, cast(max(day_volume) as bigint) as volume from option_snapshot group by all)"


@query(
    "a4_ingest_option_daily",
    f"""with {OPTION} select o.option_ticker, o.ny_date as bar_date, c.underlying, c.expiry, c.strike, c.option_right, o.low, o.high, o.volume from o
    join option_contract c on c.option_ticker = o.option_ticker""",
)
def _(m):
    p = pages(option_rows(m), ["option_ticker", "year"], bar_item(day_ms("ny_date")), "ny_date")
    bad = m.spark.createDataFrame([("O:BAD", 2000, '{"results":[{"t":1,"o":1.0}]}')], "option_ticker string, year int, payload string")
    return landing.option_daily(p.union(bad)).select("option_ticker", "bar_date", "underlying", "expiry", "strike", "option_right", "low", "high", "volume")


@query(
    "a5_ingest_option_minute",
    f"""with {OPTION} select option_ticker, '5 minute' as period, epoch_us(cast(ny_date as timestamp)) + 18000000000 as t, low, high, volume from o""",
)
def _(m):
    p = pages(option_rows(m), ["option_ticker", "year"], bar_item(day_ms("ny_date")), "ny_date").withColumns({"multiplier": F.lit(5), "timespan": F.lit("MINUTE")})
    return landing.option_minute(p).select("option_ticker", "period", F.unix_micros("bar_time").alias("t"), "low", "high", "volume")


def ticker_item(long: Column) -> Column:
    """A vendor snapshot with short field names, or long ones where asked."""
    names = (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"), ("v", "volume"))
    bag = F.map_from_arrays(F.when(long, F.array(*(F.lit(b) for _, b in names))).otherwise(F.array(*(F.lit(a) for a, _ in names))), F.array(*(F.col(b).cast("double") for _, b in names)))
    return F.struct(F.col("symbol").alias("ticker"), bag.alias("day"), F.create_map(F.lit("c"), F.col("prev_close")).alias("prevDay"), F.col("change").alias("todaysChange"), F.col("change_pct").alias("todaysChangePerc"))


@query(
    "a6_ingest_stock_snapshot",
    """select symbol, session_date, open, high, low, close, volume, prev_close, change, change_pct from stock_snapshot where prev_close is not null""",
)
def _(m):
    rows = m.stock_snapshot.where("prev_close is not null")
    item = ticker_item(F.day("session_date") % 2 == 0)
    many = pages(rows.where("symbol <> 'UA'"), ["session_date"], item, "symbol", "tickers")
    one = rows.where("symbol = 'UA'").select("session_date", F.to_json(F.struct(item.alias("ticker"))).alias("payload"))
    return landing.stock_snapshot(many.unionByName(one)).select("symbol", "session_date", "open", "high", "low", "close", "volume", "prev_close", "change", "change_pct")


@query(
    "a7_ingest_stock_movers",
    """select d.direction, symbol, session_date, change_pct, close as price, volume from stock_snapshot, (select unnest(['gainers',
    'losers']) as direction) d where prev_close is not null""",
)
def _(m):
    p = pages(m.stock_snapshot.where("prev_close is not null"), ["session_date"], ticker_item(F.lit(False)), "symbol", "tickers").withColumn("direction", F.lit("gainers, LOSERS,gainers,up"))
    return landing.stock_movers(p).select("direction", "symbol", "session_date", "change_pct", "price", "volume")


def chain_pages(m) -> DataFrame:
    """Chain pages per underlying and day: some without details, some with the IV among the Greeks, some with nanoseconds."""
    c = m.option_contract.select("option_ticker", "expiry", "strike", "option_right", "pk")
    rows = m.option_snapshot.join(c, "option_ticker")
    us = F.unix_micros("snapshot_ts")
    bare, ns = F.col("pk") % 4 == 0, F.col("pk") % 3 == 0
    details = F.when(~bare, F.struct(F.col("option_ticker").alias("ticker"), F.col("expiry").cast("string").alias("expiration_date"), F.col("strike").alias("strike_price"), F.when(F.col("option_right") == "C", "call").otherwise("put").alias("contract_type"), F.lit("american").alias("exercise_style")))
    greeks = F.struct("delta", "gamma", "theta", "vega", F.when(bare, F.col("iv")).alias("implied_volatility"))
    item = F.struct(
        F.col("option_ticker").alias("ticker"), details.alias("details"), greeks.alias("greeks"), F.when(~bare, F.col("iv")).alias("implied_volatility"), "open_interest", F.struct(F.col("day_volume").alias("volume"), F.when(~ns, us / 1000).cast("bigint").alias("last_updated")).alias("day"),
        F.struct(F.when(ns, us * 1000).alias("sip_timestamp")).alias("last_trade"), F.struct(F.col("underlying").alias("ticker")).alias("underlying_asset"), F.col("snapshot_ts").cast("string").alias("k"),
    )
    return pages(rows, ["underlying", "ny_date"], item, "option_ticker").select(F.col("ny_date").alias("trade_date"), F.lit(dt.datetime(2024, 1, 1)).alias("fetched_at"), "payload")


@query("a8_ingest_option_snapshot", "select option_ticker, epoch_us(snapshot_ts) as t, underlying, iv, delta, gamma, theta + 0.0 as theta, vega, open_interest, day_volume from option_snapshot".replace("open_interest", "cast(open_interest as bigint) as open_interest"))
def _(m):
    return landing.option_snapshots(chain_pages(m)).select("option_ticker", F.unix_micros("snapshot_ts").alias("t"), "underlying", "iv", "delta", "gamma", (F.col("theta") + 0.0).alias("theta"), "vega", "open_interest", "day_volume")


@query(
    "a8_ingest_snapshot_contracts",
    """select option_ticker, underlying, expiry, strike, option_right, shares_per_contract from option_contract
    where option_ticker in (select option_ticker from option_snapshot)""",
)
def _(m):
    return landing.option_contracts(chain_pages(m)).select("option_ticker", "underlying", "expiry", "strike", "option_right", "shares_per_contract")


@query("a9_ingest_option_contract", "select option_ticker, underlying, expiry, strike, option_right, shares_per_contract from option_contract")
def _(m):
    kind = F.when(F.col("option_right") == "C", "call").otherwise("put")
    details = F.struct(F.col("option_ticker").alias("ticker"), F.col("expiry").cast("string").alias("expiration_date"), F.col("strike").alias("strike_price"), kind.alias("contract_type"))
    p = pages(m.option_contract, ["underlying"], F.struct(details.alias("details")), "option_ticker").withColumn("fetched_at", F.lit(dt.datetime(2024, 1, 1)))
    return landing.option_contracts(p.drop("underlying")).select("option_ticker", "underlying", "expiry", "strike", "option_right", "shares_per_contract")


@query(
    "a10_ingest_option_expiration",
    """select distinct c.underlying, c.expiry from option_contract c where option_ticker in (select option_ticker from option_snapshot)""",
)
def _(m):
    return landing.option_expirations(chain_pages(m))


@query(
    "a11_ingest_option_oi",
    """select s.option_ticker, s.ny_date as trade_date, c.underlying, c.expiry, c.strike, c.option_right,
    cast(s.open_interest as bigint) as open_interest from option_snapshot s join option_contract c on c.option_ticker = s.option_ticker
    where s.open_interest is not null""",
)
def _(m):
    return landing.option_open_interest(chain_pages(m))


@query("a12_ingest_ticker", "select symbol, name, market, locale, instrument_type, active, currency, market_cap from ticker")
def _(m):
    item = F.struct(F.lower("symbol").alias("ticker"), "name", "market", "locale", F.col("instrument_type").alias("type"), F.when(~F.col("active"), F.lit(False)).alias("active"), F.lit("usd").alias("base_currency_symbol"), "market_cap")
    return landing.tickers(pages(m.ticker, ["locale"], item, "symbol").drop("locale")).select("symbol", "name", "market", "locale", "instrument_type", "active", "currency", "market_cap")


DETAIL = """select symbol, name, market, locale, 'XNAS' as primary_exchange, '000' || cast(length(name) as varchar) as cik, 'BBG' || symbol as composite_figi, '7372' as sic_code, sector, industry,
    'https://example.com/' || symbol as homepage_url, 'About ' || name as description, instrument_type, active, 'usd' as currency, market_cap, date '1999-12-31' as list_date, 100 as total_employees from ticker"""


def reference_item() -> Column:
    """A reference row with all fields, some under their other names."""
    about = {"primary_exchange": F.lit("XNAS"), "cik": F.concat(F.lit("000"), F.length("name").cast("string")), "composite_figi": F.concat(F.lit("BBG"), "symbol"), "sic_code": F.lit("7372")}
    about |= {"homepage_url": F.concat(F.lit("https://example.com/"), "symbol"), "description": F.concat(F.lit("About "), "name"), "list_date": F.lit("1999-12-31"), "total_employees": F.lit(100)}
    ticker = [F.when(~F.col("active"), F.lower("symbol")).alias("ticker"), F.when(F.col("active"), F.lower("symbol")).alias("symbol"), F.col("instrument_type").alias("type"), F.lit(" usd ").alias("currency_symbol")]
    active = F.when(~F.col("active"), F.lit(False)).alias("active")
    return F.struct("name", "market", "locale", "sector", "industry", "market_cap", active, *ticker, *(c.alias(k) for k, c in about.items()))


def typed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("total_employees", F.col("total_employees").cast("int"))


@query("a12_ingest_ticker_detail", DETAIL)
def _(m):
    """Every other document has its object under `results`."""
    item = reference_item()
    wrapped = F.when(F.length("symbol") % 2 == 0, F.to_json(F.struct(item.alias("results")))).otherwise(F.to_json(item))
    return typed(landing.ticker_details(m.ticker.select(wrapped.alias("payload"))))


@query("a12_ingest_ticker_all_columns", DETAIL)
def _(m):
    return typed(landing.ticker_rows(pages(m.ticker, ["market", "locale", "instrument_type"], reference_item(), "symbol").select("payload")))


@query(
    "a13_ingest_ticker_related",
    """select from_symbol, to_symbol, cast(row_number() over (partition by from_symbol order by to_symbol) - 1 as int) as rank from ticker_related""",
)
def _(m):
    twice = m.ticker_related.select("from_symbol", "to_symbol").withColumn("k", F.col("to_symbol"))
    p = pages(twice.union(twice.withColumn("k", F.concat(F.lit("~"), "k"))), ["from_symbol"], F.struct(F.col("to_symbol").alias("ticker")), "k")
    return landing.ticker_related(p)


@query(
    "a14_ingest_ticker_type",
    """select instrument_type as code, market as asset_class, locale, min(symbol) as description from ticker where instrument_type is not null
    group by all""",
)
def _(m):
    rows = m.ticker.where("instrument_type is not null")
    p = pages(rows, ["currency"], F.struct(F.col("instrument_type").alias("code"), F.col("market").alias("asset_class"), "locale", F.col("symbol").alias("description")), "symbol")
    return landing.ticker_types(p.drop("currency"))


@query(
    "a14_ingest_ticker_type_pages",
    """select instrument_type as code, market as asset_class, locale, min(symbol) as description from ticker where instrument_type is not null
    group by all""",
)
def _(m):
    """Pages of one type and market each. The first row of a page gives the description, and the least of the pages' counts."""
    rows = m.ticker.where("instrument_type is not null")
    item = F.struct(F.col("instrument_type").alias("code"), F.col("market").alias("asset_class"), "locale", F.col("symbol").alias("description"))
    return landing.ticker_types(pages(rows, ["instrument_type", "market", "locale"], item, "symbol").select("payload"))


@query(
    "a15_ingest_financials_all",
    """select symbol, case report_type when 'income_statement' then 'income_statement' when 'balance_sheet' then 'balance_sheet'
        when 'cash_flow_statement' then 'cash_flow_statement' else 'filing' end as report_type,
        period_date, period_type, cast(fiscal_year as bigint) as fiscal_year from stock_financials""",
)
def _(m):
    body = F.create_map(F.when(F.col("report_type").isin(*landing.STATEMENTS), F.col("report_type")).otherwise("other"), F.col("data"))
    item = F.struct(F.col("period_date").cast("string").alias("end_date"), F.col("period_type").alias("timeframe"), F.col("fiscal_year").cast("string").alias("fiscal_year"), body.alias("financials"))
    p = pages(m.stock_financials, ["symbol", "report_type", "fiscal_year"], F.to_json(item), "period_date").select("symbol", "payload")
    return landing.financials(p).select("symbol", "report_type", "period_date", "period_type", "fiscal_year")


@query("a16_ingest_splits_by_symbol", "select symbol, ex_date, ratio_from, ratio_to from corporate_action where action_type = 'split'")
def _(m):
    item = F.struct(F.col("symbol").alias("ticker"), F.col("ex_date").cast("string").alias("execution_date"), F.col("ratio_from").alias("split_from"), F.col("ratio_to").alias("split_to"))
    return landing.splits(pages(m.corporate_action.where("action_type = 'split'"), ["symbol"], item, "ex_date").select("payload")).select("symbol", "ex_date", "ratio_from", "ratio_to")


@query("a17_ingest_dividends_by_symbol", "select symbol, ex_date, ex_date + 20 as payment_date, amount from corporate_action where action_type = 'dividend'")
def _(m):
    rows = m.corporate_action.where("action_type = 'dividend'").withColumn("year", F.year("ex_date"))
    item = F.struct(F.col("symbol").alias("ticker"), F.col("ex_date").cast("string").alias("ex_dividend_date"), F.date_add("ex_date", 20).cast("string").alias("pay_date"), F.col("amount").alias("cash_amount"))
    return landing.dividends(pages(rows, ["symbol", "year"], item, "ex_date").select("payload")).select("symbol", "ex_date", "payment_date", "amount")


@query("a18_ingest_calendar_by_year", "select exchange, holiday_date, status from us_market_holiday")
def _(m):
    rows = m.us_market_holiday.withColumn("year", F.year("holiday_date"))
    item = F.struct("exchange", F.col("holiday_date").cast("string").alias("date"), F.upper("status").alias("status"))
    return landing.market_calendar(pages(rows, ["exchange", "year"], item, "holiday_date").select("payload")).select("exchange", "holiday_date", "status")


@query(
    "a15_ingest_financials",
    """select symbol, case when fiscal_year % 3 = 0 then 'filing' else 'income_statement' end as report_type, period_date, period_type,
    cast(fiscal_year as bigint) as fiscal_year from stock_financials""",
)
def _(m):
    rows = m.stock_financials
    body = F.when(F.col("fiscal_year") % 3 == 0, F.create_map(F.lit("balance_sheet"), F.lit(""))).otherwise(F.create_map(F.lit("income_statement"), F.col("data")))
    item = F.struct(F.col("period_date").cast("string").alias("end_date"), F.col("period_type").alias("timeframe"), F.col("fiscal_year").cast("string").alias("fiscal_year"), body.alias("financials"))
    return landing.financials(pages(rows, ["symbol"], F.to_json(item), "period_date")).select("symbol", "report_type", "period_date", "period_type", "fiscal_year")


@query(
    "a16_ingest_splits",
    """select symbol, ex_date, ratio_from, ratio_to, 'adjustment_type=forward' as description from corporate_action where action_type = 'split'""",
)
def _(m):
    item = F.struct(F.col("symbol").alias("ticker"), F.col("ex_date").cast("string").alias("execution_date"), F.col("ratio_from").alias("split_from"), F.col("ratio_to").alias("split_to"), F.lit("forward").alias("adjustment_type"))
    return landing.splits(pages(m.corporate_action.where("action_type = 'split'"), ["action_type"], item, "ex_date").drop("action_type")).drop("action_type")


@query(
    "a17_ingest_dividends",
    """select symbol, ex_date, ex_date + 1 as record_date, ex_date + 20 as payment_date, amount from corporate_action where action_type = 'dividend'""",
)
def _(m):
    later = lambda n: F.date_add("ex_date", n).cast("string")
    item = F.struct(F.col("symbol").alias("ticker"), later(0).alias("ex_dividend_date"), later(1).alias("record_date"), later(20).alias("pay_date"), F.col("amount").alias("cash_amount"))
    return landing.dividends(pages(m.corporate_action.where("action_type = 'dividend'"), ["action_type"], item, "ex_date").drop("action_type")).select("symbol", "ex_date", "record_date", "payment_date", "amount")


@query(
    "a18_ingest_calendar",
    """select exchange, holiday_date, status, epoch_us(cast(holiday_date as timestamp)) + 14 * 3600000000 as opens from us_market_holiday""",
)
def _(m):
    status = F.when((F.col("status") == "closed") & (F.month("holiday_date") == 7), "holiday").otherwise(F.col("status"))
    item = lambda s: F.struct("exchange", F.col("holiday_date").cast("string").alias("date"), s.alias("status"), F.concat(F.col("holiday_date").cast("string"), F.lit("T14:00:00Z")).alias("open"))
    rows = m.us_market_holiday.withColumn("i", F.explode(F.array(item(status), item(F.lit("open")), item(F.lit("closed")))))
    p = pages(rows, ["exchange"], F.col("i"), "holiday_date")
    return landing.market_calendar(p.drop("exchange")).groupBy("exchange", "holiday_date").agg(F.max("status").alias("status"), F.unix_micros(F.max("open_time")).alias("opens")).join(m.us_market_holiday.select("exchange", "holiday_date", F.col("status").alias("s")), ["exchange", "holiday_date"]).select("exchange", "holiday_date", F.col("s").alias("status"), "opens")


@query(
    "a19_merge_pages",
    """select user_id as request, least(count(*), 3) as pages, cast(least(count(*), 3) * 2 as bigint) as results, count(*) > 3 as truncated
    from events group by user_id""",
)
def _(m):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id")
    rows = m.events.withColumns({"page_no": F.row_number().over(w.orderBy("event_id")), "n": F.count("*").over(w)})
    payload = F.to_json(F.struct(F.array(F.lit("a"), F.lit("b")).alias("results"), F.when(F.col("page_no") < F.col("n"), "next").alias("next_url")))
    return landing.merged_pages(rows.select(F.col("user_id").alias("request"), "page_no", payload.alias("payload")), 3)


@query(
    "a19_merge_results",
    """with p as (select user_id as request, event_id, row_number() over (partition by user_id order by event_id) as page_no,
        count(*) over (partition by user_id) as n from events)
    select request, page_no, pos, cast(event_id as varchar) || '-' || cast(pos as varchar) as result, least(n, 10) as pages, n > 10 as truncated from p, (values (0), (1)) v(pos) where page_no <= 10""",
)
def _(m):
    from pyspark.sql import Window

    w = Window.partitionBy("user_id")
    rows = m.events.withColumns({"page_no": F.row_number().over(w.orderBy("event_id")), "n": F.count("*").over(w)})
    results = F.array(*(F.concat(F.col("event_id").cast("string"), F.lit(f"-{i}")) for i in range(2)))
    payload = F.to_json(F.struct(results.alias("results"), F.when(F.col("page_no") < F.col("n"), "next").alias("next_url")))
    return landing.merged_results(rows.select(F.col("user_id").alias("request"), "page_no", payload.alias("payload")), 10)


@query(
    "a20_ingest_bars_rows",
    """select 'daily' as kind, count(*) filter (event_id % 4 = 0) as n from events union all select 'minute', count(*) filter (event_id % 4 in (1,
    2)) from events union all select 'reject', count(*) filter (event_id % 4 = 3) from events""",
)
def _(m):
    period = F.element_at(F.array(*map(F.lit, ("1 D", "1 min", "1 hour", "9 parsecs"))), (F.col("event_id") % 4 + 1).cast("int"))
    parts = landing.bar_rows(m.events.select(F.col("event_type").alias("symbol"), period.alias("period"), (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long").alias("t"), F.col("value").alias("close")))
    counts = [p.agg(F.lit(k).alias("kind"), F.count("*").alias("n")) for k, p in zip(("daily", "minute", "reject"), parts, strict=True)]
    return counts[0].union(counts[1]).union(counts[2])


@query(
    "a20_bars_rows_all",
    """with r as (select event_id, event_type as symbol, event_id % 4 as k, epoch_us(ts) // 1000 as t, value as close from events)
    select event_id, case k when 0 then 'daily' when 3 then 'reject' else 'minute' end as kind, symbol, case k when 1 then '1 minute'
        when 2 then '1 hour' when 3 then '9 parsecs' end as period,
        case when k = 0 then cast(make_timestamp(t * 1000) as date) end as bar_date, case when k in (1, 2) then t * 1000 end as t_us, close from r""",
)
def _(m):
    period = F.element_at(F.array(*map(F.lit, ("1 D", "1 min", "1 hour", "9 parsecs"))), (F.col("event_id") % 4 + 1).cast("int"))
    t = (F.unix_micros(F.col("ts").cast("timestamp")) / 1000).cast("long")
    rows = m.events.select("event_id", F.col("event_type").alias("symbol"), period.alias("period"), t.alias("t"), F.col("value").alias("close"))
    daily, minute, rejects = landing.bar_rows(rows)
    none = {"period": F.lit(None).cast("string"), "bar_date": F.lit(None).cast("date"), "t_us": F.lit(None).cast("long")}
    parts = (("daily", daily, {k: none[k] for k in ("period", "t_us")}), ("minute", minute.withColumn("t_us", F.unix_micros("bar_time")), {"bar_date": none["bar_date"]}), ("reject", rejects, {k: none[k] for k in ("bar_date", "t_us")}))
    cols = ["event_id", "kind", "symbol", "period", "bar_date", "t_us", "close"]
    out = [p.withColumns(more | {"kind": F.lit(k)}).select(*cols) for k, p, more in parts]
    return out[0].union(out[1]).union(out[2])


@query("a21_scan_with_predicates", "select l_orderkey, l_linenumber, l_quantity from lineitem where l_shipdate >= timestamp '2001-09-01' and l_partkey < 500")
def _(m):
    return m.lineitem.where((F.col("l_shipdate") >= F.lit("2001-09-01").cast("timestamp_ntz")) & (F.col("l_partkey") < 500)).select("l_orderkey", "l_linenumber", "l_quantity")


def batch_and_target(m) -> tuple[DataFrame, DataFrame]:
    """Part of the daily closes as the table, and a batch that overlaps it and holds keys twice."""
    base = m.stock_daily.select("symbol", "bar_date", "close", F.col("volume").cast("long").alias("volume"))
    target = base.where("day(bar_date) < 20")
    fresh = base.where("day(bar_date) >= 15").select("symbol", "bar_date", (F.col("close") + 1).alias("close"), F.lit(None).cast("long").alias("volume"), F.lit(1).alias(sinks.ORDINAL))
    again = fresh.where("day(bar_date) % 2 = 0").select("symbol", "bar_date", (F.col("close") + 1).alias("close"), F.lit(7).cast("long").alias("volume"), F.lit(2).alias(sinks.ORDINAL))
    return target, fresh.union(again)


KEYS = ["symbol", "bar_date"]
NEW = "day(bar_date) >= 15"
EVEN = "day(bar_date) % 2 = 0"


@query(
    "b1_upsert_update",
    f"""select symbol, bar_date, close + case when {NEW} then case when {EVEN} then 2 else 1 end else 0 end as close, case
    when not ({NEW}) then volume when {EVEN} then 7 end as volume from stock_daily""",
)
def _(m):
    return sinks.upsert_update(*batch_and_target(m), KEYS)


@query(
    "b5_upsert_partial_columns",
    f"""select symbol, bar_date, close + case when {NEW} then case when {EVEN} then 2 else 1 end else 0 end as close, case
    when day(bar_date) < 20 then volume when {EVEN} then 7 end as volume from stock_daily""",
)
def _(m):
    return sinks.upsert_update(*batch_and_target(m), KEYS, update=["close"])


@query(
    "b2_upsert_do_nothing",
    """select symbol, bar_date, close + case when day(bar_date) >= 20 then 1 else 0 end as close, case
    when day(bar_date) < 20 then volume end as volume from stock_daily""",
)
def _(m):
    return sinks.upsert_do_nothing(*batch_and_target(m), KEYS)


@query(
    "b3_upsert_coalesce",
    f"""select symbol, bar_date, close + case when {NEW} then case when {EVEN} then 2 else 1 end else 0 end as close, case when {NEW}
    and {EVEN} then 7 when day(bar_date) < 20 then volume end as volume, day(bar_date) >= 20 as inserted from stock_daily""",
)
def _(m):
    return sinks.upsert_coalesce(*batch_and_target(m), KEYS)


@query("b4_merge_overview", "select symbol, name, sector, case when symbol < 'UD' then 'new' else industry end as industry from ticker")
def _(m):
    batch = m.ticker.where("symbol < 'UD'").select("symbol", F.lit(None).cast("string").alias("name"), F.lit("").alias("sector"), F.lit("new").alias("industry"))
    return sinks.merge_overview(m.ticker.select("symbol", "name", "sector", "industry"), batch.union(m.spark.createDataFrame([("ZZZ", "z", "z", "z")], batch.schema)), ["symbol"])[0]


@query("b4_overview_not_found", "select 'ZZZ' as symbol from region limit 1")
def _(m):
    batch = m.ticker.select("symbol", "name").union(m.spark.createDataFrame([("ZZZ", "z")], "symbol string, name string"))
    return sinks.merge_overview(m.ticker.select("symbol", "name"), batch, ["symbol"])[1]


@query(
    "b6_replace_by_key",
    """select from_symbol, to_symbol, rank from ticker_related where from_symbol > 'UD' union all select distinct from_symbol, 'UA', 0
    from ticker_related where from_symbol <= 'UD' and from_symbol <> 'UB'""",
)
def _(m):
    target = m.ticker_related.select("from_symbol", "to_symbol", "rank")
    touched = target.where("from_symbol <= 'UD'").select("from_symbol").distinct()
    batch = touched.where("from_symbol <> 'UB'").select("from_symbol", F.lit("UA").alias("to_symbol"), F.lit(0).alias("rank"))
    return sinks.replace_by_key(target, batch, "from_symbol", touched)


@query(
    "b6_replace_expirations",
    """select underlying, expiry from option_contract where underlying > 'UD' group by all union all select underlying, max(expiry) + 7
    from option_contract where underlying <= 'UD' group by underlying""",
)
def _(m):
    target = m.option_contract.select("underlying", "expiry").distinct()
    batch = target.where("underlying <= 'UD'").groupBy("underlying").agg(F.date_add(F.max("expiry"), 7).alias("expiry"))
    return sinks.replace_expirations(target, batch, batch.select("underlying"))


@query("b8_delete_by_filter_rows", "select symbol, period, epoch_us(bar_time) as t, close from stock_minute where symbol <> 'UC'")
def _(m):
    return sinks.delete_bars(m.stock_minute, "UC", ["1 minute", "9 weeks"]).select("symbol", "period", F.unix_micros(F.col("bar_time").cast("timestamp")).alias("t"), "close")


@query(
    "b12_partitioned_upsert",
    """select symbol, bar_date, case when year(bar_date) >= 2001 and day(bar_date) = 5 then close + 1 else close end as close,
        cast(year(bar_date) as varchar) as year from stock_daily
    union all select 'NEW', date '2001-07-01', 5.0, '2001'""",
)
def _(m):
    """A table laid out by years into which a batch is upserted that touches some of them."""
    path = scratch.new_folder(m.spark, "bars")
    rows = sinks.with_partition(m.stock_daily.select("symbol", "bar_date", "close"), "bar_date", "year")
    rows.write.partitionBy("year").parquet(path)
    new = m.spark.createDataFrame([("NEW", dt.date(2001, 7, 1), 5.0)], "symbol string, bar_date date, close double")
    batch = m.stock_daily.where("year(bar_date) >= 2001 and day(bar_date) = 5").select("symbol", "bar_date", (F.col("close") + 1).alias("close")).union(new)
    sinks.upsert_partitions(path, sinks.with_partition(batch, "bar_date", "year"), ["symbol", "bar_date", "year"], "year")
    return sinks.read_partitioned(m.spark, path)


@query(
    "b5_partitioned_partial_columns",
    """select symbol, bar_date, case when trade_count > 3 then close + 1 else close end as close, volume,
        case when trade_count > 1 then strftime(bar_date, '%Y') end as year from stock_daily
    union all select 'NEW', date '2001-07-01', 7.0, null, null""",
)
def _(m):
    """A batch of some columns, with keys twice and rows without a partition, upserted into a table laid out by years."""
    path = scratch.new_folder(m.spark, "bars")
    year = F.when(F.col("trade_count") > 1, F.date_format("bar_date", "yyyy")).alias("year")
    m.stock_daily.select("symbol", "bar_date", "close", "volume", year).write.partitionBy("year").parquet(path)
    rows = m.stock_daily.where("trade_count > 3").select("symbol", "bar_date", "close", year)
    extra = m.spark.createDataFrame([("NEW", dt.date(2001, 7, 1), 6.0, None)], "symbol string, bar_date date, close double, year string")
    batch = rows.union(extra).select("symbol", "bar_date", F.explode(F.array(F.struct(F.lit(2).alias("o"), (F.col("close") + 1).alias("c")), F.struct(F.lit(1).alias("o"), F.lit(0.0).alias("c")))).alias("x"), "year")
    sinks.upsert_partitions(path, batch.select("symbol", "bar_date", F.col("x.c").alias("close"), "year", F.col("x.o").alias(sinks.ORDINAL)), ["symbol", "bar_date"], "year")
    return sinks.read_partitioned(m.spark, path).select("symbol", "bar_date", "close", "volume", "year")


@query(
    "b15_first_seen",
    """select symbol, name, case when symbol < 'UE' then date '2020-01-01' else date '2024-01-01' end as first_seen_at, case
    when symbol >= 'UC' then date '2024-01-01' else date '2020-01-01' end as updated_at from ticker""",
)
def _(m):
    """Rows below UE are there, those from UC on come in: a row keeps the day it was first seen on."""
    old = m.ticker.where("symbol < 'UE'").select("symbol", "name", D(2020, 1, 1).alias("first_seen_at"), D(2020, 1, 1).alias("updated_at"))
    return sinks.first_seen(old, m.ticker.where("symbol >= 'UC'").select("symbol", "name"), ["symbol"], D(2024, 1, 1))


@query("b8_delete_by_filter", "select symbol, period, count(*) as n from stock_minute where symbol <> 'UC' group by all")
def _(m):
    return sinks.delete_bars(m.stock_minute, "UC", ["1 minute", "9 weeks"]).groupBy("symbol", "period").agg(F.count("*").alias("n"))


@query(
    "b9_upsert_financials",
    """select symbol, report_type, period_date, period_type, case when fiscal_year >= 1999 then '{}' else data end as data from stock_financials""",
)
def _(m):
    f = m.stock_financials.select("symbol", "report_type", "period_date", "period_type", "fiscal_year", "data")
    batch = f.where("fiscal_year >= 1999").withColumn("data", F.lit("{}"))
    return sinks.upsert_update(f.where("fiscal_year < 2000"), batch, ["symbol", "report_type", "period_date", "period_type"]).drop("fiscal_year")


@query(
    "b10_update_freshness",
    """select dimension, case when dimension = 'click' then 0 else rows_written end as rows_written, case when dimension = 'click' then 'failed'
    else status end as status from freshness union all select 'stock_daily', 5, 'ok'""",
)
def _(m):
    runs = m.freshness.where("dimension = 'click'").select("dimension", "last_run_at", F.lit(-3).cast("long").alias("rows_written"), F.lit("failed").alias("status"))
    grouped = m.freshness.where("dimension = 'view'").select(F.lit("stock_daily_grouped").alias("dimension"), "last_run_at", F.lit(5).cast("long").alias("rows_written"), F.lit("ok").alias("status"))
    return sinks.update_freshness(m.freshness, runs.union(grouped)).drop("last_run_at")


@query(
    "b10_freshness_of_writes",
    """select dimension, rows_written, status, last_run_at = timestamp '2024-02-01' as fresh from freshness
    union all select 'stock_daily', (select count(*) from stock_daily), 'ok', true
    union all select 'option_contract', (select count(*) from option_contract), 'ok', true
    union all select 'stock_minute', 0, 'failed', true""",
)
def _(m):
    """Tables are written, and one write fails, and the freshness table is told what each wrote."""
    at, taken = F.lit("2024-02-01").cast("timestamp_ntz"), scratch.new_folder(m.spark, "taken")
    m.ticker.write.parquet(taken)
    writes = [("stock_daily_grouped", m.stock_daily, scratch.new_folder(m.spark, "bars")), ("option_contract", m.option_contract, scratch.new_folder(m.spark, "contracts")), ("stock_minute", m.stock_minute, taken)]
    rows = m.spark.createDataFrame([], "dimension string, last_run_at timestamp_ntz, rows_written long, status string")
    for name, df, path in writes:
        rows = rows.unionByName(sinks.write_observed(df, path, name, at, mode="error"))
    return sinks.update_freshness(m.freshness, rows).select("dimension", "rows_written", "status", (F.col("last_run_at") == at).alias("fresh"))


@query(
    "b11_retention_trim",
    """select id, status from job_log where status not in ('done', 'failed') union all
    select id, status from (select * from job_log where status in ('done', 'failed') and finished_at >= timestamp '2024-01-31 00:00:00' - interval 10 day order by finished_at desc nulls last, id desc limit 1000) x""",
)
def _(m):
    return sinks.retention_trim(m.job_log, F.lit("2024-01-31").cast("timestamp_ntz"), 10, 1000).select("id", "status")


@query(
    "b12_partitioned_layout",
    """select coalesce(strftime(case when trade_count > 1 then bar_date end, '%Y-%m'), 'default') as month, count(*) as n from stock_daily group by 1""",
)
def _(m):
    rows = m.stock_daily.withColumn("bar_date", F.when(F.col("trade_count") > 1, F.col("bar_date")))
    return sinks.with_partition(rows, "bar_date", "month").groupBy("month").agg(F.count("*").alias("n"))


@query("b14_seed_holidays", "select exchange, holiday_date, 'label' as name, 'closed' as status from us_market_holiday")
def _(m):
    h = m.us_market_holiday
    target = h.where("month(holiday_date) = 7").select("exchange", "holiday_date", F.lit("old").alias("name"), "status")
    legacy = h.select("exchange", "holiday_date", F.lit(None).cast("string").alias("name"), F.lit("label").alias("label"), F.lit(None).cast("string").alias("status"))
    return sinks.seed_holidays(target, legacy)


@query(
    "b15_touch_updated_at",
    """select option_ticker, case when underlying in (select underlying from option_contract where pk < 5) then date '2024-01-01' end as updated_at
    from option_contract""",
)
def _(m):
    target = m.option_contract.select("option_ticker", "underlying", F.lit(None).cast("date").alias("updated_at"))
    return sinks.touch_updated_at(target, m.option_contract.where("pk < 5"), "underlying", D(2024, 1, 1)).drop("underlying")


@query("b7_replace_all", "select distinct instrument_type as code, market as asset_class, locale from ticker where instrument_type is not null")
def _(m):
    old = m.ticker.select(F.lit("old").alias("code"), F.col("market").alias("asset_class"), "locale")
    new = m.ticker.where("instrument_type is not null").select(F.col("instrument_type").alias("code"), F.col("market").alias("asset_class"), "locale").distinct()
    return sinks.replace_all(old, new)
