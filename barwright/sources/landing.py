"""Landed vendor JSON to typed rows. Every decoder takes pages with a column `payload` (one JSON document) and context columns.

An element of a page that is no object is passed over, and a value of a wrong type is null (see `with_document`); the rest of the page stays.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import (
    as_float, as_int, epoch_ms_to_date, epoch_ms_to_ts, normalize_period, normalize_symbol, parse_date, parse_option_right, parse_option_ticker, parse_timestamptz, period_label, snapshot_ts_auto,
)

BAR = "t bigint, o double, h double, l double, c double, v double, vw double, n bigint"
#: Periods that bar rows may carry.
ROW_PERIODS = ("1 D", "1 min", "5 mins", "1 hour")
#: Statements of a filing.
STATEMENTS = ("income_statement", "balance_sheet", "cash_flow_statement", "comprehensive_income")


def read_pages(spark: SparkSession, path: str, context: str = "") -> DataFrame:
    """Pages from a folder of JSON documents, one a line, with the context columns (a schema string) that its partition folders name."""
    return spark.read.schema(f"value string{', ' * bool(context)}{context}").text(path).withColumnRenamed("value", "payload")


def with_document(df: DataFrame, fields: str, name: str = "j", text: str = "payload") -> DataFrame:
    """df with a struct of the given fields (a schema string) of a JSON document; a value that does not fit its type costs nothing but itself.

    Documents that fit are read by `from_json`. Where it reports one that does not, the document is parsed to a variant, and each value is cast on its
    own: a number in text and 4.0 in an integer field keep their value, any other value of a wrong type is null, and so is an element of a wrong kind, in
    its place among the others. Text that is no JSON gives null. Zero has no sign.
    """
    quick = F.from_json(text, f"{fields}, _odd string", {"columnNameOfCorruptRecord": "_odd"})
    each = F.try_variant_get(F.try_parse_json(text), "$", f"struct<{_nested(fields)}>")
    return df.withColumn("_quick", quick).withColumn(name, F.when(F.col("_quick._odd").isNull(), F.col("_quick").dropFields("_odd")).otherwise(each)).drop("_quick")


def merged_pages(pages: DataFrame, max_pages: int) -> DataFrame:
    """Per request the number of pages and of results, and whether a next page remained after max_pages (columns request, page_no, payload)."""
    p = pages.where(F.col("page_no") <= max_pages)
    p = with_document(p, "results array<string>, next_url string")
    return p.groupBy("request").agg(F.count("*").alias("pages"), F.sum(F.greatest(F.size("j.results"), F.lit(0))).alias("results"), F.max_by(F.col("j.next_url"), F.struct("page_no")).isNotNull().alias("truncated"))


def merged_results(pages: DataFrame, max_pages: int) -> DataFrame:
    """The results of all pages of a request up to max_pages: rows (request, page_no, pos, result, pages, truncated), a page without results as one row with null pos and result."""
    w = Window.partitionBy("request")
    p = pages.where(F.col("page_no") <= max_pages)
    p = with_document(p, "results array<string>, next_url string")
    p = p.withColumns({"pages": F.count("*").over(w), "truncated": F.max_by(F.col("j.next_url"), F.struct("page_no")).over(w).isNotNull()})
    return p.select("request", "page_no", "pages", "truncated", F.posexplode_outer("j.results").alias("pos", "result")).select("request", "page_no", "pos", "result", "pages", "truncated")


def _results(pages: DataFrame, item: str, field: str = "results") -> DataFrame:
    """One row per element that is an object, with its place in the page."""
    keep = [c for c in pages.columns if c != "payload"]
    parsed = with_document(pages, f"{field} array<struct<{_nested(item)}>>")
    return parsed.select(*keep, F.posexplode(f"j.{field}").alias("pos", "r")).where("r is not null")


def _nested(ddl: str) -> str:
    return re.sub(r"(^|, )(\w+) ", r"\1\2: ", ddl)


def _bar(r: str = "r") -> list[Column]:
    names = {"open": "o", "high": "h", "low": "l", "close": "c", "vwap": "vw"}
    return [*(F.col(f"{r}.{k}").alias(n) for n, k in names.items()), as_int(F.col(f"{r}.v")).alias("volume"), F.col(f"{r}.n").alias("trade_count")]


def stock_daily(pages: DataFrame) -> DataFrame:
    """Daily bars; rows without a time go; the day is the UTC date."""
    return _results(pages, BAR).where("r.t is not null").select(normalize_symbol(F.col("symbol")).alias("symbol"), epoch_ms_to_date(F.col("r.t")).alias("bar_date"), *_bar())


def stock_minute(pages: DataFrame) -> DataFrame:
    """Intraday bars of pages with multiplier and timespan."""
    return _results(pages, BAR).where("r.t is not null").select(normalize_symbol(F.col("symbol")).alias("symbol"), period_label(F.col("multiplier"), F.col("timespan")).alias("period"), epoch_ms_to_ts(F.col("r.t")).alias("bar_time"), *_bar())


def grouped_daily(pages: DataFrame) -> DataFrame:
    """All symbols of a market day; the symbol is in the rows."""
    items = with_document(pages, "results array<string>").select(F.explode("j.results").alias("i"))
    symbol = normalize_symbol(F.get_json_object("i", "$.T"))  # T and t differ in case only, so T is read by its path
    rows = with_document(items.where(F.col("i").startswith("{")), BAR, "r", "i").select(symbol.alias("symbol"), "r")
    return rows.where("r.t is not null and symbol <> ''").select("symbol", epoch_ms_to_date(F.col("r.t")).alias("bar_date"), *_bar())


def option_daily(pages: DataFrame) -> DataFrame:
    """Daily bars of option tickers with the identity read from the ticker; tickers that cannot be read are left out (see rejected)."""
    rows = _results(pages.withColumn("id", parse_option_ticker(F.col("option_ticker"))), BAR).where("r.t is not null and id is not null")
    return rows.select("option_ticker", epoch_ms_to_date(F.col("r.t")).alias("bar_date"), "id.*", *_bar())


def option_minute(pages: DataFrame) -> DataFrame:
    rows = _results(pages.withColumn("id", parse_option_ticker(F.col("option_ticker"))), BAR).where("r.t is not null and id is not null")
    return rows.select("option_ticker", period_label(F.col("multiplier"), F.col("timespan")).alias("period"), epoch_ms_to_ts(F.col("r.t")).alias("bar_time"), "id.*", *_bar())


def rejected(pages: DataFrame) -> DataFrame:
    """Pages whose option ticker cannot be read."""
    return pages.where(parse_option_ticker(F.col("option_ticker")).isNull())


_SNAPSHOT = "ticker: string, day: map<string, double>, prevDay: map<string, double>, todaysChange: double, todaysChangePerc: double, value: double, price: double"


def _snapshots(pages: DataFrame) -> DataFrame:
    keep = [c for c in pages.columns if c != "payload"]
    j = with_document(pages, f"tickers array<struct<{_SNAPSHOT}>>, ticker struct<{_SNAPSHOT}>")
    one = F.when(F.col("j.ticker").isNotNull(), F.array("j.ticker"))
    return j.select(*keep, F.explode(F.coalesce("j.tickers", one)).alias("r")).where(F.coalesce(F.trim("r.ticker"), F.lit("")) != "")


def _either(bag: str, short: str, long: str) -> Column:
    """A field by its short name if that is present, even with a null, else by its long name."""
    return F.when(F.map_contains_key(bag, short), F.element_at(bag, short)).otherwise(F.element_at(bag, long))


def stock_snapshot(pages: DataFrame) -> DataFrame:
    """Session snapshots of one ticker or a list of them (context column session_date)."""
    fields = {"open": ("o", "open"), "high": ("h", "high"), "low": ("l", "low"), "close": ("c", "close"), "vwap": ("vw", "vwap")}
    return _snapshots(pages).select(
        normalize_symbol(F.col("r.ticker")).alias("symbol"), "session_date", *(_either("r.day", *k).alias(n) for n, k in fields.items()), as_int(_either("r.day", "v", "volume")).alias("volume"),
        _either("r.prevDay", "c", "close").alias("prev_close"), F.col("r.todaysChange").alias("change"), F.col("r.todaysChangePerc").alias("change_pct"),
    )


def directions(c: Column) -> Column:
    """Distinct known directions of a comma list."""
    return F.array_distinct(F.filter(F.transform(F.split(F.lower(c), ","), lambda x: F.trim(x)), lambda x: x.isin("gainers", "losers")))


def stock_movers(pages: DataFrame) -> DataFrame:
    """Gainers and losers (context columns direction, session_date)."""
    price = F.coalesce(_either("r.day", "c", "close"), "r.value", "r.price")
    rows = _snapshots(pages).withColumn("direction", F.explode(directions(F.col("direction"))))
    return rows.select("direction", normalize_symbol(F.col("r.ticker")).alias("symbol"), "session_date", F.col("r.todaysChangePerc").alias("change_pct"), price.alias("price"), as_int(_either("r.day", "v", "volume")).alias("volume"))


_CHAIN = (
    "details: struct<ticker: string, expiration_date: string, strike_price: double, contract_type: string, exercise_style: string, shares_per_contract: int>, greeks: struct<delta: double, gamma: double, theta: double, vega: double, implied_volatility: double>, "
    "implied_volatility: double, open_interest: bigint, day: struct<open: double, high: double, low: double, close: double, volume: double, last_updated: bigint>, last_trade: struct<sip_timestamp: bigint, participant_timestamp: bigint, timestamp: bigint>, underlying_asset: struct<ticker: string>, ticker: string"
)


def _chain(pages: DataFrame) -> DataFrame:
    """Elements of chain pages with ticker, identity (from details, else from the ticker) and time."""
    keep = [c for c in pages.columns if c != "payload"]
    rows = with_document(pages, f"results array<struct<{_CHAIN}>>").select(*keep, F.posexplode("j.results").alias("pos", "r")).where("r is not null")
    rows = rows.withColumn("option_ticker", normalize_symbol(F.coalesce("r.details.ticker", "r.ticker"))).withColumn("id", parse_option_ticker(F.col("option_ticker")))
    t = F.coalesce("r.last_trade.sip_timestamp", "r.last_trade.participant_timestamp", "r.last_trade.timestamp")
    return rows.select(
        *keep, "pos", "r", "option_ticker", normalize_symbol(F.coalesce("r.underlying_asset.ticker", "id.underlying")).alias("underlying"), F.coalesce(parse_date(F.col("r.details.expiration_date")), "id.expiry").alias("expiry"),
        F.coalesce("r.details.strike_price", "id.strike").alias("strike"), F.coalesce(parse_option_right(F.col("r.details.contract_type")), "id.option_right").alias("option_right"), snapshot_ts_auto(t, F.col("r.day.last_updated"), F.col("fetched_at")).alias("snapshot_ts"),
    ).where(F.coalesce("option_ticker", F.lit("")) != "")


def option_contracts(pages: DataFrame) -> DataFrame:
    """Contracts of chain pages, the first of each ticker; incomplete ones go; 100 shares unless stated (context fetched_at)."""
    rows = _chain(pages).where("expiry is not null and strike is not null and option_right is not null")
    row = F.struct("underlying", "expiry", "strike", "option_right", F.col("r.details.exercise_style").alias("exercise_style"), F.coalesce("r.details.shares_per_contract", F.lit(100)).alias("shares_per_contract"))
    return rows.groupBy("option_ticker").agg(F.min_by(row, F.struct("fetched_at", "pos")).alias("c")).select("option_ticker", "c.*")


def option_snapshots(pages: DataFrame) -> DataFrame:
    """Snapshot rows of chain pages; IV from its own field, else from the Greeks."""
    rows = _chain(pages)
    return rows.select(
        "option_ticker", "snapshot_ts", "underlying", F.coalesce("r.implied_volatility", "r.greeks.implied_volatility").alias("iv"), *(F.col(f"r.greeks.{g}").alias(g) for g in ("delta", "gamma", "theta", "vega")),
        F.col("r.open_interest").alias("open_interest"), *(F.col(f"r.day.{x}").alias(f"day_{x}") for x in ("open", "high", "low", "close")), as_int(F.col("r.day.volume")).alias("day_volume"),
    )


def option_expirations(pages: DataFrame) -> DataFrame:
    return _chain(pages).where("underlying is not null and expiry is not null").select("underlying", "expiry").distinct()


def option_open_interest(pages: DataFrame) -> DataFrame:
    """Open interest of chain pages for the pages' trade_date; rows without it go."""
    return _chain(pages).where("r.open_interest is not null").select("option_ticker", "trade_date", "underlying", "expiry", "strike", "option_right", F.col("r.open_interest").alias("open_interest"))


def tickers(pages: DataFrame) -> DataFrame:
    """Reference rows of list pages; active unless stated."""
    item = "ticker string, name string, market string, locale string, type string, active boolean, currency_name string, currency_symbol string, base_currency_symbol string, market_cap double"
    rows = _results(pages, item)
    return rows.select(normalize_symbol(F.col("r.ticker")).alias("symbol"), "r.name", "r.market", "r.locale", F.col("r.type").alias("instrument_type"), F.coalesce("r.active", F.lit(True)).alias("active"), F.upper(F.coalesce("r.currency_name", "r.currency_symbol", "r.base_currency_symbol")).alias("currency"), "r.market_cap").where("symbol <> ''")


#: Fields of a reference row and their columns, beside the symbol.
TICKER_TEXT = {
    "name": "name", "market": "market", "locale": "locale", "primary_exchange": "primary_exchange", "cik": "cik", "composite_figi": "composite_figi",
    "sic_code": "sic_code", "sector": "sector", "industry": "industry", "homepage_url": "homepage_url", "description": "description",
}


def _ticker(r: str) -> list[Column]:
    """The 18 columns of a reference row, all of whose fields were read as text."""
    field = lambda name: F.col(f"{r}.{name}")
    symbol = normalize_symbol(F.coalesce(F.nullif(field("ticker"), F.lit("")), field("symbol")))
    currency = F.trim(F.coalesce(*(F.nullif(field(c), F.lit("")) for c in ("currency_name", "currency_symbol", "currency"))))
    kind = F.coalesce(F.nullif(field("type"), F.lit("")), field("instrument_type"))
    text = [field(k).alias(v) for k, v in TICKER_TEXT.items()]
    active = F.coalesce(field("active").try_cast("boolean"), F.lit(True))
    numbers = [as_float(field("market_cap")).alias("market_cap"), parse_date(field("list_date")).alias("list_date"), as_int(field("total_employees")).alias("total_employees")]
    return [symbol.alias("symbol"), *text, kind.alias("instrument_type"), active.alias("active"), currency.alias("currency"), *numbers]


TICKER = ", ".join(f"{k} string" for k in ("ticker", "symbol", *TICKER_TEXT, "type", "instrument_type", "active", "currency_name", "currency_symbol", "currency", "market_cap", "list_date", "total_employees"))


def ticker_rows(pages: DataFrame) -> DataFrame:
    """Reference rows of list pages with all 18 columns; rows without a symbol go."""
    return _results(pages, TICKER).select(*_ticker("r")).where("symbol <> ''")


def ticker_details(pages: DataFrame) -> DataFrame:
    """Reference rows of detail pages, whose object stands under `results` or is the document itself."""
    inner = F.get_json_object("payload", "$.results")
    document = F.when(inner.startswith("{"), inner).otherwise(F.col("payload"))
    return pages.select(F.from_json(document, TICKER).alias("r")).select(*_ticker("r")).where("symbol <> ''")


def ticker_related(pages: DataFrame) -> DataFrame:
    """Peers with the place of their first occurrence as rank (context from_symbol)."""
    peer = normalize_symbol(F.col("r.ticker"))
    return _results(pages, "ticker string").select("from_symbol", peer.alias("to_symbol"), "pos").where("to_symbol <> ''").groupBy("from_symbol", "to_symbol").agg(F.min("pos").alias("rank"))


def ticker_types(pages: DataFrame) -> DataFrame:
    rows = _results(pages, "code string, asset_class string, locale string, description string")
    keys = ["code", "asset_class", "locale"]
    return rows.select(*(F.col(f"r.{k}") for k in keys), F.col("r.description"), "pos").groupBy(*keys).agg(F.min_by("description", "pos").alias("description"))


def financials(pages: DataFrame) -> DataFrame:
    """One row per non-empty statement of a filing, or one with the whole filing where it has none (context symbol)."""
    rows = with_document(pages, "results array<string>").select("symbol", F.explode("j.results").alias("item")).where(F.col("item").startswith("{"))
    rows = with_document(rows, "end_date string, period_end string, filing_date string, timeframe string, fiscal_year string, fiscal_period string, financials map<string, string>", "h", "item")
    parts = F.array(*(F.struct(F.lit(s).alias("report_type"), F.element_at("h.financials", s).alias("data")) for s in STATEMENTS))
    full = F.filter(parts, lambda p: p["data"].isNotNull() & ~p["data"].isin("", "{}", "null"))
    whole = F.array(F.struct(F.lit("filing").alias("report_type"), F.col("item").alias("data")))
    rows = rows.withColumn("p", F.explode(F.when(F.size(full) > 0, full).otherwise(whole)))
    day = parse_date(F.coalesce("h.end_date", "h.period_end", "h.filing_date"))
    return rows.select(normalize_symbol(F.col("symbol")).alias("symbol"), "p.report_type", day.alias("period_date"), F.coalesce("h.timeframe", F.lit("quarterly")).alias("period_type"), as_int(F.col("h.fiscal_year")).alias("fiscal_year"), "p.data")


def splits(pages: DataFrame) -> DataFrame:
    rows = _results(pages, "ticker string, execution_date string, split_from double, split_to double, adjustment_type string")
    return rows.select(normalize_symbol(F.col("r.ticker")).alias("symbol"), F.lit("split").alias("action_type"), parse_date(F.col("r.execution_date")).alias("ex_date"), F.col("r.split_from").alias("ratio_from"), F.col("r.split_to").alias("ratio_to"), F.concat(F.lit("adjustment_type="), "r.adjustment_type").alias("description"))


def dividends(pages: DataFrame) -> DataFrame:
    rows = _results(pages, "ticker string, ex_dividend_date string, record_date string, pay_date string, cash_amount double, currency string, dividend_type string")
    return rows.select(normalize_symbol(F.col("r.ticker")).alias("symbol"), F.lit("dividend").alias("action_type"), parse_date(F.col("r.ex_dividend_date")).alias("ex_date"), parse_date(F.col("r.record_date")).alias("record_date"), parse_date(F.col("r.pay_date")).alias("payment_date"), F.col("r.cash_amount").alias("amount"), F.col("r.dividend_type").alias("description"))


def market_calendar(pages: DataFrame) -> DataFrame:
    """Closed and early-close days, the first row of each exchange and date."""
    rows = _results(pages, "exchange string, date string, name string, status string, open string, close string")
    status = F.when(F.lower("r.status") == "holiday", "closed").otherwise(F.lower("r.status"))
    rows = rows.select(F.upper("r.exchange").alias("exchange"), parse_date(F.col("r.date")).alias("holiday_date"), "r.name", status.alias("status"), parse_timestamptz(F.col("r.open")).alias("open_time"), parse_timestamptz(F.col("r.close")).alias("close_time"), "pos")
    first = Window.partitionBy("exchange", "holiday_date").orderBy("pos")
    return rows.where("status in ('closed', 'early-close')").withColumn("n", F.row_number().over(first)).where("n = 1").drop("n", "pos")


def bar_rows(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Flat bar rows (symbol, period, t, close ...) to daily rows, intraday rows, and rejects with an unknown period or no time."""
    good = F.col("period").isin(*ROW_PERIODS) & F.col("t").isNotNull()
    at = epoch_ms_to_ts(F.col("t"))
    daily = rows.where(good & (F.col("period") == "1 D")).withColumn("bar_date", F.to_date(at)).drop("period", "t")
    minute = rows.where(good & (F.col("period") != "1 D")).withColumns({"period": normalize_period(F.col("period")), "bar_time": at}).drop("t")
    return daily, minute, rows.where(~F.coalesce(good, F.lit(False)))

