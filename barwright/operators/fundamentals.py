"""Fundamentals: coverage, newest rows, unpacked fields and gaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import json_bigint, json_double
from .latest import n_latest, one_latest

#: Report types under one vocabulary.
ALIASES = {"cash_flow": "cash_flow_statement", "income": "income_statement", "balance": "balance_sheet"}


def _newest() -> list[Column]:
    return [F.desc("period_date"), F.col("period_type"), F.col("report_type")]


def coverage_symbols(financials: DataFrame) -> DataFrame:
    """Per symbol and report type the number of quarterly and annual rows."""
    return financials.groupBy("symbol", "report_type").agg(F.count_if(F.col("period_type") == "quarterly").alias("quarterly"), F.count_if(F.col("period_type") == "annual").alias("annual"))


def fill_rate(financials: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct symbols per report type in which a JSON key has a value.

    A document is parsed once, and only the keys that have a value in it become rows; keys that no document of a type fills are added to the sums.
    """
    fields = F.from_json("data", "map<string,string>")
    filled = F.transform(F.array(fields), lambda m: F.filter(F.array(*map(F.lit, keys)), lambda k: F.coalesce(F.element_at(m, k), F.lit("")) != ""))[0]
    rows = financials.select("symbol", "report_type", F.explode_outer(filled).alias("key"))
    counts = rows.groupBy("report_type", "key").agg(F.count_distinct("symbol").alias("symbols"))
    by_type = counts.groupBy("report_type").agg(F.collect_list(F.when(F.col("key").isNotNull(), F.struct("key", "symbols"))).alias("found"))  # a list as long as keys
    out = by_type.select("report_type", F.map_from_entries("found").alias("found"), F.explode(F.array(*map(F.lit, keys))).alias("key"))
    return out.select("report_type", "key", F.coalesce(F.element_at("found", F.col("key")), F.lit(0)).alias("symbols"))


def symbol_counts(financials: DataFrame, types: list[str]) -> DataFrame:
    """Distinct symbols of the report types, one column each."""
    return financials.agg(*(F.count_distinct(F.when(F.col("report_type") == t, F.col("symbol"))).alias(t) for t in types))


def newest_rows(financials: DataFrame, report_type: str, n: int, period_type: str | None = None) -> DataFrame:
    """The newest n rows per symbol of a report type. Sort the result where an order is wanted."""
    rows = financials.where(F.col("report_type") == ALIASES.get(report_type, report_type))
    if period_type:
        rows = rows.where(F.col("period_type") == period_type)
    return n_latest(rows, ["symbol"], _newest(), n)


def income_rows(financials: DataFrame) -> DataFrame:
    """Quarterly and annual income statements; by symbol, fiscal year and quarter where an order is wanted."""
    return financials.where("report_type = 'income_statement' and period_type in ('quarterly', 'annual')")


def ratios_latest(financials: DataFrame) -> DataFrame:
    return one_latest(financials.where("report_type = 'ratios'"), ["symbol"], ["period_date", "period_type"])


def short_interest_fields(financials: DataFrame, n: int) -> DataFrame:
    """The newest n short-interest rows per symbol with their fields unpacked."""
    d = F.col("data")
    rows = n_latest(financials.where("report_type = 'short_interest'"), ["symbol"], _newest(), n)
    out = rows.select("symbol", "period_date", "period_type", json_bigint(d, "short_interest", "shares_short").alias("short_interest"), json_bigint(d, "avg_daily_volume", "average_volume").alias("avg_daily_volume"))
    return out.withColumn("days_to_cover", F.round(F.try_divide(F.col("short_interest").cast("double"), F.nullif("avg_daily_volume", F.lit(0)).cast("double")), 4))


def short_volume_recent(financials: DataFrame, n: int = 10) -> DataFrame:
    """The newest n short-volume rows per symbol as they are, the day being trade_date."""
    rows = n_latest(financials.where("report_type = 'short_volume'"), ["symbol"], _newest(), n)
    return rows.select("symbol", F.col("period_date").alias("trade_date"), "data")


def short_volume_fields(financials: DataFrame, n: int) -> DataFrame:
    """The newest n short-volume rows per symbol with their fields unpacked; fields that are no numbers are null."""
    d = F.col("data")
    fields = [json_bigint(d, "short_volume").alias("short_volume"), json_double(d, "short_volume_ratio").alias("short_volume_ratio"), json_bigint(d, "total_volume").alias("total_volume")]
    return short_volume_recent(financials, n).select("symbol", "trade_date", *fields)


def generic(financials: DataFrame, symbol: str, report_type: str | None = None, period_type: str | None = None) -> DataFrame:
    rows = financials.where(F.col("symbol") == symbol)
    if report_type:
        rows = rows.where(F.col("report_type") == ALIASES.get(report_type, report_type))
    if period_type:
        rows = rows.where(F.col("period_type") == period_type)
    return rows


#: Report types whose depth and age are looked at.
GAP_TYPES = ("income_statement", "balance_sheet", "cash_flow_statement", "ratios", "short_interest", "short_volume")


def gaps(universe: DataFrame, financials: DataFrame, as_of: Column, types: tuple[str, ...] = GAP_TYPES) -> DataFrame:
    """Symbols of the universe lacking depth or recent rows, with the report type: fewer than 5 quarterly or 4 annual income rows, fewer than 4
    quarterly balance sheets or cash flows, no ratios or short interest within 45 days, fewer than 5 short-volume rows or none within 14 days."""
    quarterly, annual = (F.count_if(F.col("period_type") == p).alias(p) for p in ("quarterly", "annual"))
    n = financials.groupBy("symbol", "report_type").agg(quarterly, annual, F.count("*").alias("n"), F.max("period_date").alias("last"))
    rows = universe.select("symbol", F.explode(F.array(*map(F.lit, types))).alias("report_type")).join(n, ["symbol", "report_type"], "left")
    q, a = F.coalesce("quarterly", F.lit(0)), F.coalesce("annual", F.lit(0))
    older = lambda days: F.col("last").isNull() | (F.col("last") < F.date_sub(as_of, days))
    t = F.col("report_type")
    lacking = F.when(t == "income_statement", (q < 5) | (a < 4)).when(t.isin("balance_sheet", "cash_flow_statement"), q < 4)
    lacking = lacking.when(t == "short_volume", (F.coalesce("n", F.lit(0)) < 5) | older(14)).otherwise(older(45))
    return rows.where(lacking).select("symbol", "report_type")
