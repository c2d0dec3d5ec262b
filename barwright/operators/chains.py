"""Option chains and reference lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import build_contract_key, is_vendor_ticker, parse_contract_key
from .latest import chain_latest, latest_per_day


def expirations(expiration_table: DataFrame, contracts: DataFrame, as_of: Column) -> DataFrame:
    """Expirations per underlying from the expiration table, from the contracts for underlyings that it lacks, and the strikes of the nearest future one (else the first)."""
    rest = contracts.select("underlying", "expiry").join(expiration_table.select("underlying").distinct(), "underlying", "left_anti")
    rows = expiration_table.select("underlying", "expiry").union(rest).distinct()
    pick = F.coalesce(F.min(F.when(F.col("expiry") >= as_of, F.col("expiry"))), F.min("expiry"))
    nearest = rows.groupBy("underlying").agg(F.array_sort(F.collect_set("expiry")).alias("expirations"), pick.alias("expiry"))
    strikes = contracts.groupBy("underlying", "expiry").agg(F.array_sort(F.collect_set("strike")).alias("strikes"))
    return nearest.join(strikes, ["underlying", "expiry"], "left").withColumnRenamed("expiry", "nearest")


def snapshots_latest(snapshots: DataFrame, contracts: DataFrame, underlying: str, limit: int) -> DataFrame:
    rows = chain_latest(snapshots.where(F.col("underlying") == underlying)).join(contracts.select("option_ticker", "expiry", "strike", "option_right"), "option_ticker")
    return rows.orderBy("expiry", "strike", "option_right", "option_ticker").limit(limit)


def resolve_keys(requests: DataFrame, contracts: DataFrame, tolerance: float = 1e-4) -> DataFrame:
    """Contracts of mixed requests (column key: vendor tickers or contract keys): rows (key, option_ticker, contract_key, vendor).

    Vendor tickers join on the ticker; contract keys on underlying, expiry and right, with the strikes within a tolerance as a residual test.
    Each contract stands for both names, so that one join, and one pass over the contracts, serves both kinds of request.
    """
    identity = lambda underlying, expiry, right: F.to_json(F.struct(underlying.alias("u"), expiry.alias("e"), right.alias("r")))
    named = contracts.withColumn("contract_key", build_contract_key(F.col("underlying"), F.col("expiry"), F.col("strike"), F.col("option_right")))
    whole = F.when(F.col("underlying").isNotNull() & F.col("expiry").isNotNull() & F.col("option_right").isNotNull(), identity(F.col("underlying"), F.col("expiry"), F.col("option_right")))
    names = F.array(F.struct(F.lit(True).alias("vendor"), F.col("option_ticker").alias("name")), F.struct(F.lit(False).alias("vendor"), whole.alias("name")))
    named = named.select("option_ticker", "contract_key", "strike", F.explode(names).alias("_by")).select("option_ticker", "contract_key", "strike", "_by.*")

    # Read once for each request: a generator's row is not worked out again in the tests of the join, nor further down in the rows that requests are made of.
    key = requests.select("key").distinct().select("key", is_vendor_ticker(F.col("key")).alias("vendor"), F.explode(F.array(parse_contract_key(F.col("key")))).alias("k"))
    name = F.when(F.col("vendor"), F.upper(F.trim("key"))).when(F.col("k").isNotNull(), identity(F.col("k.underlying"), F.col("k.expiry"), F.col("k.option_right")))
    key = key.select("key", "vendor", name.alias("name"), F.col("k.strike").alias("asked")).where("name is not null")
    near = F.col("vendor") | (F.abs(F.col("strike") - F.col("asked")) < tolerance)
    return key.join(named, ["vendor", "name"]).where(near).select("key", "option_ticker", "contract_key", "vendor")


def chain_latest_by_keys(requests: DataFrame, contracts: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Newest snapshot of each requested contract, one row per contract key; requests by ticker come first."""
    found = resolve_keys(requests, contracts).groupBy("contract_key").agg(F.max_by("option_ticker", F.struct("vendor", "option_ticker")).alias("option_ticker"), F.max("vendor").alias("vendor"))
    return found.join(chain_latest(snapshots.join(found.select("option_ticker").distinct(), "option_ticker", "left_semi")), "option_ticker")


def chain_eod_by_keys(requests: DataFrame, contracts: DataFrame, snapshots: DataFrame, stock_daily: DataFrame, since: Column) -> DataFrame:
    """One snapshot per New York day of each requested contract since a day, with the underlying's close."""
    from .options_analytics import with_stock

    found = resolve_keys(requests, contracts).select("option_ticker", "contract_key").distinct()
    asked = snapshots.where(F.col("ny_date") >= since).join(found, "option_ticker")  # a contract has one key
    return with_stock(latest_per_day(asked), stock_daily)


def contracts_list(contracts: DataFrame) -> DataFrame:
    key = build_contract_key(F.col("underlying"), F.col("expiry"), F.col("strike"), F.col("option_right"))
    return contracts.select("option_ticker", "underlying", "expiry", "strike", "option_right", key.alias("contract_key"))


def us_equity_universe(tickers: DataFrame) -> DataFrame:
    """Active US stocks of type CS."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    return tickers.where(F.coalesce("active", F.lit(False)) & (low("locale") == "us") & (low("market") == "stocks") & (low("instrument_type") == "cs"))


def ticker_search(tickers: DataFrame, needle: str, limit: int) -> DataFrame:
    """Symbols that start with the needle or names that hold it, exact matches first, then by prefix, then the rest."""
    up = needle.strip().upper()
    s, name = F.upper("symbol"), F.upper(F.coalesce("name", F.lit("")))
    rank = F.when(s == up, 0).when(s.startswith(up), 1).otherwise(2)
    return tickers.where(s.startswith(up) | name.contains(up)).withColumn("match", rank).orderBy("match", "symbol").limit(limit)


def ticker_types(types: DataFrame | None, tickers: DataFrame) -> DataFrame:
    """The dictionary of types; without one, the types that occur with their number."""
    if types is not None:
        return types
    return tickers.groupBy("instrument_type", "market", "locale").agg(F.count("*").alias("n"))


def related_with_names(related: DataFrame, tickers: DataFrame, limit: int = 200) -> DataFrame:
    from .latest import n_latest

    rows = related.join(tickers.select(F.col("symbol").alias("to_symbol"), "name"), "to_symbol", "left")
    return n_latest(rows, ["from_symbol"], [F.col("rank"), F.col("to_symbol")], limit)


def resolve_watchlist(watchlist: DataFrame, contracts: DataFrame, limit: int) -> DataFrame:
    """The watchlist, or if it is empty the underlyings with most contracts; source says which."""
    given = watchlist.select("symbol", F.lit("watchlist").alias("source"))
    busy = contracts.groupBy("underlying").count().orderBy(F.desc("count"), "underlying").limit(limit)
    none = watchlist.agg(F.count("*").alias("n")).where("n = 0").select(F.lit(True).alias("empty"))
    fallback = busy.join(F.broadcast(none), F.lit(True), "left_semi").select(F.col("underlying").alias("symbol"), F.lit("contracts").alias("source"))  # one row at most
    return given.union(fallback)


def union_benchmarks(symbols: DataFrame, benchmarks: tuple[str, ...] = ("SPY", "QQQ", "IWM")) -> DataFrame:
    more = symbols.sparkSession.createDataFrame([(b,) for b in benchmarks], "symbol string")
    return symbols.select("symbol").union(more).distinct()
