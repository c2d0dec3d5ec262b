"""Shared shapes: the latest row, or rows, of each key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import ny_date


def one_latest(df: DataFrame, keys: list[str], by: list[str], where: Column | None = None) -> DataFrame:
    """The row with the greatest `by` of each key; where filters before picking. Partial maxima are made before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in by]
    rows = df if where is None else df.where(where)
    best = rows.groupBy(*keys).agg(F.max(F.struct(*by, *rest)).alias("_r"))
    return best.select(*keys, *(F.col(f"_r.{c}").alias(c) for c in [*by, *rest])).select(*df.columns)


def n_latest(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key in an order; Spark prunes groups before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_n", rank).where(F.col("_n") <= n).drop("_n")


def latest_per_day(snapshots: DataFrame, where: Column | None = None) -> DataFrame:
    """The newest snapshot of each contract and New York day (column ny_date is added if absent)."""
    rows = snapshots if "ny_date" in snapshots.columns else snapshots.withColumn("ny_date", ny_date(F.col("snapshot_ts")))
    return one_latest(rows, ["option_ticker", "ny_date"], ["snapshot_ts"], where)


def chain_latest(snapshots: DataFrame) -> DataFrame:
    return one_latest(snapshots, ["option_ticker"], ["snapshot_ts"])


def near_term_contracts(contracts: DataFrame, as_of: Column, days: int, most: int) -> DataFrame:
    """The first contracts of each underlying by expiry, strike and right that expire within days of as_of."""
    rows = contracts.where(F.col("expiry").between(as_of, F.date_add(as_of, days)))
    return n_latest(rows, ["underlying"], [F.col(c) for c in ("expiry", "strike", "option_right", "option_ticker")], most)
