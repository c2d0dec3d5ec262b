"""Running values along the rows of a key by blocks of time or of rows, so that a key with a long history is spread over tasks.

Each block is worked on by itself, then the blocks' totals (blocks of blocks, where there are many), and what came before a block is joined to its rows.
No window holds more than a block, or FAN blocks.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Blocks that one window holds at most; rows of a key in a block of `decayed`.
FAN, ROWS = 1024, 64
#: Days, or minutes where times are finer, in a block of time.
DAYS, MINUTES = 64, 1440
_OFFSET = 1 << 22  # keeps the numbers of blocks before 1970 positive


def time_block(df: DataFrame, time: str) -> Column:
    """Number of the block that a row's date or timestamp lies in."""
    if df.schema[time].dataType.typeName() == "date":
        return F.floor(F.unix_date(time) / DAYS) + _OFFSET
    return F.floor(F.unix_micros(F.col(time).cast("timestamp")) / (60_000_000 * MINUTES)) + _OFFSET


def _combined(kind: str, early: Column, late: Column) -> Column:
    if kind == "last":
        return F.coalesce(late, early)
    return F.coalesce(early, F.lit(0)) + F.coalesce(late, F.lit(0)) if kind == "sum" else F.coalesce(early, F.lit(1.0)) * F.coalesce(late, F.lit(1.0))


_AGGREGATES = {"sum": F.sum, "product": F.product}


def before(blocks: DataFrame, keys: list[str], values: dict[str, str], backwards: bool = False, levels: int = 3) -> DataFrame:
    """blocks (keys, block, values), one row each, with each value totalled over all earlier blocks of the key; later ones if backwards.

    values: name -> sum, product, or last (the last that is not null).
    """
    order = F.desc("block") if backwards else F.col("block")
    w = Window.partitionBy(*keys, "_top").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    over = lambda c, kind: (F.last(c, ignorenulls=True) if kind == "last" else _AGGREGATES[kind](c)).over(w).alias(c)
    rows = blocks.withColumn("_top", F.floor(F.col("block") / FAN))
    inner = rows.select(*keys, "block", "_top", *(over(c, kind) for c, kind in values.items()))
    if levels == 1:
        return inner.drop("_top")
    place = F.when(F.lit(backwards), -F.col("block")).otherwise(F.col("block"))
    total = lambda c, kind: (F.max_by(c, F.when(F.col(c).isNotNull(), place)) if kind == "last" else _AGGREGATES[kind](c)).alias(c)
    tops = rows.groupBy(*keys, F.col("_top").alias("block")).agg(*(total(c, kind) for c, kind in values.items()))
    outer = before(tops, keys, values, backwards, levels - 1).withColumnsRenamed({"block": "_top"} | {c: f"_{c}" for c in values})
    return inner.join(outer, [*keys, "_top"]).select(*keys, "block", *(_combined(kind, F.col(f"_{c}"), F.col(c)).alias(c) for c, kind in values.items()))


def numbered(df: DataFrame, keys: list[str], time: str, prev: Iterable[str] = ()) -> DataFrame:
    """df with n, the place of a row among those of its key by time (from 1), and prev_<column> of the row before it. Times of a key are distinct.

    Numeric columns only have a prev; a null is passed over.
    """
    rows = df.withColumn("block", time_block(df, time))
    w = Window.partitionBy(*keys, "block").orderBy(time)
    last = {f"prev_{c}": F.max_by(c, F.when(F.col(c).isNotNull(), F.col(time))).alias(f"prev_{c}") for c in prev}
    blocks = rows.groupBy(*keys, "block").agg(F.count("*").alias("n"), *last.values())
    carried = before(blocks, keys, {"n": "sum"} | dict.fromkeys(last, "last")).withColumnsRenamed({c: f"_{c}" for c in ("n", *last)})
    rows = rows.withColumns({"n": F.row_number().over(w)} | {f"prev_{c}": F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)) for c in prev})
    rows = rows.join(carried, [*keys, "block"])
    return rows.select(*df.columns, (F.col("n") + F.coalesce("_n", F.lit(0))).alias("n"), *(F.coalesce(c, f"_{c}").alias(c) for c in last))


def carried(line: DataFrame, keys: list[str], order: list[str], fields: list[str], has: Column, name: str = "carried", strict: bool = False) -> DataFrame:
    """line with a struct of the fields of the last row for which `has` holds, at or before a row in the order; strictly before it if strict.

    The order begins with a time, which is distinct among the rows of a key for which `has` holds. The fields are of fixed width.
    """
    time = order[0]
    rows = line.withColumn("_block", time_block(line, time))
    w = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    at = F.when(has, F.col(time))
    ends = rows.groupBy(*keys, F.col("_block").alias("block")).agg(F.max(at).alias("_at"), *(F.max_by(f, at).alias(f) for f in fields))
    ends = ends.select(*keys, "block", F.when(F.col("_at").isNotNull(), F.struct(*fields)).alias("_early"))
    early = before(ends, keys, {"_early": "last"}).withColumnRenamed("block", "_block")
    rows = rows.withColumn("_own", F.last(F.when(has, F.struct(*fields)), ignorenulls=True).over(w)).join(early, [*keys, "_block"])
    return rows.withColumn(name, F.coalesce("_own", "_early")).drop("_block", "_own", "_early")


def total_after(line: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """line with the product of a value over the rows of the key from a row on to the last one in the order, which begins with a time."""
    rows = line.withColumn("_block", time_block(line, order[0]))
    w = Window.partitionBy(*keys, "_block").orderBy(*(F.desc(c) for c in order)).rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.groupBy(*keys, F.col("_block").alias("block")).agg(F.product(value).alias("_late"))
    late = before(ends, keys, {"_late": "product"}, backwards=True).withColumnRenamed("block", "_block")
    rows = rows.withColumn(name, F.product(value).over(w)).join(late, [*keys, "_block"])
    return rows.withColumn(name, F.col(name) * F.coalesce("_late", F.lit(1.0))).drop("_block", "_late")


def decayed(rows: DataFrame, keys: list[str], q: float, *values: str, longest: int) -> DataFrame:
    """rows (keys, n, values ...) with each value x turned into y(n) = q * y(n - 1) + x(n), y(0) being 0; n runs from 1 to `longest` at most.

    Within ROWS rows that is a weighted running sum. The last y of each block, alone, follows the same rule with q ** ROWS, so blocks are worked on in the same way.
    Where that decays within a few blocks beyond the precision of a double, these few are added up instead.
    """
    if q == 0:
        return rows
    if q**ROWS < 1e-250:
        lags = math.ceil(-20 / math.log10(q))
        moved = rows.select(*keys, "n", F.explode(F.sequence(F.lit(0), F.lit(lags))).alias("_lag"), *values)
        weighted = [F.sum(F.col(v) * F.pow(F.lit(q), F.col("_lag"))).alias(v) for v in values]
        return moved.groupBy(*keys, (F.col("n") + F.col("_lag")).alias("n")).agg(*weighted)
    rows = rows.withColumns({"_block": F.floor((F.col("n") - 1) / ROWS), "_k": (F.col("n") - 1) % ROWS + 1})
    w = Window.partitionBy(*keys, "_block").orderBy("n")
    rows = rows.withColumns({v: F.pow(F.lit(q), F.col("_k")) * F.sum(F.col(v) * F.pow(F.lit(q), -F.col("_k"))).over(w) for v in values})
    if longest <= ROWS:
        return rows.drop("_block", "_k")
    ends = rows.groupBy(*keys, (F.col("_block") + 1).alias("n")).agg(*(F.max_by(v, "_k").alias(v) for v in values))
    ends = decayed(ends, keys, q**ROWS, *values, longest=-(-longest // ROWS))
    carried = ends.select(*keys, F.col("n").alias("_block"), *(F.col(v).alias(f"_{v}") for v in values))
    grown = {v: F.col(v) + F.coalesce(F.col(f"_{v}") * F.pow(F.lit(q), F.col("_k")), F.lit(0.0)) for v in values}
    return rows.join(carried, [*keys, "_block"], "left").withColumns(grown).drop("_block", "_k", *(f"_{v}" for v in values))


def smoothed(rows: DataFrame, keys: list[str], time: str, window: int, alpha: float, *values: str, longest: int) -> DataFrame:
    """Exponential smoothing of values from the mean of the first `window` rows on: rows (keys, time, n, values), n being at least window.

    rows: (keys, time, n, values), n numbering the rows of a key from 1 to `longest` at most; values are not null.
    """
    first = rows.where(F.col("n") <= window).groupBy(*keys).agg(F.max(time).alias(time), F.count("*").alias("n"), *(F.avg(v).alias(v) for v in values)).where(F.col("n") == window)
    later = rows.where(F.col("n") > window).select(*keys, time, "n", *((F.lit(alpha) * F.col(v)).alias(v) for v in values))
    line = first.select(*keys, time, "n", *values).unionByName(later).withColumn("n", F.col("n") - window + 1)
    return decayed(line, keys, 1 - alpha, *values, longest=max(longest - window + 1, 1)).withColumn("n", F.col("n") + window - 1)
