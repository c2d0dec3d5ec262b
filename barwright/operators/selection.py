"""Values at exact ranks of groups of any size, without bringing a group's values together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import stored

#: Buckets that a group's range is cut into.
BUCKETS = 1024


def at_ranks(df: DataFrame, keys: list[str], value: str, ranks: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Rows (keys, n, names): for each name the value at its rank (from 0, a function of n) among a group's n values in ascending order, nulls apart.

    Two passes: values are counted by buckets of equal width between the group's least and greatest one, summed before the shuffle; only
    the bucket that holds a rank is then counted value by value. A group without values, or with a null key, gives no row. The rows are stored, as both
    passes read them.
    """
    rows = stored(df.where(" and ".join(f"{c} is not null" for c in (*keys, value))).select(*keys, F.col(value).alias("_v")))
    bounds = rows.groupBy(*keys).agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    half = lambda c: F.col(c).cast("double") / 2  # noqa: E731  the difference of halves stays within a double
    place = F.floor((half("_v") - half("_low")) / (half("_high") - half("_low")) * BUCKETS)
    bucket = F.when(F.col("_high") > F.col("_low"), F.least(place, F.lit(BUCKETS - 1))).otherwise(0)
    placed = rows.join(bounds, keys).select(*keys, "_v", bucket.alias("_bucket"))

    group = Window.partitionBy(*keys)  # BUCKETS rows at most
    counted = placed.groupBy(*keys, "_bucket").agg(F.count("*").alias("_n"))
    counted = counted.withColumns({"n": F.sum("_n").over(group), "_before": F.sum("_n").over(group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")})
    wanted = F.array(*(F.struct(F.lit(name).alias("name"), rank(F.col("n")).cast("long").alias("rank")) for name, rank in ranks.items()))
    here = F.filter(wanted, lambda x: (x["rank"] >= F.col("_before")) & (x["rank"] < F.col("_before") + F.col("_n")))
    targets = counted.select(*keys, "_bucket", "n", "_before", F.explode(here).alias("_x"))
    targets = stored(targets.select(*keys, "_bucket", "n", "_x.name", (F.col("_x.rank") - F.col("_before")).alias("_rank")))

    few = placed.join(targets.select(*keys, "_bucket").distinct(), [*keys, "_bucket"], "left_semi").groupBy(*keys, "_bucket", "_v").agg(F.count("*").alias("_n"))
    so_far = Window.partitionBy(*keys, "_bucket").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)  # distinct values of one bucket
    few = few.withColumn("_upto", F.sum("_n").over(so_far))
    met = few.join(targets, [*keys, "_bucket"]).where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n")))
    return met.groupBy(*keys, "n").agg(*(F.max(F.when(F.col("name") == name, F.col("_v"))).alias(name) for name in ranks))


def medians(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Rows (keys, name): the exact median of each group, the mean of the two middle values where their number is even."""
    middle = {"_low": lambda n: F.floor((n - 1) / 2), "_high": lambda n: F.floor(n / 2)}
    found = at_ranks(df, keys, value, middle)
    return found.select(*keys, F.when(F.col("_low") == F.col("_high"), F.col("_low").cast("double")).otherwise((F.col("_low") + F.col("_high")) / 2).alias(name))
