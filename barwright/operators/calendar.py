"""Trading calendar from weekdays and a holiday table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def closed_holidays(holidays: DataFrame, first: Column, last: Column, exchange: str = "NYSE") -> DataFrame:
    return holidays.where((F.col("exchange") == exchange) & (F.col("status") == "closed") & F.col("holiday_date").between(first, last)).select("holiday_date").distinct()


def expected_trading_days(spark: SparkSession, holidays: DataFrame, first: Column, last: Column) -> DataFrame:
    """All sessions in [first, last], column day."""
    days = spark.range(1).select(F.explode(F.sequence(first.cast("date"), last.cast("date"))).alias("day")).where(F.weekday("day") < 5)
    return days.join(closed_holidays(holidays, first, last).withColumnRenamed("holiday_date", "day"), "day", "left_anti")


def recent_trading_days(spark: SparkSession, holidays: DataFrame, end: Column, n: int, completed_before: Column | None = None) -> DataFrame:
    """The last n sessions up to end; with completed_before, that (running) day is left out."""
    span = max(4 * n, n + 60)
    days = expected_trading_days(spark, holidays, F.date_sub(end, span), end)
    if completed_before is not None:
        days = days.where(F.col("day") < completed_before)
    return days.orderBy(F.desc("day")).limit(n)


def is_trading_day(days: DataFrame, holidays: DataFrame, day: str = "day", exchange: str = "NYSE") -> DataFrame:
    """Adds is_trading to rows with a day."""
    closed = holidays.where((F.col("exchange") == exchange) & (F.col("status") == "closed")).select(F.col("holiday_date").alias(day), F.lit(True).alias("_closed")).distinct()
    return days.join(closed, day, "left").withColumn("is_trading", (F.weekday(day) < 5) & F.col("_closed").isNull()).drop("_closed")


def resolve_target_date(instant: Column) -> Column:
    """The New York date, or the Friday before where that is a weekend day."""
    from ..functions.columns import ny_date

    d = ny_date(instant)
    return F.date_sub(d, F.greatest(F.weekday(d) - 4, F.lit(0)))
