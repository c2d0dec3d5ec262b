"""Write semantics on keyed tables: each operator computes the new contents of a table; `write_partitions` stores the touched partitions."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ORDINAL = "_ordinal"


def _check(target: DataFrame, batch: DataFrame, keys: list[str]) -> list[str]:
    cols = [c for c in batch.columns if c != ORDINAL]
    if unknown := [c for c in cols if c not in target.columns] or [k for k in keys if k not in cols]:
        raise ValueError(f"columns do not fit: {unknown}")
    return cols


def _one_per_key(batch: DataFrame, keys: list[str], last: bool) -> DataFrame:
    """The last (or first) row of each key of a batch by its ordinal; ties go by the row's values."""
    cols = [c for c in batch.columns if c != ORDINAL]
    order = F.struct(F.col(ORDINAL) if ORDINAL in batch.columns else F.lit(0).alias(ORDINAL), *(c for c in cols if c not in keys))
    pick = (F.max if last else F.min)(order).alias("_r")
    return batch.groupBy(*keys).agg(pick).select(*keys, *(F.col(f"_r.{c}").alias(c) for c in cols if c not in keys))


def _joined(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    n = new.select(*keys, *(F.col(c).alias(f"_n_{c}") for c in new.columns if c not in keys), F.lit(True).alias("_new"))
    return target.withColumn("_old", F.lit(True)).join(n, keys, "full_outer")


def upsert_update(target: DataFrame, batch: DataFrame, keys: list[str], update: Iterable[str] | None = None, stamp: dict[str, Column] | None = None) -> DataFrame:
    """Insert, or on a key that exists overwrite the update columns (default: all others of the batch); the last row of a key in the batch wins.

    stamp sets columns, such as a fetch time, on every row that the batch wrote."""
    cols = _check(target, batch, keys)
    update = [c for c in cols if c not in keys] if update is None else list(update)
    j = _joined(target, _one_per_key(batch, keys, last=True), keys)
    out = {}
    for c in target.columns:
        if c in keys:
            continue
        value = F.col(c)
        if c in cols:
            changed = F.col("_new").isNotNull() & (F.col("_old").isNull() | F.lit(c in update))
            value = F.when(changed, F.col(f"_n_{c}")).otherwise(F.col(c))
        out[c] = F.when(F.col("_new").isNotNull(), stamp[c]).otherwise(value) if stamp and c in stamp else value
    return j.select(*(out[c].alias(c) if c in out else F.col(c) for c in target.columns))


def upsert_do_nothing(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Insert only absent keys; the first row of a key in the batch wins."""
    _check(target, batch, keys)
    new = _one_per_key(batch, keys, last=False).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new, allowMissingColumns=True)


def upsert_coalesce(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Per column the batch's last non-null value, else the old one; column `inserted` tells new keys."""
    cols = [c for c in _check(target, batch, keys) if c not in keys]
    ordinal = F.col(ORDINAL) if ORDINAL in batch.columns else F.lit(0)
    new = batch.groupBy(*keys).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(ordinal, F.col(c)))).alias(c) for c in cols))
    j = _joined(target, new, keys)
    return j.select(*(F.coalesce(f"_n_{c}", c).alias(c) if c in cols else F.col(c) for c in target.columns), F.col("_old").isNull().alias("inserted"))


def merge_overview(target: DataFrame, batch: DataFrame, keys: list[str], blank: Iterable[str] = ("sector", "industry")) -> tuple[DataFrame, DataFrame]:
    """Update-only merge of non-null values, blanks counting as null in some columns; also the batch's keys that were not found."""
    cols = [c for c in _check(target, batch, keys) if c not in keys]
    new = _one_per_key(batch, keys, last=True)
    n = new.select(*keys, *((F.nullif(F.col(c), F.lit("")) if c in blank else F.col(c)).alias(f"_n_{c}") for c in cols))
    merged = target.join(n, keys, "left").select(*(F.coalesce(f"_n_{c}", c).alias(c) if c in cols else F.col(c) for c in target.columns))
    return merged, new.select(*keys).join(target.select(*keys), keys, "left_anti")


def replace_expirations(target: DataFrame, batch: DataFrame, underlyings: DataFrame) -> DataFrame:
    """Expirations of the given underlyings give way to the batch's (underlying, expiry). An underlying without any in the batch is an error."""
    empty = underlyings.select("underlying").join(batch.select("underlying"), "underlying", "left_anti").select(F.min("underlying")).first()[0]
    if empty is not None:
        raise ValueError(f"no expirations for {empty}")
    return replace_by_key(target, batch, "underlying", underlyings)


def replace_by_key(target: DataFrame, batch: DataFrame, key: str, touched: DataFrame | None = None) -> DataFrame:
    """All rows of the touched keys give way to the batch's; a touched key without rows in the batch is emptied."""
    keys = batch.select(key) if touched is None else touched.select(key)
    return target.join(keys.distinct(), key, "left_anti").select(*target.columns).unionByName(batch.select(*target.columns).distinct())


def delete_bars(target: DataFrame, symbol: str, periods: Iterable[str] | None) -> DataFrame:
    """The table without a symbol's rows (of listed periods). Nothing to delete by is an error."""
    gone = F.col("symbol") == symbol
    if periods is not None:
        if not (known := [p for p in periods if p]):
            raise ValueError("no period to delete")
        gone &= F.col("period").isin(*known)
    return target.where(~gone)


def update_freshness(freshness: DataFrame, rows: DataFrame) -> DataFrame:
    """One row per dimension with its last run; written rows are never negative, and grouped daily bars count as daily bars."""
    clean = rows.withColumns({"dimension": F.when(F.col("dimension") == "stock_daily_grouped", "stock_daily").otherwise(F.col("dimension")), "rows_written": F.greatest("rows_written", F.lit(0))})
    return upsert_update(freshness, clean.withColumn(ORDINAL, F.col("last_run_at")), ["dimension"])


def write_observed(df: DataFrame, path: str, dimension: str, run_at: Column, mode: str = "append") -> DataFrame:
    """Writes df as Parquet and gives its row for the freshness table; the rows written are counted by the write itself, not in a second pass.

    A write that fails gives a row with status failed and no rows, and its error is not raised: the freshness table tells of it.
    """
    spark, seen = df.sparkSession, Observation(f"written_{uuid.uuid4().hex}")
    n, status = 0, "ok"
    try:
        df.observe(seen, F.count("*").alias("rows")).write.mode(mode).parquet(path)
        n = seen.get["rows"]
    except Exception:  # whatever the write failed of
        status = "failed"
    row = spark.createDataFrame([(dimension, n, status)], "dimension string, rows_written long, status string")
    return row.select("dimension", run_at.alias("last_run_at"), "rows_written", "status")


def retention_trim(jobs: DataFrame, now: Column, keep_days: int, keep_max: int) -> DataFrame:
    """Drops finished rows older than keep_days, then keeps the keep_max newest finished ones; all other rows stay.

    The newest are found by a limit (a partial top in every task), not by ranking the whole log in one task."""
    finished = F.col("status").isin("done", "failed")
    fresh = jobs.where(finished & (F.coalesce("finished_at", "created_at").cast("timestamp") >= now.cast("timestamp") - F.make_interval(days=F.lit(keep_days))))
    return jobs.where(~F.coalesce(finished, F.lit(False))).unionByName(fresh.orderBy(F.col("finished_at").desc_nulls_last(), F.desc("id")).limit(keep_max))


def touch_updated_at(target: DataFrame, batch: DataFrame, key: str, now: Column, column: str = "updated_at") -> DataFrame:
    """Stamps the rows of every key in the batch, also those rows that the batch does not hold."""
    hit = batch.select(key).distinct().withColumn("_hit", F.lit(True))
    return target.join(hit, key, "left").withColumn(column, F.when(F.col("_hit"), now).otherwise(F.col(column))).select(*target.columns)


def first_seen(target: DataFrame, batch: DataFrame, keys: list[str], now: Column, seen: str = "first_seen_at", stamp: str = "updated_at") -> DataFrame:
    """Upsert in which a key keeps the time it was first seen at and is stamped anew."""
    return upsert_update(target, batch.withColumns({seen: now, stamp: now}), keys, [c for c in (*batch.columns, stamp) if c not in (*keys, seen, ORDINAL)])


def readiness_update(target: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the readiness table with the computed columns where their key was computed; other rows stay, and none is added."""
    values = [c for c in found.columns if c not in keys]
    n = found.select(*keys, *(F.col(c).alias(f"_n_{c}") for c in values), F.lit(True).alias("_hit"))
    return target.join(n, keys, "left").select(*(F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns))


def seed_holidays(target: DataFrame, legacy: DataFrame) -> DataFrame:
    """Legacy rows (exchange, holiday_date, name, label, status): name falls back to label, status to closed."""
    rows = legacy.select("exchange", "holiday_date", F.coalesce("name", "label").alias("name"), F.coalesce("status", F.lit("closed")).alias("status"))
    return upsert_update(target, rows, ["exchange", "holiday_date"])


def with_partition(df: DataFrame, day: str, unit: str) -> DataFrame:
    """Adds the column of a year or month layout; rows without a day go to the default partition."""
    value = F.year(day) if unit == "year" else F.date_format(day, "yyyy-MM")
    return df.withColumn(unit, F.coalesce(value.cast("string"), F.lit("default")))


def write_partitions(df: DataFrame, path: str, by: str) -> None:
    """Overwrites only the partitions that df holds. The contents are staged first, so df may read from path itself; the staged copy goes."""
    spark: SparkSession = df.sparkSession
    staged = f"{path.rstrip('/')}_staged_{uuid.uuid4().hex}"
    df.write.partitionBy(by).parquet(staged)
    fixed = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").schema(df.schema).parquet(staged)
    fixed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(staged)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """A partitioned table with all its columns, its partition column as text."""
    return spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", "false").option("mergeSchema", "true").parquet(path)


def upsert_partitions(path: str, batch: DataFrame, keys: list[str], by: str, upsert: Callable[[DataFrame, DataFrame, list[str]], DataFrame] = upsert_update) -> None:
    """Upserts a batch (with its partition column, which must follow from the keys) into a partitioned Parquet table.

    The table is read with its own columns, so a batch may hold some of them only. It is joined with the batch's partitions first, which prunes its scan to
    them; only these partitions are written. Rows without a partition value are a partition of their own, and are read if the batch holds any.
    """
    target = read_partitioned(batch.sparkSession, path)
    value = F.col(by).cast("string")
    touched = target.join(batch.select(value.alias(by)).where(f"{by} is not null").distinct(), by, "left_semi").select(*target.columns)
    if batch.where(F.col(by).isNull()).head(1):  # one row
        touched = touched.unionByName(target.where(F.col(by).isNull()))
    new = upsert(touched, batch.withColumn(by, value), [k for k in keys if k != by])
    write_partitions(new.select(*target.columns), path, by)


def replace_all(target: DataFrame, batch: DataFrame) -> DataFrame:
    """The batch in the table's columns; nothing of the old contents stays."""
    return batch.select(*target.columns)
