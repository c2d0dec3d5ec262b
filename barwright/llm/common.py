"""Helpers shared by the operators: table access, shared scratch tables, connected components."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words: the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; the locale-aware lower() would also change other letters."""
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo the number of folds."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def unused(df: DataFrame, name: str) -> str:
    """The name, lengthened until df has no such column."""
    while name in df.columns:
        name += "_"
    return name


def unit_hash(*cols: Column) -> Column:
    """Repeatable pseudo-random number in [0, 1) of the values."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double")) / float(1 << 53)


def bounded_batches(spark: SparkSession, rows: int = 512) -> SparkSession:
    """Hands Python workers at most so many texts at once, unless the session sets a smaller number; 10,000 long texts do not fit in a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)
    return spark


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """Sets a session's configuration for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, from spark.checkpoint.dir; a temporary one only where that is unset (tests)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if spark.conf.get("spark.master", "local").partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def stored(df: DataFrame, **options: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: cuts the lineage and survives lost executors. options: the writer's.

    Spark drops the shuffle files of the write when it has ended, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path, **options)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of edges (a, b): rows (node, root), root being the smallest node reachable.

    Alternates large-star and small-star steps until the edges are stars. No group of edges is collected: each step
    is a grouped minimum and a join back. Isolated nodes do not occur in the result; an empty input gives no rows.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    e = stored(e)
    before = None
    for _ in range(rounds):
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(low.where("a <> m").select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = stored(small.union(low.select("a", F.col("m").alias("b"))).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).union(e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
