"""Near-duplicate documents by SimHash and multi-index hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, components, stored, table

#: Fingerprints in one segment bucket from which its links are found over whole-fingerprint balls instead.
HOT_BUCKET = 32


def fingerprint(text: str | None, width: int = 3) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included; no word gives 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = len(words) - width + 1
    if n <= 1:
        return digest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: n - 1].tolist()]
    h = np.fromiter((digest(joined[a:b], 42) for a, b in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=True)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(h[i : i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", width: int = 3) -> DataFrame:
    """Adds fp: the fingerprint of each text as a signed long of the same 64 bits."""
    bounded_batches(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.fromiter((fingerprint(t, width) for t in batch), np.uint64, len(batch)).view(np.int64))

    return docs.withColumn("fp", fp(F.col(text)))


def hex16(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def _half(fp: Column, segment: int) -> Column:
    return F.shiftrightunsigned(fp, 32) if segment == 0 else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def links(fps: DataFrame, hot: int = HOT_BUCKET) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints at Hamming distance 2 or less whose components are those of all such pairs.

    fps: distinct values in column fp. Each fingerprint has two 32-bit segments. If two fingerprints differ in at most
    2 bits, one segment differs in at most 1: every fingerprint enumerates the radius-1 ball of each segment (33 values),
    fetches the fingerprints filed under these values, and verifies the whole distance. A segment value under which over
    `hot` fingerprints are filed is not fetched: whoever would probe it continues the ball over the whole fingerprint
    (65 values; two fingerprints are within 2 bits exactly if their radius-1 balls meet, and at most 65 meet in one value),
    so no link is lost and the work stays linear in the group's size.
    """
    index = fps.select("fp", F.posexplode(F.array(_half(F.col("fp"), 0), _half(F.col("fp"), 1))).alias("segment", "value"))
    flips = F.expr("concat(array(0L), transform(sequence(0, 31), i -> shiftleft(1L, i)))")
    probes = index.select("fp", "segment", F.explode(F.transform(flips, lambda m: F.col("value").bitwiseXOR(m))).alias("value"))
    crowded = index.groupBy("segment", "value").count().where(F.col("count") > hot).select("segment", "value")
    filed = index.join(crowded, ["segment", "value"], "left_anti")
    near = (
        probes.withColumnRenamed("fp", "a")
        .join(filed.withColumnRenamed("fp", "b"), ["segment", "value"])
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= 2))
        .select("a", "b")
    )
    wide = probes.join(crowded, ["segment", "value"], "left_semi").select("fp").distinct()
    ball = F.expr("concat(array(0L), transform(sequence(0, 63), i -> shiftleft(1L, i)))")
    met = (
        wide.select("fp", F.explode(F.transform(ball, lambda m: F.col("fp").bitwiseXOR(m))).alias("value"))
        .groupBy("value")
        .agg(F.sort_array(F.collect_list("fp")).alias("all"))  # 65 at most
        .where(F.size("all") > 1)
        .select(F.col("all")[0].alias("a"), F.explode(F.slice("all", 2, 64)).alias("b"))
    )
    return near.union(met).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", hot: int = HOT_BUCKET) -> DataFrame:
    """One row per document: id, fp, component_id, the smallest id reachable over links of 2 or fewer differing bits.

    Null and empty texts have fingerprint 0 and link like any other. Equal fingerprints form a class that enters the
    search once. Rows that repeat an id stay. Columns of docs other than these two are ignored.
    """
    prints = stored(fingerprints(docs.select(F.col(id_col), F.col(text).alias("text"))).select(F.col(id_col), "fp"))
    classes = prints.groupBy("fp").agg(F.min(id_col).alias("first"))
    comp = components(links(classes.select("fp"), hot)).withColumnRenamed("node", "fp")
    linked = classes.join(comp, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    return prints.join(linked.join(lowest, "root").select("fp", "component_id"), "fp")


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under SimHash links of 2 or fewer bits."""
    return near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", hex16(F.col("fp")).alias("fingerprint"), "component_id")
