"""Approximate nearest neighbours by cross-polytope hashing."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

#: Numbers of tables to choose from, and the share of the sample's true neighbours that must be met in a probed cell of one of them.
TABLES, TARGET = (2, 4, 8), 0.97
#: Vectors (of 64 components; fewer of longer ones) on which tables and probes are fitted, and how many of them act as queries there.
SAMPLE, TRIALS = 8192, 256
#: Components on each side of a block of products, and products that take as long as shipping one vector.
CHUNK, COPY = 1 << 18, 100
#: Candidates kept beyond those wanted while their products are those of matrices, whose last bits depend on the block.
SPARE = 12
#: Axes beyond which a cell is one axis, not a pair.
MOST_AXES = 512


class Space(NamedTuple):
    """How vectors of one length are hashed: the largest component, the largest norm after division by it, whether norms differ enough for
    vectors to be lifted, the rotations that make up a cell, tables, and cells probed in each."""

    top: float
    reach: float
    lifted: bool
    functions: int
    tables: int
    probes: int


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of rows, whose length is a power of two, scaled to keep norms."""
    n, half = x.shape[1], 1
    while half < n:
        pairs = x.reshape(len(x), -1, 2, half)
        x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(len(x), n)
        half *= 2
    return x / np.sqrt(n)


def axis_scores(x: np.ndarray, t: int, f: int) -> np.ndarray:
    """Inner products of each row with all signed axes after pseudo-rotation f of table t: three rounds of random signs and Hadamard."""
    signs = np.random.default_rng([t, f, x.shape[1]]).choice([-1.0, 1.0], (3, x.shape[1]))
    for s in signs:
        x = hadamard(x * s)
    return np.concatenate([x, -x], axis=1)


def on_sphere(v: np.ndarray, space: Space, query: bool) -> np.ndarray:
    """Unit vectors whose angles order candidates as their inner products with a query do.

    Where norms differ, a candidate gets one more component that fills it up to the largest norm; a query gets a zero there.
    """
    y = v / (np.abs(v).max(1, keepdims=True) if query else space.top)
    norm = np.linalg.norm(y, axis=1, keepdims=True)
    if space.lifted and not query:
        y = y / space.reach
        y = np.concatenate([y, np.sqrt(np.maximum(0, 1 - (y**2).sum(1, keepdims=True)))], axis=1)
    else:
        y = y / np.where(norm > 0, norm, 1)
    width = 1 << (v.shape[1] + space.lifted - 1).bit_length()
    return np.pad(y, ((0, 0), (0, width - y.shape[1])))


def own_cell(x: np.ndarray, t: int, functions: int) -> np.ndarray:
    """The cell of each row in table t: its nearest signed axis after each rotation."""
    cell = np.zeros(len(x), np.int64)
    for f in range(functions):
        cell = cell * 2 * x.shape[1] + axis_scores(x, t, f).argmax(1)
    return cell


def cell_scores(x: np.ndarray, t: int, functions: int) -> np.ndarray:
    """How near each row is to the axes of every cell of table t."""
    scores = axis_scores(x, t, 0)
    for f in range(1, functions):
        scores = (scores[:, :, None] + axis_scores(x, t, f)[:, None, :]).reshape(len(x), -1)
    return scores


def probed_cells(x: np.ndarray, t: int, functions: int, probes: int) -> np.ndarray:
    """The cells of table t nearest to each row, in no order."""
    scores = cell_scores(x, t, functions)
    if probes >= scores.shape[1]:
        return np.tile(np.arange(scores.shape[1]), (len(x), 1))
    return np.argpartition(-scores, probes - 1, axis=1)[:, :probes]


def fit(sample: np.ndarray, top: float, reach: float, lifted: bool, n: int, k: int) -> Space:
    """The cheapest of several settings that meet TARGET on the sample.

    A query's k nearest of n vectors are about as near as its k * len(sample) / n nearest of the sample, so that many count as true neighbours here.
    """
    space = Space(top, reach, lifted, 1, TABLES[0], 1)
    queries = np.arange(min(TRIALS, len(sample)))
    products = sample[queries] @ sample.T
    products[queries, queries] = -np.inf
    want = min(max(1, round(k * len(sample) / n)), len(sample) - 1)
    filed, asking = on_sphere(sample, space, False), on_sphere(sample[queries], space, True)
    axes = 2 * filed.shape[1]
    if want == 0:
        return space._replace(probes=axes)
    true = np.argsort(-products, axis=1)[:, :want]
    best = None
    for functions in (1, 2) if axes <= MOST_AXES else (1,):
        ranks = []
        for t in range(max(TABLES)):
            own, rank = own_cell(filed, t, functions)[true], np.empty(true.shape)
            step = max(1, (1 << 22) // axes**functions)
            for lo in range(0, len(queries), step):
                scores = cell_scores(asking[lo : lo + step], t, functions)
                met = np.take_along_axis(scores, own[lo : lo + step], 1)
                ordered = np.sort(scores, axis=1)
                rank[lo : lo + step] = [scores.shape[1] - np.searchsorted(o, m, "right") for o, m in zip(ordered, met, strict=True)]
            ranks.append(rank)
        for tables in TABLES:
            probes = 1 + int(np.quantile(np.min(ranks[:tables], axis=0), TARGET, method="higher"))
            cost = tables * probes * n / axes**functions + COPY * tables * (probes + n / max(1, n // 20))
            if best is None or cost < best[0]:
                best = cost, space._replace(functions=functions, tables=tables, probes=probes)
    return best[1]


def spaces(classes: DataFrame, k: int) -> dict[int, Space]:
    """Fitted settings for each length of vectors, from about SAMPLE distinct vectors picked by their hash; an embedding table has few lengths."""
    v = F.col("v")
    by_length = classes.groupBy(F.size(v).alias("dim")).agg(F.max(F.array_max(F.transform(v, F.abs))).alias("top"), F.count("*").alias("n")).collect()
    out = {}
    for r in by_length:
        some = classes.where(F.size(v) == r["dim"])
        norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + (x / F.lit(r["top"])) * (x / F.lit(r["top"]))))
        low, reach = some.agg(F.min(norm), F.max(norm)).first()
        parts = max(1, r["n"] * max(r["dim"], 64) // (SAMPLE * 64))
        rows = some.where(F.pmod(F.xxhash64("v"), F.lit(parts)) == 0).select("v").orderBy(F.xxhash64("v")).collect()
        sample = np.array([x["v"] for x in rows]).reshape(len(rows), r["dim"])
        lifted = low < 0.99 * reach
        out[r["dim"]] = fit(sample, r["top"], reach, lifted, r["n"], k) if len(rows) else Space(r["top"], reach, lifted, 1, TABLES[0], 1 << 62)
    return out


def hashed(classes: DataFrame, settings: dict[int, Space]) -> DataFrame:
    """Rows (rep, first, dim, vector, filed, probed): the cell of each class in every table, and for those that hold queries the cells to search."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, part in batch.groupby(batch["v"].map(len)):
                space = settings[dim]
                for lo in range(0, len(part), 256):
                    some = part.iloc[lo : lo + 256]
                    v = np.stack(some["v"]).astype(np.float64)
                    own = np.stack([own_cell(on_sphere(v, space, False), t, space.functions) for t in range(space.tables)], axis=1)
                    asks, probed = np.flatnonzero(some["wanted"]), [None] * len(some)
                    if len(asks):
                        x = on_sphere(v[asks], space, True)
                        found = [probed_cells(x, t, space.functions, space.probes) for t in range(space.tables)]
                        for i, cells in zip(asks, zip(*found, strict=True), strict=True):
                            probed[i] = [{"t": t, "cell": c} for t, row in enumerate(cells) for c in row.tolist()]
                    filed = [[{"t": t, "cell": c} for t, c in enumerate(row)] for row in own.tolist()]
                    yield pd.DataFrame({"rep": some["rep"], "first": some["first"], "dim": dim, "vector": [x.tobytes() for x in v], "filed": filed, "probed": probed})

    cells = "array<struct<t int, cell long>>"
    return classes.select("rep", "first", "v", "wanted").mapInPandas(emit, f"rep long, first long, dim int, vector binary, filed {cells}, probed {cells}")


def block_best(filed: pd.DataFrame, probing: pd.DataFrame, k: int) -> pd.DataFrame:
    """Rows (q, rep, first, score): the k best of a block for each query class, ties to the smaller first id.

    A matrix product finds some more than k; their products are then summed one by one, so that a pair has the same score in every block.
    """
    matrix = lambda blobs: np.frombuffer(b"".join(blobs), np.float64).reshape(len(blobs), -1)
    x, y = matrix(filed["vector"]), matrix(probing["vector_"])
    rep, first, q = filed["rep"].to_numpy(), filed["first"].to_numpy(), probing["q"].to_numpy()
    order = np.lexsort((rep, first))
    x, rep, first = x[order], rep[order], first[order]
    few, out = min(k + SPARE, len(x)), []
    step = max(1, CHUNK // max(len(x), few * x.shape[1]))
    with np.errstate(over="ignore", invalid="ignore"):
        for lo in range(0, len(y), step):
            some = y[lo : lo + step]
            near = np.nan_to_num(some @ x.T, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
            picked = np.sort(np.argpartition(-near, few - 1, axis=1)[:, :few], axis=1)
            score = np.nan_to_num((x[picked] * some[:, None, :]).sum(2), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
            best = np.argsort(-score, axis=1, kind="stable")[:, :k]  # picked is in order of first
            picked, score = np.take_along_axis(picked, best, 1), np.take_along_axis(score, best, 1)
            out.append(pd.DataFrame({"q": np.repeat(q[lo : lo + step], picked.shape[1]), "rep": rep[picked].ravel(), "first": first[picked].ravel(), "score": score.ravel()}))
    return pd.concat(out)


def candidates(hashes: DataFrame, k: int, chunk: int = CHUNK) -> DataFrame:
    """Rows (q, rep, first, score), the k best of every block: the classes filed in a cell against the query classes that probe it.

    Both sides of a cell are dealt to chunks of some `chunk` components, so a crowded cell makes many blocks, each a group of bounded size.
    """
    at = lambda cells: F.inline(cells)
    filed = hashes.select("rep", "first", "dim", "vector", at("filed"))
    probing = hashes.where(F.col("probed").isNotNull()).select("rep", "dim", "vector", at("probed"))
    cell = ["dim", "t", "cell"]
    count = lambda df, name: df.groupBy(cell).agg(F.ceil(F.count("*") * F.col("dim") / chunk).alias(name))
    sizes = stored(count(filed, "n_filed").join(count(probing, "n_probing"), cell))
    dealt = lambda n: F.pmod(F.xxhash64("rep"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    filed = filed.join(sizes, cell).select(*cell, "rep", "first", "vector", dealt("n_filed").alias("i"), every("n_probing").alias("j"))
    probing = probing.join(sizes, cell).select(*cell, F.col("rep").alias("q"), "vector", every("n_filed").alias("i"), dealt("n_probing").alias("j"))
    block = [*cell, "i", "j"]
    probing = probing.toDF(*(f"{c}_" if c in block else c for c in probing.columns)).withColumnRenamed("vector", "vector_")

    def best(filed: pd.DataFrame, probing: pd.DataFrame) -> pd.DataFrame:
        if not len(filed) or not len(probing):
            return pd.DataFrame({"q": [], "rep": [], "first": [], "score": []})
        return block_best(filed, probing, k)

    return filed.groupBy(block).cogroup(probing.groupBy([f"{c}_" for c in block])).applyInPandas(best, "q long, rep long, first long, score double")


def neighbours(vectors: DataFrame, wanted: Column, k: int = 20, id_col: str = "vec_id", vector: str = "embedding", chunk: int = CHUNK) -> DataFrame:
    """For each row for which `wanted` holds, the k other rows found with the largest inner product: (query_id, rank, id, score).

    Vectors are lifted to the unit sphere, turned by three rounds of random signs and fast Hadamard transforms, and filed under the nearest signed axis (or pair of
    axes) in several tables. A query probes the cells nearest to it in each; all classes of equal vectors filed there are its candidates, and are ranked by their
    exact products. Tables, probes and axes are fitted on a bounded sample (SAMPLE), so that TARGET of the true neighbours are met; every row is filed, and
    nothing caps a cell. Equal vectors are one class, searched once, and stand for all their rows; of a class its k + 1 smallest ids are enough.

    Vectors that are null, empty, zero or hold null or non-finite components take no part, and only vectors of equal length are compared. Equal scores go by id,
    null ids last. A row whose id is null or repeated is a row of its own: it is a candidate of every other, and a query if `wanted` holds. Products beyond the range of
    doubles are infinite; those without a value count as minus infinity. Other columns are ignored but in `wanted`; an empty table gives no row.
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(wanted, F.lit(False)).alias("wanted"))
    rows = rows.where(F.coalesce(finite, F.lit(False))).withColumn("v", F.transform(v, lambda x: x + F.lit(0.0)))
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()))
    last = F.lit((1 << 63) - 1)
    classes = rows.groupBy("v").agg(F.coalesce(F.min("id"), last).alias("first"), F.max("wanted").alias("wanted"))
    classes = stored(classes.withColumn("rep", F.monotonically_increasing_id()))
    members = stored(rows.join(classes.select("v", "rep"), "v").select("rep", "id", "row", "wanted"))
    by_id = Window.partitionBy("rep").orderBy(F.col("id").asc_nulls_last(), "row")
    lowest = members.withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1).select("rep", "id", "row")

    hashes = stored(hashed(classes, spaces(classes, k)))
    found = candidates(hashes, k + 1, chunk)
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "first", "rep")
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= (k + 1) * max(TABLES))  # a class is met once a table at most
    found = found.groupBy("q", "rep", "first").agg(F.max("score").alias("score"))
    found = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).select("q", "rep", "score")
    ranked = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    near = found.join(lowest, "rep").withColumn("n", F.row_number().over(ranked)).where(F.col("n") <= k + 1)
    lists = near.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("n", "id", "row", "score"))).alias("near"))
    asked = members.where("wanted").select(F.col("rep").alias("q"), F.col("id").alias("query_id"), F.col("row").alias("own"))
    others = asked.join(lists, "q").select("query_id", F.slice(F.filter("near", lambda x: x["row"] != F.col("own")), 1, k).alias("near"))
    out = others.select("query_id", F.posexplode("near").alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.id").alias(id_col), F.col("x.score").alias("score"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth embedding, by inner product."""
    return neighbours(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)
