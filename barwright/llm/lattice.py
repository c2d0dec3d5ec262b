"""Near-duplicate embeddings by E8 lattice hashing."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, stored, table

#: Hash tables; eight-dimensional blocks whose lattice points make up a cell; scale of the projections against the lattice; neighbours probed per block.
TABLES, BLOCKS, SCALE, NEIGHBOURS = 8, 2, 0.45, 2
#: Vectors filed in one cell beyond which its pairs are counted in blocks, and how many vectors make up a side of a block on average.
CROWDED, CHUNK = 64, 1024
#: Signs of random projections that two vectors may differ in, of 64; at a cosine of 0.95 some 6 do, and one pair in a million differs in more.
MOST_SIGNS = 20


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: +-e_i +- e_j, and halves of all signs with an even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    halves = [np.array(s) for s in itertools.product((0.5, -0.5), repeat=8)]
    return np.array(out + [h for h in halves if (h < 0).sum() % 2 == 0])


def _nearest_d8(y: np.ndarray) -> np.ndarray:
    """Nearest integer points with even coordinate sum: round, and move the worst coordinate the other way where the sum is odd."""
    r = np.rint(y)
    e = y - r
    odd = np.flatnonzero(r.sum(1) % 2)
    worst = np.abs(e[odd]).argmax(1)
    r[odd, worst] += np.where(e[odd, worst] >= 0, 1, -1)
    return r


def nearest_e8(y: np.ndarray) -> np.ndarray:
    """Nearest E8 lattice points of rows y: the better one of D8 and of D8 shifted by one half."""
    a, b = _nearest_d8(y), _nearest_d8(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1))[:, None], a, b)


def cells(x: np.ndarray, t: int, blocks: int = BLOCKS, scale: float = SCALE, neighbours: int = NEIGHBOURS) -> list[np.ndarray]:
    """Cell numbers of unit vectors in table t: the own cell first, then the neighbouring cells to probe."""
    rng = np.random.default_rng([t, x.shape[1]])
    numbers = rng.integers(1, 2**62, (blocks, 8))
    roots = minimal_vectors()
    own, moved = np.zeros(len(x), np.int64), []
    for b in range(blocks):
        matrix = rng.standard_normal((x.shape[1], 8)) * scale
        y = x @ matrix + rng.random(8)
        point = nearest_e8(y)
        towards = (y - point) @ roots.T  # the nearer neighbours lie where the remainder points to
        order = np.argsort(-towards, axis=1)[:, :neighbours]
        own += (2 * point).astype(np.int64) @ numbers[b]
        moved.append([(2 * roots[order[:, i]]).astype(np.int64) @ numbers[b] for i in range(neighbours)])
    single = [own + m for block in moved for m in block]
    double = [own + a[0] + b[0] for a, b in itertools.combinations(moved, 2)]
    return [own, *single, *double]


def signs(x: np.ndarray) -> np.ndarray:
    """The signs of 64 random projections of each row as one number."""
    planes = np.random.default_rng([64, x.shape[1]]).standard_normal((x.shape[1], 64))
    return np.packbits(x @ planes > 0, axis=1).view(np.int64)[:, 0]


def hashed(classes: DataFrame, tables: int = TABLES, blocks: int = BLOCKS, scale: float = SCALE) -> DataFrame:
    """Rows (t, cell, rep, own, signs): the cells in which each class representative is filed (own) or looks for others."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby(batch["embedding"].map(len)):
                for lo in range(0, len(part), 2048):
                    some = part.iloc[lo : lo + 2048]
                    x = np.stack([np.asarray(v, np.float64) for v in some["embedding"]])
                    x = x / np.linalg.norm(x, axis=1, keepdims=True)
                    rep, sign = some["rep"].to_numpy(), signs(x)
                    for t in range(tables):
                        found = cells(x, t, blocks, scale)
                        own = np.repeat(np.arange(len(found)) == 0, len(rep))
                        yield pd.DataFrame({"t": t, "cell": np.concatenate(found), "rep": np.tile(rep, len(found)), "own": own, "signs": np.tile(sign, len(found))})

    return classes.select("rep", "embedding").mapInPandas(emit, "t int, cell long, rep long, own boolean, signs long")


def _marked(classes: DataFrame, filed: DataFrame, crowded: DataFrame) -> DataFrame:
    """classes with own_c and probe_c, the crowded cells in which a class is filed or looks for others."""
    met = filed.join(crowded, ["t", "cell"]).groupBy("rep").agg(F.collect_set(F.when(F.col("own"), F.col("key"))).alias("own_c"), F.collect_set("key").alias("probe_c"))
    return classes.join(met, "rep", "left")


def _memberships(lists: pd.Series, keys: np.ndarray) -> np.ndarray:
    """Matrix that says which of the sorted keys each list holds."""
    out = np.zeros((len(lists), len(keys)), np.float32)
    if len(keys):
        owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        flat = np.concatenate([np.asarray(x, np.int64) for x in lists])
        at = np.minimum(np.searchsorted(keys, flat), len(keys) - 1)
        held = keys[at] == flat
        out[owner[held], at[held]] = 1
    return out


def block_links(probing: pd.DataFrame, filed: pd.DataFrame, key: int, least: float) -> pd.DataFrame:
    """Rows (rep, others, root) for the links between two sides of a crowded cell: the sum of the sizes of those a class links with, and
    the smallest class that it reaches within the block.

    Of the crowded cells in which a pair meets only that with the smallest key counts it.
    """
    unit = lambda side: (x := np.stack(side["embedding"])) / np.linalg.norm(x, axis=1, keepdims=True)
    a, b = probing["rep"].to_numpy(), filed["rep"].to_numpy()
    once = np.where(probing["own"].to_numpy()[:, None], a[:, None] < b, a[:, None] != b)  # two that are filed here probe each other
    hit = once & (unit(probing) @ unit(filed).T >= least)
    keys = np.unique(np.concatenate([np.zeros(0, np.int64), *probing["probe_c"], *filed["probe_c"]]).astype(np.int64))
    keys = keys[keys < key]
    before = _memberships(probing["probe_c"], keys) @ _memberships(filed["own_c"], keys).T + _memberships(probing["own_c"], keys) @ _memberships(filed["probe_c"], keys).T
    hit &= before == 0
    root_a, root_b, top = a.copy(), b.copy(), np.iinfo(np.int64).max
    while True:
        new_a = np.minimum(root_a, np.where(hit, root_b, top).min(1, initial=top))
        new_b = np.minimum(root_b, np.where(hit, new_a[:, None], top).min(0, initial=top))
        if (new_a == root_a).all() and (new_b == root_b).all():
            break
        root_a, root_b = new_a, new_b
    out = pd.DataFrame({"rep": np.concatenate([a, b]), "others": np.concatenate([hit @ filed["size"].to_numpy(), probing["size"].to_numpy() @ hit]), "root": np.concatenate([root_a, root_b])})
    return out[out["others"] > 0]


def crowded_links(classes: DataFrame, filed: DataFrame, crowded: DataFrame, least: float, chunk: int = CHUNK) -> DataFrame:
    """Rows (rep, others, root) of `block_links` for all crowded cells. classes: with own_c and probe_c.

    Both sides of a cell are dealt to chunks, and every pair of chunks is one group of some 2 * chunk vectors, which gives a row for each
    of its vectors and not for each of its pairs.
    """
    cells_ = crowded.withColumns({"chunks_own": F.ceil(F.col("n_own") / chunk), "chunks_all": F.ceil(F.col("n_all") / chunk)})
    held = filed.join(cells_, ["t", "cell"])
    chunk_of = lambda n: F.pmod(F.xxhash64("rep"), F.col(n))
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    probing = held.select("key", "rep", "own", chunk_of("chunks_all").alias("i"), spread("chunks_own").alias("j"), F.lit(True).alias("probing"))
    owning = held.where("own").select("key", "rep", "own", spread("chunks_all").alias("i"), chunk_of("chunks_own").alias("j"), F.lit(False).alias("probing"))
    rows = probing.unionByName(owning).join(classes, "rep").withColumn("dim", F.size("embedding"))

    def counted(rows: pd.DataFrame) -> pd.DataFrame:
        probing = rows["probing"]
        return block_links(rows[probing], rows[~probing], int(rows["key"].iloc[0]), least)

    return rows.groupBy("key", "i", "j", "dim").applyInPandas(counted, "rep long, others long, root long")


def near_duplicates(
    vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector: str = "embedding", tables: int = TABLES, blocks: int = BLOCKS, scale: float = SCALE,
    crowd: int = CROWDED, chunk: int = CHUNK,
) -> DataFrame:
    """One row per vector: id, n_links, component_id, kept.

    Vectors are scaled by their largest component, so that no product leaves the range of doubles; those then equal form a class that is
    hashed once, whose members link with each other. They are projected at random into blocks of eight dimensions and decoded to E8
    lattice points; a class is filed under its own cell of every table and fetches what is filed there and in the neighbouring cells nearest
    to it. Of the pairs fetched those with too many different signs of random projections go, and each distinct pair left is checked by its
    cosine in double precision. Where over `crowd` classes are filed in a cell, its pairs are
    counted in blocks instead of being listed. Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and
    so do vectors of different lengths. Rows that repeat an id stay and count as other vectors; rows with a null id count as vectors, too, and
    their component is that of the others, or null. Other columns are ignored, so names can't clash; an empty table gives no row.
    """
    v = F.col("embedding")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("embedding"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    scaled = F.transform(F.array(F.array_max(F.transform(v, F.abs))), lambda top: F.transform(v, lambda x: x / top + F.lit(0.0)))[0]
    rows = rows.withColumn("embedding", F.when(F.coalesce(finite, F.lit(False)), scaled))
    grouped = rows.where(v.isNotNull()).groupBy("embedding").agg(F.min("id").alias("first"), F.count("*").alias("size"))
    classes = stored(grouped.withColumn("rep", F.monotonically_increasing_id()))
    filed = stored(hashed(classes, tables, blocks, scale))
    sizes = filed.groupBy("t", "cell").agg(F.count_if("own").alias("n_own"), F.count("*").alias("n_all"))
    crowded = stored(sizes.where(F.col("n_own") > crowd).withColumn("key", F.xxhash64("t", "cell")))
    marked = stored(_marked(classes, filed, crowded))
    probes = filed.select("t", "cell", F.col("rep").alias("a"), F.col("signs").alias("sa"))
    own = filed.where("own").join(crowded, ["t", "cell"], "left_anti").select("t", "cell", F.col("rep").alias("b"), F.col("signs").alias("sb"))
    alike = F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= MOST_SIGNS
    pairs = probes.join(own, ["t", "cell"]).where((F.col("a") != F.col("b")) & alike).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    side = lambda k: marked.select(F.col("rep").alias(k), F.col("embedding").alias(f"v{k}"), F.col("size").alias(f"n{k}"), F.col("own_c").alias(f"o{k}"), F.col("probe_c").alias(f"p{k}"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, z: s + z)
    va, vb = F.col("va"), F.col("vb")
    counted = F.coalesce(F.arrays_overlap("oa", "pb") | F.arrays_overlap("pa", "ob"), F.lit(False))  # in a block
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(~counted & (F.size("va") == F.size("vb")) & (dot(va, vb) / (F.sqrt(dot(va, va)) * F.sqrt(dot(vb, vb))) >= least))
    links = stored(near.select("a", "b", "na", "nb"))
    in_blocks = stored(crowded_links(marked, filed, crowded, least, chunk))
    other = links.select(F.col("a").alias("rep"), F.col("nb").alias("n")).union(links.select(F.col("b").alias("rep"), F.col("na").alias("n")))
    other = other.union(in_blocks.select("rep", F.col("others").alias("n"))).groupBy("rep").agg(F.sum("n").alias("others"))
    edges = links.select("a", "b").union(in_blocks.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    comp = components(edges).withColumnsRenamed({"node": "rep"})
    known = classes.join(other, "rep", "left").join(comp, "rep", "left").withColumn("root", F.coalesce("root", "rep"))
    lowest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = known.join(lowest, "root").select("embedding", (F.col("size") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    linked = rows.where(v.isNotNull()).join(known, "embedding").select("id", "n_links", "component_id")
    alone = rows.where(v.isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.union(alone).withColumn("kept", F.col("id") == F.col("component_id"))
    return out.withColumnRenamed("id", id_col)


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings at a cosine of 0.95 or more."""
    return near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
