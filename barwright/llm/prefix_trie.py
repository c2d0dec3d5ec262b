"""Prefix trie of conversations, with totals of all subtrees by depth-band rollup."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, stored, table

#: Depths in a band: a node is added to at most so many ancestors at once, and no window is longer.
BAND = 16
#: Conversations of a block share the first turns of its first conversation: so many at most.
BLOCK, HEADS = 20, 4
NOBODY = hashlib.sha256(b"").hexdigest()


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first one of its block."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def laid_out(turns: DataFrame, conversation: str, turn: str, role: str, text: str) -> DataFrame:
    """Rows (conv, seq, a, b, words): a number that grows with the place in the whole table, 128 bits of the turn's digest, and its words.

    The table is sorted as a whole, in ranges, so that not even a conversation that holds most rows, or a row that repeats, goes to one task.
    """
    rows = turns.where(F.col(conversation).isNotNull()).select(
        F.col(conversation).cast("long").alias("conv"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    rows = rows.withColumn("at", F.monotonically_increasing_id())
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("at")]
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")).cast("binary"), 256)
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("digest", digest)
    half = lambda at: F.xxhash64(F.substring("digest", at, 32))
    return stored(rows.select("conv", F.monotonically_increasing_id().alias("seq"), half(1).alias("a"), half(33).alias("b"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("words")))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (conv, d, a, b, words, last) of the rebuilt conversations' turns d = 1, 2, ..., and (conv, n) of all, n being their turns. turns: of `laid_out`.

    A run is what a conversation holds of one range of the sorted table; places within runs are known from seq, and a
    conversation has no more runs than there are ranges.
    """
    run = F.shiftright("seq", 33)
    runs = turns.groupBy("conv", run.alias("run")).agg(F.min("seq").alias("low"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = stored(runs.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))
    convs = runs.groupBy("conv").agg(F.sum("n").alias("own")).withColumns({"h": shared_turns(F.col("conv")), "base": F.col("conv") - F.col("conv") % BLOCK})
    bases = convs.where("conv = base").select("base", F.col("own").alias("has"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("has", F.lit(0))))
    convs = stored(convs.withColumn("n", F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))))
    placed = turns.withColumn("run", run).join(runs.select("conv", "run", "low", "before"), ["conv", "run"]).withColumn("place", F.col("seq") - F.col("low") + F.col("before") + 1)
    # few of a conversation's rows are wanted as heads; its own rows meet their lengths run by run, not all at once
    heads = placed.where((F.col("place") < HEADS) & (F.col("conv") % BLOCK == 0)).select(F.col("conv").alias("base"), "place", "a", "b", "words")
    heads = convs.select("conv", "base", "h", "n").join(heads, "base").where("place <= h").select("conv", F.col("place").alias("d"), "a", "b", "words", "n")
    sizes = runs.select("conv", "run").join(convs.select("conv", "h", "taken", "n"), "conv")
    own = placed.join(sizes, ["conv", "run"]).where("place > h").select("conv", (F.col("taken") + F.col("place") - F.col("h")).alias("d"), "a", "b", "words", "n")
    rows = heads.unionByName(own).withColumn("last", F.col("d") == F.col("n")).drop("n")
    return rows, convs.select("conv", "n")


def running_xor(rows: DataFrame, longest: int) -> DataFrame:
    """rows (conv, d, x, y, ...) with the exclusive ors k, l of x and y over all of the conversation's rows up to d, d being 1 to longest.

    Bands are summed first, then the bands of bands, and so on; each window is a band long.
    """
    band = F.floor((F.col("d") - 1) / BAND)
    until = Window.partitionBy("conv", "band").orderBy("d")
    within = rows.withColumn("band", band).withColumns({"k": F.bit_xor("x").over(until), "l": F.bit_xor("y").over(until)})
    if longest <= BAND:
        return within.drop("band")
    totals = rows.groupBy("conv", (band + 1).alias("d")).agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    carried = running_xor(totals, -(-longest // BAND)).select("conv", F.col("d").alias("band"), F.col("k").alias("k0"), F.col("l").alias("l0"))
    add = lambda c: F.col(c).bitwiseXOR(F.coalesce(f"{c}0", F.lit(0))).alias(c)
    return within.join(carried, ["conv", "band"], "left").select(*rows.columns, add("k"), add("l"))


def end_digests(ends: DataFrame) -> DataFrame:
    """Rows (k, l, ends): for each node (k, l) the SHA-256 of its conversations' numbers, ascending and joined by commas. ends: (k, l, conv).

    The numbers are sorted in ranges and joined piece by piece; a node's few pieces are then read one after the other by one task, which keeps none.
    """
    order = ["k", "l", "conv"]

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            k, l, conv = (batch[c].to_numpy() for c in order)  # noqa: E741
            new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (l[1:] != l[:-1])])) if len(k) else []
            parts = [",".join(map(str, c.tolist())) for c in np.split(conv, new[1:])] if len(k) else []
            yield pd.DataFrame({"k": k[new], "l": l[new], "first": conv[new], "piece": parts}) if len(k) else pd.DataFrame({c: [] for c in ("k", "l", "first", "piece")})

    def digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        node, sha = None, None
        for batch in batches:
            done = []
            for *key, piece in zip(batch["k"].tolist(), batch["l"].tolist(), batch["piece"], strict=True):
                if key == node:
                    sha.update(b"," + piece.encode())
                    continue
                if node:
                    done.append((*node, sha.hexdigest()))
                node, sha = key, hashlib.sha256(piece.encode())
            yield pd.DataFrame(done, columns=["k", "l", "ends"])
        if node:
            yield pd.DataFrame([(*node, sha.hexdigest())], columns=["k", "l", "ends"])

    parted = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(pieces, "k long, l long, first long, piece string")
    return parted.repartition("k", "l").sortWithinPartitions("k", "l", "first").mapInPandas(digests, "k long, l long, ends string")


def subtree_sums(nodes: DataFrame, paths: DataFrame, deepest: int, *values: str, step: int = 1) -> DataFrame:
    """Rows (k, l, values): sums of the values over each node's subtree, itself included.

    nodes: (k, l, conv_id, depth, values), conv_id being a conversation through the node; paths: (conv, d, k, l), the nodes on the way of each conversation.
    A node is added only to its ancestors within its band of BAND depths. The bands' topmost nodes then hold the totals of their
    part of the band, and make up a tree of their own, of a BAND-th of the depth, on which the same is done (there `step` is the distance of its depths).
    Their complete totals go back down: each is added to the ancestors in the band above it. So a node goes to at most BAND ancestors on each level, and
    there are log(deepest) levels.
    """
    wide = step * BAND
    band = lambda d: F.floor(d / wide)
    on_way = paths.where(F.col("d") % step == 0).select("conv", "d", "k", "l")

    def spread(some: DataFrame, at: Column) -> DataFrame:
        """Values of nodes, added to the nodes on their way in the band of depth `at`, down to it."""
        lower = some.select(F.col("conv_id").alias("conv"), at.alias("at"), band(at).alias("band"), *values)
        met = lower.join(on_way.withColumn("band", band(F.col("d"))), ["conv", "band"]).where("d <= at")
        return met.groupBy("k", "l").agg(*(F.sum(v).alias(v) for v in values))

    own = stored(spread(nodes, F.col("depth")))
    if deepest < wide:
        return own
    place = nodes.where(F.col("depth") % wide == 0).select("k", "l", "conv_id", "depth")
    tops = place.join(own, ["k", "l"])
    whole = subtree_sums(tops, paths, deepest, *values, step=wide)
    below = place.where("depth > 0").join(whole, ["k", "l"])
    return stored(own.unionByName(spread(below, F.col("depth") - 1)).groupBy("k", "l").agg(*(F.sum(v).alias(v) for v in values)))


def prefix_trie(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node of the trie of rebuilt conversations: (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).

    A conversation c is rebuilt from the first h turns of c - c % 20 and its own turns after its first h, h being crc32(c) % 4. A node is a distinct sequence
    of first turns (role and text), named by the smallest of its conversations and its depth; the root has none. Nodes are told apart by 128 bits: the exclusive or
    of the hashes of (place, turn) along the sequence. saved_tokens is what a subtree saves if the words of shared turns are kept once.

    Turns go by `turn`, null first, then by role and text; rows that repeat are turns of their own. Null roles and texts are empty. Rows with a null conversation
    belong to none and are left out. A conversation left without turns is a member of the root alone. Other columns are ignored, so names can't clash; an
    empty table gives no row. A conversation that holds most rows is sorted and added up by ranges and bands, never as one group.
    """
    rows, convs = rebuilt(laid_out(turns, conversation, turn, role, text))
    deepest = convs.agg(F.max("n")).first()[0]
    at = lambda i: F.xxhash64(F.lit(i), "d", "a", "b")
    keyed = running_xor(rows.select("conv", "d", at(1).alias("x"), at(2).alias("y"), "words", "last"), max(deepest or 1, 1))
    keyed = keyed.select("conv", "d", "k", "l", F.col("k").bitwiseXOR(F.col("x")).alias("pk"), F.col("l").bitwiseXOR(F.col("y")).alias("pl"), "words", "last")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    roots = convs.select("conv", zero.alias("d"), zero.alias("k"), zero.alias("l"), none.alias("pk"), none.alias("pl"), zero.alias("words"), (F.col("n") == 0).alias("last"))
    members = stored(keyed.unionByName(roots))
    nodes = members.groupBy("k", "l", F.col("d").alias("depth")).agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.max("pk").alias("pk"), F.max("pl").alias("pl"), F.max("words").alias("words")
    )
    nodes = stored(nodes)
    children = nodes.where("depth > 0").groupBy(F.col("pk").alias("k"), F.col("pl").alias("l")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("k").alias("pk"), F.col("l").alias("pl"), F.col("conv_id").alias("parent_conv_id"))
    known = nodes.join(children, ["k", "l"], "left").withColumn("n_children", F.coalesce("n_children", zero)).join(parents, ["pk", "pl"], "left")
    known = stored(known.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}))
    sums = subtree_sums(known.select("k", "l", "conv_id", "depth", "n_leaves", "saved_tokens"), members, deepest or 0, "n_leaves", "saved_tokens")
    ends = end_digests(members.where("last"))
    out = known.drop("n_leaves", "saved_tokens").join(sums, ["k", "l"]).join(ends, ["k", "l"], "left")
    numbers = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    return out.select(*(F.col(c).cast("long").alias(c) for c in numbers), F.coalesce("ends", F.lit(NOBODY)).alias("ends_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of the rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


# crc32 of a decimal number, bit by bit; 3988292384 is the reversed polynomial
_CRC = """xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(string_split({0}::varchar, ''), lambda s: ascii(s)::bigint)),
        lambda a, s: list_reduce(list_concat([xor(a, s)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda v, z: case when v % 2 = 1 then xor(v >> 1, 3988292384) else v >> 1 end)))"""

OP11_SQL = f"""
with given as (
    select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p
    from conversations where conv_id is not null
), convs as (select c, c - c % 20 as base, {_CRC.format("c")} % 4 as h from (select distinct c from given)
), parts as (
    select v.c, 0 as own, p, role, text from convs v join given g on g.c = v.base and p <= h
    union all select v.c, 1, p, role, text from convs v join given g on g.c = v.c and p > h
), placed as (select *, row_number() over (partition by c order by own, p) as d from parts
), keyed as (
    select *, sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') over (partition by c order by d)) as k, count(*) over (partition by c) as n from placed
), members as (
    select c, d, k, coalesce(lag(k) over (partition by c order by d), '') as pk, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) as words, d = n as last from keyed
    union all select v.c, 0, '', null, 0, not exists (select 1 from placed p where p.c = v.c) from convs v
), nodes as (
    select k, d, min(c) as c, any_value(pk) as pk, count(*) as n_convs, (count(*) - 1) * any_value(words) as saved, string_agg(c::varchar, ',' order by c) filter (last) as ends
    from members group by k, d
), children as (select pk as k, count(*) as n from nodes where d > 0 group by pk
), sums as (
    select m.k, count(*) filter (h.n is null) as n_leaves, sum(saved) as saved
    from nodes n join members m on m.c = n.c and m.d <= n.d left join children h on h.k = n.k group by m.k
)
select n.c as conv_id, cast(n.d as bigint) as depth, p.c as parent_conv_id, n.n_convs, coalesce(h.n, 0) as n_children, s.n_leaves, cast(s.saved as bigint) as saved_tokens,
    sha256(coalesce(n.ends, '')) as ends_sha256
from nodes n join sums s using (k) left join children h using (k) left join nodes p on p.k = n.pk
"""
