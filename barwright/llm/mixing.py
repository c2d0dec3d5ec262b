"""Mixing sources to target weights in blocks of fixed length, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, stored, table

#: Words of a block, slots of an output shard, and the number of neighbours whose sums, blocks or copies a task holds together at most.
BLOCK, SHARD, STRETCH = 64, 1024, 4096
#: Hash buckets in which the documents of a source are laid out at least, and about how many documents there are to a bucket beyond.
BUCKETS, IN_BUCKET = 1024, 256
#: A source gives at most so many times its words.
MOST = 3
#: Rounds of the index permutations; cells of an interval lookup.
ROUNDS, CELLS = 10, 4096
#: About how many slots a task draws and permutes.
SLOTS_IN_TASK = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MOST) -> DataFrame:
    """Adds sid (rank of the source by code point, null last) and target to rows (source, source_size), one for each source.

    Sources weigh `weights` in turn and share the sum of all sizes; no target is over `most` times its source's size. With level L the
    targets are min(weight * L, most * size): sources are taken by growing most * size / weight, and L is set by those that are not full.
    """
    n = len(weights)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % n + 1).cast("int")).cast("double")
    rows = sizes.withColumn("sid", F.row_number().over(order) - 1).withColumns({"w": w, "cap": most * F.col("source_size").cast("double")})
    growing = Window.orderBy(F.col("cap") / F.col("w"), "sid")
    before, rest = growing.rowsBetween(Window.unboundedPreceding, -1), growing.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(0))
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest)
    rows = rows.withColumns({"level": level, "place": F.row_number().over(growing)})
    final = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("place", "level"))).over(everything)["level"]  # the first that is not full
    return rows.withColumn("target", F.least(F.coalesce(F.col("w") * final, "cap"), "cap")).select("source", "source_size", "sid", "target")


def in_intervals(rows: DataFrame, at: str, intervals: DataFrame, end: int) -> DataFrame:
    """Joins rows with the interval [lo, hi) of [0, end) that holds their number `at`: an equality join on cells of numbers."""
    width = max(1, -(-end // CELLS))
    cells = intervals.where("hi > lo").withColumn("_cell", F.explode(F.sequence(F.expr(f"lo div {width}"), F.expr(f"(hi - 1) div {width}"))))
    return rows.withColumn("_cell", F.expr(f"{at} div {width}")).join(cells, "_cell").where(f"{at} >= lo and {at} < hi").drop("_cell", "lo", "hi")


def permuted(i: Column, n: Column, *key: Column) -> Column:
    """Image of i under a keyed permutation of 0 ... n-1: in every round, i and (k - i) mod n change places if a hash of the larger one says so."""

    def turn(x: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(r, *key), n) - x, n)
        return F.when(F.xxhash64(F.greatest(x, mirror), r, *key) % 2 == 0, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), i, turn)


def summed_before(rows: DataFrame, part: str, order: str, value: str, name: str, stretch: int = STRETCH) -> DataFrame:
    """Adds the sum of value over the rows of a part that have a smaller number `order`, in two levels, so no part goes to one task."""
    rows = rows.withColumn("_s", F.expr(f"{order} div {stretch}"))
    before = Window.partitionBy(part).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(part, "_s").agg(F.sum(value).alias("_n")).select(part, "_s", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy(part, "_s").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(sums, [part, "_s"]).withColumn(name, F.col("_before") + F.coalesce(F.sum(value).over(within), F.lit(0))).drop("_s", "_before")


def laid_out(sized: DataFrame) -> DataFrame:
    """Rows (sid, id, digest, size, copy, start) of rows (sid, id, digest of the text, size): start is the number of words before it in its source.

    Rows alike in all four columns are numbered by copy and stand together. Documents are dealt to hash buckets; sums of buckets are added
    up first, then the documents within a bucket, so neither a large source nor many copies of a row go to one task.
    """
    alike = stored(sized.groupBy("sid", "id", "digest", "size").agg(F.count("*").alias("copies")))
    buckets = max(BUCKETS, alike.count() // IN_BUCKET)
    rows = alike.withColumn("bucket", F.pmod(F.xxhash64("id", "digest"), F.lit(buckets))).withColumn("n", F.col("size") * F.col("copies"))
    offsets = summed_before(rows.groupBy("sid", "bucket").agg(F.sum("n").alias("all")), "sid", "bucket", "all", "offset").drop("all")
    within = Window.partitionBy("sid", "bucket").orderBy("id", "size", "digest").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(offsets, ["sid", "bucket"]).withColumn("first", F.col("offset") + F.coalesce(F.sum("n").over(within), F.lit(0)))
    rows = rows.withColumn("_s", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {STRETCH}"))))
    copy = F.explode(F.sequence(F.col("_s") * STRETCH, F.least(F.col("_s") * STRETCH + (STRETCH - 1), F.col("copies") - 1)))
    rows = rows.select("sid", "id", "digest", "size", "first", copy.alias("copy"))
    return rows.select("sid", "id", "digest", "size", "copy", (F.col("first") + F.col("copy") * F.col("size")).alias("start"))


def slots(sources: DataFrame, seed: int, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The mix as rows (shard, slot, sid, block): which block of which source stands in a slot of an output shard.

    sources: sid, source_size, target. A slot draws its source in proportion to the targets, which makes the counts of a shard multinomial.
    The draws of a source are numbered over all shards by sums of the counts of earlier shards. Where a source is drawn more
    often than its target allows, the draws beyond go to the sources that lack some, in order. Draw j of a source takes the block at
    place j mod n of the source's permutation number j div n.
    """
    spark = sources.sparkSession
    n = F.expr(f"(source_size + {block - 1}) div {block}")
    quota = F.least(MOST * n, F.round(F.col("target") * n / F.col("source_size")).cast("long"))
    plan = sources.where("source_size > 0").select("sid", n.alias("n"), quota.alias("quota"))
    hi = F.sum("quota").over(Window.orderBy("sid"))
    plan = stored(plan.withColumn("hi", hi).withColumn("lo", F.col("hi") - F.col("quota")))
    total = plan.agg(F.max("hi")).first()[0] or 0
    drawn = spark.range(total).select(F.col("id").alias("slot"), F.expr(f"id div {shard}").alias("shard"), F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(max(total, 1))).alias("at"))
    drawn = in_intervals(drawn, "at", plan.select("sid", "quota", "n", "lo", "hi"), total).drop("at")
    counts = drawn.groupBy("sid", "shard").agg(F.count("*").alias("c"))
    counts = stored(summed_before(counts, "sid", "shard", "c", "first").select("sid", "shard", "c", "first"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // SLOTS_IN_TASK)  # hashing takes long for its few bytes
    drawn = drawn.repartition(parts, "sid", "shard")
    rank = F.row_number().over(Window.partitionBy("sid", "shard").orderBy("slot")) - 1
    ranked = drawn.withColumn("rank", rank).join(counts.drop("c"), ["sid", "shard"]).withColumn("j", F.col("rank") + F.col("first")).drop("rank", "first")
    balance = plan.join(counts.groupBy("sid").agg(F.sum("c").alias("c")), "sid", "left").select("sid", "n", "quota", F.coalesce("c", F.lit(0)).alias("c"))
    over = F.sum(F.greatest(F.col("c") - F.col("quota"), F.lit(0))).over(Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, -1))
    lack = F.greatest(F.col("quota") - F.col("c"), F.lit(0))
    balance = balance.withColumns({"over": F.coalesce(over, F.lit(0)), "hi": F.sum(lack).over(Window.orderBy("sid"))}).withColumn("lo", F.col("hi") - lack)
    excess = ranked.where("j >= quota").join(balance.select("sid", "over"), "sid").select("slot", "shard", (F.col("over") + F.col("j") - F.col("quota")).alias("at"))
    moved = in_intervals(excess, "at", balance.select("sid", "n", F.col("c").alias("had"), "lo", "hi", F.col("lo").alias("base")), max(total, 1))
    taken = ranked.where("j < quota").select("shard", "slot", "sid", "n", "j").union(moved.select("shard", "slot", "sid", "n", (F.col("had") + F.col("at") - F.col("base")).alias("j")))
    place = permuted(F.expr("j % n"), F.col("n"), F.col("sid"), F.expr("j div n"), F.lit(seed))
    return taken.select("shard", "slot", "sid", place.alias("block"))


def goals(laid: DataFrame, drawn: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (sid, id, digest, goals) of laid out documents and drawn slots: where in the mix the words of a document go.

    A goal is (start, block, slot). No row holds more than the goals of STRETCH blocks of one copy, or of 16 copies.
    """
    spread = laid.where("size > 0").withColumns({"lo": F.expr(f"start div {block}"), "hi": F.expr(f"(start + size - 1) div {block}")})
    spread = spread.withColumn("stretch", F.explode(F.sequence(F.expr(f"lo div {STRETCH}"), F.expr(f"hi div {STRETCH}"))))
    within = F.sequence(F.greatest("lo", F.col("stretch") * STRETCH), F.least("hi", F.col("stretch") * STRETCH + (STRETCH - 1)))
    keep = ["sid", "id", "digest", "stretch", F.expr("copy div 16").alias("some")]
    held = spread.select(*keep, "start", F.explode(within).alias("block"))
    found = held.join(drawn.select("sid", "block", "slot"), ["sid", "block"])
    return found.groupBy("sid", "id", "digest", "stretch", "some").agg(F.collect_list(F.struct("start", "block", "slot")).alias("goals")).drop("stretch", "some")


def pieces(texts: DataFrame, aims: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows (slot, sid, at, start, id, n, words): the n words from place at of a source that stand in a slot of the mix, of the document at start.

    texts: sid, id, digest, text, each text once; aims: `goals`. A text is split once for each row of goals.
    """
    all_words = F.array(F.regexp_extract_all(F.col("text"), F.lit(WORD), F.lit(0)))

    def part(words: Column, g: Column) -> Column:
        first = F.greatest(g["start"], g["block"] * block)
        n = F.least(g["start"] + F.size(words), (g["block"] + 1) * block) - first
        cut = F.slice(words, (first - g["start"] + 1).cast("int"), n.cast("int"))
        return F.struct(g["slot"].alias("slot"), first.alias("at"), g["start"].alias("start"), n.alias("n"), F.array_join(cut, " ").alias("words"))

    cuts = F.flatten(F.transform(all_words, lambda words: F.transform("goals", lambda g: part(words, g))))
    other = aims.select(*(F.col(c).alias(f"_{c}") for c in ("sid", "id", "digest")), "goals")
    joined = texts.join(other, (F.col("sid") == F.col("_sid")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")))
    return joined.select("sid", "id", F.explode(cuts).alias("c")).select("c.slot", "sid", "c.at", "c.start", "id", "c.n", "c.words")


def assembled(parts: DataFrame, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The mix of its pieces: rows (shard, slot, sid, block, parts, words), a shard in one partition in the order of its slots.

    A slot holds the words of one block, joined by blanks, and the documents (start, id, n) they come from, one for each word at most.
    """
    dealt = parts.repartition(F.expr(f"slot div {shard}"))
    one = dealt.groupBy(F.expr(f"slot div {shard}").alias("shard"), "slot").agg(F.first("sid").alias("sid"), F.sort_array(F.collect_list(F.struct("at", "start", "id", "n", "words"))).alias("p"))
    come_from = F.transform("p", lambda p: F.struct(p["start"].alias("start"), p["id"].alias("id"), p["n"].alias("n")))
    whole = one.select("shard", "slot", "sid", F.expr(f"p[0].at div {block}").alias("block"), come_from.alias("parts"), F.array_join("p.words", " ").alias("words"))
    return whole.sortWithinPartitions("shard", "slot")


def _mixed(docs: DataFrame, id_col: str, text: str, source: str, seed: int, block: int, shard: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The laid out documents, the sources and the mix."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(source).alias("source"), F.xxhash64(text).alias("digest"), F.col(text).alias("text"))
    sized = stored(texts.select("id", "source", "digest", word_count(F.col("text")).alias("size")))
    sources = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))))
    ids = sources.select(F.col("source").alias("_source"), "sid")
    keyed = lambda rows: rows.join(ids, F.col("source").eqNullSafe(F.col("_source"))).drop("source", "_source")
    laid = stored(laid_out(keyed(sized)))
    once = keyed(texts.where(F.col("text").isNotNull()))
    if laid.where("copy > 0").limit(1).count():
        once = once.groupBy("sid", "id", "digest").agg(F.first("text").alias("text"))
    aims = stored(goals(laid, slots(sources, seed, block, shard), block))
    parts = stored(pieces(once, aims, block), compression="zstd")  # so that the shuffle of whole texts is over before that of their parts begins
    return laid, sources, stored(assembled(parts, block, shard), compression="zstd")


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = 11, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """The mixed corpus as rows (shard, slot, sid, block, parts, words), written with each shard in one file in the order of its slots."""
    return _mixed(docs, id_col, text, source, seed, block, shard)[2]


def mixed(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: int = 11, block: int = BLOCK, shard: int = SHARD) -> DataFrame:
    """Makes and writes the mix; one row per document: id, size, source, source_size, target, taken, the words of it in the mix.

    Null and empty texts have size 0 and are never taken; documents with null source make up a source of their own, null ids stay null.
    Rows that repeat an id are documents of their own. Columns of docs other than these three are ignored, so their names can't clash.
    An empty table gives no row. Reruns over the same rows give the same mix. No document is taken more than MOST times. Sums over
    sources run in one task, which holds dozens or thousands of sources, not millions.
    """
    laid, sources, made = _mixed(docs, id_col, text, source, seed, block, shard)
    taken = made.select("sid", F.explode("parts").alias("p")).groupBy("sid", F.col("p.start").alias("at")).agg(F.sum("p.n").alias("taken"))
    out = laid.withColumn("at", F.when(F.col("size") > 0, F.col("start"))).join(taken, ["sid", "at"], "left").join(sources, "sid")
    return out.select(F.col("id").alias(id_col), "size", "source", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixed(table(spark, sf_dir, "documents", "doc_id", "text", "source")).select("doc_id", "size", "source_size", "target", "taken")
