"""Language-model scores by prediction by partial matching over bytes, beside a word-unigram base score."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import log10

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, fold, stored, table, unused

#: Bytes of context, and the most leaves of the trie, or codes with their score, that are shipped to the executors; others are joined.
ORDER, MAX_LEAVES = 5, 6_000_000
#: Bytes of a code whose counts every task of a join holds (256 ** SHORT at most), and about how many codes a task works on at a time.
SHORT, CODES = 3, 250_000
#: Word counts that are shipped to every task; words beyond these are joined.
FREQUENT_WORDS = 50_000
#: Texts that a task works on at a time.
SLICE = 256
#: Byte that ends a text; white space never occurs inside words.
END = b"\n"
#: Columns that `scored` adds, and those that it needs on the way.
RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
PRIVATE = ("_part", "_words", "_tf", "_codes", "_reps", "_known", "_base", "_more", "_c", "_word", "_code", "_log")
_SYMBOL, _OWNERS = np.uint64(8), 1 << 16


def stream(text: str | None) -> bytes:
    """What the model reads: the ASCII-lower-cased words of a text joined by blanks."""
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def grams(streams: list[bytes], order: int = ORDER) -> np.ndarray:
    """One code for each byte of the streams and their ends: the order bytes before it (END before a start), then itself."""
    joined = np.frombuffer(b"".join(END * order + s + END for s in streams), np.uint8).astype(np.uint64)
    lengths = np.fromiter(map(len, streams), np.int64, len(streams)) + 1
    firsts = np.concatenate([[0], np.cumsum(lengths + order)[:-1]])
    at = np.repeat(firsts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    code = np.zeros(len(at), np.uint64)
    for i in range(order + 1):
        code = (code << _SYMBOL) | joined[at + i]
    return code


def blocks(streams: list[bytes], order: int, block: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Stretches lo:hi of the streams with their distinct codes and, for each byte in some order, the place of its code and the number of its stream.

    Where code and number fit into 64 bits together they are sorted as one number, which takes half the time.
    """
    sizes = np.fromiter(map(len, streams), np.int64, len(streams)) + 1
    number = (np.cumsum(sizes) // block).tolist()
    lo = 0
    while lo < len(streams):
        hi = lo + 1
        while hi < len(streams) and number[hi] == number[lo] and hi - lo < _OWNERS:
            hi += 1
        code, owner = grams(streams[lo:hi], order), np.repeat(np.arange(hi - lo), sizes[lo:hi])
        if 8 * (order + 1) + 16 <= 64:
            both = (code << np.uint64(16)) | owner.astype(np.uint64)
            both.sort()
            code, owner = both >> np.uint64(16), (both & np.uint64(_OWNERS - 1)).astype(np.int64)
            first = np.flatnonzero(np.diff(code, prepend=~code[:1]))
            yield lo, hi, code[first], np.repeat(np.arange(len(first)), np.diff(np.append(first, len(code)))), owner
        else:
            yield lo, hi, *np.unique(code, return_inverse=True), owner
        lo = hi


def shorter(level: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of k bytes with their counts, from longer ones."""
    values, where = np.unique(level[0] & np.uint64((1 << (8 * k)) - 1), return_inverse=True)
    return values, np.bincount(where, level[1], len(values))


class Trie:
    """Byte-context trie with the statistics of prediction by partial matching, escape method C.

    levels[k] holds, for contexts of k bytes, the sorted codes (context, byte) and their counts; contexts[k] the sorted contexts with
    total count, number of distinct bytes, and the count that these bytes have in the context one byte shorter (what symbol
    exclusion takes away there). If only the leaves of some contexts are given, short holds the whole levels that these don't add up to.
    """

    def __init__(self, codes: np.ndarray, counts: np.ndarray, order: int = ORDER, short: list[tuple[np.ndarray, np.ndarray]] | None = None):
        order_of = np.argsort(codes)
        level = (codes[order_of].astype(np.uint64), counts[order_of].astype(np.float64))
        self.order, self.levels, self.contexts = order, [None] * (order + 1), [None] * (order + 1)
        for k in range(order, -1, -1):
            self.levels[k] = level
            if k:
                level = short[k - 1] if k <= len(short or []) else shorter(level, k)
        for k in range(order + 1):
            code, count = self.levels[k]
            context, first = np.unique(code >> _SYMBOL, return_index=True)
            total = np.add.reduceat(count, first) if len(first) else np.zeros(0)
            distinct = np.diff(np.append(first, len(code))).astype(np.float64)
            lost = np.zeros(len(first))
            if k and len(first):
                below, n_below = self.levels[k - 1]
                lost = np.add.reduceat(n_below[np.searchsorted(below, code & np.uint64((1 << (8 * k)) - 1))], first)
            self.contexts[k] = (context, total, distinct, lost)

    def log10(self, codes: np.ndarray) -> np.ndarray:
        """log10 probability of each code's last byte after its context."""
        out, open_ = np.zeros(len(codes)), np.arange(len(codes))
        lost, gone = np.zeros(len(codes)), np.zeros(len(codes))  # count and number of the bytes excluded so far
        for k in range(self.order, -1, -1):
            code = codes[open_] & np.uint64((1 << (8 * (k + 1))) - 1)
            context, total, distinct, below = self.contexts[k]
            if not len(context):
                continue
            at = np.minimum(np.searchsorted(context, code >> _SYMBOL), len(context) - 1)
            known = context[at] == code >> _SYMBOL
            left, kinds = total[at] - lost[open_], distinct[at] - gone[open_]
            values, counts = self.levels[k]
            spot = np.minimum(np.searchsorted(values, code), len(values) - 1)
            seen = known & (values[spot] == code)
            out[open_[seen]] += np.log10(counts[spot[seen]] / (left[seen] + kinds[seen]))
            escaped = known & ~seen
            real = escaped & (left > 0)
            out[open_[real]] += np.log10(kinds[real] / (left[real] + kinds[real]))
            lost[open_[escaped]], gone[open_[escaped]] = below[at[escaped]], distinct[at[escaped]]
            open_ = open_[~seen]
        out[open_] -= np.log10(256 - gone[open_])
        return out

    def scores(self, streams: list[bytes], block: int = 1 << 20) -> np.ndarray:
        """log10 probability of each stream and its end; about `block` bytes are worked on at a time."""
        out = np.zeros(len(streams))
        for lo, hi, codes, where, owner in blocks(streams, self.order, block):
            out[lo:hi] = np.bincount(owner, self.log10(codes)[where], hi - lo)
        return out


def _added(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes of several lists with their summed counts."""
    codes, where = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([n for _, n in held]), len(codes)).astype(np.int64)


def code_counts(texts: DataFrame, text: str = "text", order: int = ORDER) -> DataFrame:
    """Rows (code, n): the codes (context of `order` bytes, byte) of all texts with their counts, the leaves of the trie. Stored."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            streams = [stream(t) for t in batch["text"]]
            for lo in range(0, len(streams), SLICE):
                held.append(np.unique(grams(streams[lo : lo + SLICE], order), return_counts=True))
                if sum(len(codes) for codes, _ in held) > 2_000_000:
                    held = [_added(held)]
                    if len(held[0][0]) > 1_000_000:
                        yield pd.DataFrame({"code": held[0][0].view(np.int64), "n": held[0][1]})
                        held = []
        if held:
            codes, counts = _added(held)
            yield pd.DataFrame({"code": codes.view(np.int64), "n": counts})

    bounded_batches(texts.sparkSession)
    return stored(texts.select(F.col(text).alias("text")).mapInPandas(counted, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")))


def frequent_codes(counts: DataFrame, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """The rows of counts with the greatest n, max_leaves at most."""
    size, least = counts.count(), 1
    while size > max_leaves:
        least *= 2
        size = counts.where(F.col("n") >= least).count()
    return counts.where(F.col("n") >= least)


def train(texts: DataFrame, text: str = "text", order: int = ORDER, max_leaves: int = MAX_LEAVES) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent leaves, max_leaves at most, for a trie that is held in one place; `scored` takes all leaves of `code_counts`."""
    kept = frequent_codes(code_counts(texts, text, order), max_leaves).toArrow()
    return kept["code"].to_numpy().view(np.uint64), kept["n"].to_numpy()


def code_scores(leaves: DataFrame, used: DataFrame, order: int = ORDER) -> DataFrame:
    """Rows (code, n, log): the codes of used and their n with the log10 probability under the trie of all leaves. Stored.

    Codes that share their last context bytes meet in one task, which makes their longer contexts whole there; the levels of codes of
    SHORT bytes and less are shipped.
    """
    spark, k = leaves.sparkSession, min(SHORT, order)
    low = leaves.groupBy(F.col("code").bitwiseAND(F.lit((1 << (8 * k)) - 1)).alias("code")).agg(F.sum("n").alias("n")).orderBy("code").toArrow()
    levels = [(low["code"].to_numpy().astype(np.uint64), low["n"].to_numpy().astype(np.float64))]
    for i in range(k - 1, 0, -1):
        levels.insert(0, shorter(levels[0], i))
    shared = spark.sparkContext.broadcast(levels)
    both = leaves.withColumnRenamed("n", "count").join(used, "code", "full").select("code", F.coalesce("count", F.lit(0)).alias("count"), F.coalesce("n", F.lit(0)).alias("n"))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), leaves.count() // CODES + 1)

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if rows := list(batches):
            rows = pa.Table.from_batches(rows)
            code, count, n = rows["code"].to_numpy().view(np.uint64), rows["count"].to_numpy(), rows["n"].to_numpy()
            trie = Trie(code[count > 0], count[count > 0], order, shared.value)
            code, n = code[n > 0], n[n > 0]
            yield pa.RecordBatch.from_arrays([pa.array(code.view(np.int64)), pa.array(n), pa.array(trie.log10(code))], names=["code", "n", "log"])

    context = F.shiftrightunsigned("code", 8).bitwiseAND(F.lit((1 << (8 * k)) - 1))
    return stored(both.repartition(parts, context).mapInArrow(solved, "code long, n long, log double"))


def looked_up(streams: list[bytes], values: np.ndarray, logs: np.ndarray, order: int) -> tuple[np.ndarray, list[list[int]], list[list[int]]]:
    """Sums of the logs of each stream's codes among values (sorted), and its other codes with their counts."""
    out, codes, counts = np.zeros(len(streams)), [[] for _ in streams], [[] for _ in streams]
    for lo, hi, code, where, owner in blocks(streams, order):
        at = np.minimum(np.searchsorted(values, code), max(len(values) - 1, 0))
        seen = values[at] == code if len(values) else np.zeros(len(code), bool)
        log = np.zeros(len(code))
        log[seen] = logs[at[seen]]
        out[lo:hi] = np.bincount(owner, log[where], hi - lo)
        other = ~seen[where]
        pairs, n = np.unique(owner[other] * len(code) + where[other], return_counts=True)
        for i, c, m in zip((pairs // len(code) + lo).tolist(), code[pairs % len(code)].view(np.int64).tolist(), n.tolist(), strict=True):
            codes[i].append(c)
            counts[i].append(m)
    return out, codes, counts


def word_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """Counts c of the words of all texts, null text counting as empty."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: Counter = Counter()
        for batch in batches:
            for t in batch["text"]:
                total.update((t or "").encode("utf-8", "surrogatepass").lower().split())
            if len(total) > 200_000:
                yield pd.DataFrame({"word": list(total), "c": list(total.values())})
                total = Counter()
        yield pd.DataFrame({"word": list(total), "c": list(total.values())})

    return texts.select(F.col(text).alias("text")).mapInPandas(counted, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def scored(docs: DataFrame, leaves: DataFrame, counts: DataFrame, n_train: int, n_ends: int, text: str = "text", order: int = ORDER, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """Replaces the text of each row by n_tokens, n_known, train_tokens, base_score and score.

    score is the log10 probability of the text and its end under the trie of the leaves, base_score that under smoothed word unigrams
    (end included). The FREQUENT_WORDS most frequent words are looked up in every task; only the other words of a document are joined
    with the counts. A Python worker builds its model once, not for each task. Up to max_leaves leaves are shipped as a trie; of more, every code's log10 probability is worked out by a join, the
    most frequent codes of docs are looked up in every task, and the other codes of a document are joined. Both give the same score.
    Tasks work on a few hundred texts at a time. Null and empty texts hold the end alone; rows that repeat are scored each; an empty table
    gives no row. Columns of docs with the names of RESULTS or PRIVATE are left out, all others stay.
    """
    bounded_batches(docs.sparkSession)
    docs = docs.drop(*(c for c in (*RESULTS, *PRIVATE) if c != text))
    keep = [c for c in docs.columns if c != text]
    vocabulary = counts.count() + (n_ends > 0)
    held, least = 0, None
    for r in counts.groupBy("c").count().orderBy(F.desc("c")).limit(FREQUENT_WORDS).collect():
        if (held := held + r["count"]) > FREQUENT_WORDS:
            break
        least = r["c"]
    frequent = counts.where(F.col("c") >= least).toArrow() if least else None  # FREQUENT_WORDS at most
    words = dict(zip(frequent["word"].to_pylist(), frequent["c"].to_pylist(), strict=True)) if frequent else {}
    floor = n_train + 0.5 * (vocabulary + 1)
    whole_trie = leaves.count() <= max_leaves
    logs_of = None if whole_trie else code_scores(leaves, code_counts(docs, text, order), order)
    shipped = (leaves if whole_trie else frequent_codes(logs_of, max_leaves).select("code", "log")).toArrow()
    shipped = (shipped["code"].to_numpy().view(np.uint64), shipped[1].to_numpy())
    logs_of_words = {w: log10((c + 0.5) / floor) for w, c in words.items()}
    shared = docs.sparkSession.sparkContext.broadcast({"codes": shipped, "words": logs_of_words})  # max_leaves and FREQUENT_WORDS

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value  # one for each Python worker, which keeps it from task to task
        if "codes" in held:
            values, numbers = held["codes"]
            order_of = np.argsort(values)
            held["model"] = Trie(values, numbers, order) if whole_trie else (values[order_of], numbers[order_of])
            del held["codes"]
        model, logs = held["model"], held["words"]
        end = log10((n_ends + 0.5) / floor)
        for whole in batches:
            for lo in range(0, whole.num_rows, SLICE):
                batch = whole.slice(lo, SLICE)
                streams = [stream(t) for t in batch.column(text).to_pylist()]
                rows: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "_part", "_words", "_tf")}
                for s in streams:
                    tokens, part, rest, tf = s.split(), end, [], []
                    for w, k in Counter(tokens).items():
                        if (p := logs.get(w)) is None:
                            rest.append(w)
                            tf.append(k)
                        else:
                            part += k * p
                    n_known = int(n_ends > 0) + len(tokens) - sum(tf)
                    for k, v in zip(rows, (len(tokens) + 1, n_known, part, rest, tf), strict=True):
                        rows[k].append(v)
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int64()))
                arrays = [pa.array(values, kind) for values, kind in zip(rows.values(), kinds, strict=True)]
                if whole_trie:
                    part_score, codes, reps = model.scores(streams), [[]] * len(streams), [[]] * len(streams)
                else:
                    part_score, codes, reps = looked_up(streams, *model, order)
                arrays += [pa.array(codes, pa.list_(pa.int64())), pa.array(reps, pa.list_(pa.int64())), pa.array(part_score)]
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *arrays], names=[*keep, *rows, "_codes", "_reps", "score"])

    kept = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    first = docs.mapInArrow(score, f"{kept}{', ' * bool(kept)}n_tokens long, n_known long, _part double, _words array<binary>, _tf array<long>, _codes array<long>, _reps array<long>, score double")
    row = unused(first, "_row")
    first = stored(first.withColumn(row, F.monotonically_increasing_id()))
    rare = first.select(row, F.explode(F.arrays_zip("_words", "_tf")).alias("r")).select(row, F.col("r._words").alias("_word"), F.col("r._tf").alias("_tf"))
    log = F.log10((F.coalesce("_c", F.lit(0)) + 0.5) / F.lit(float(floor)))
    joined = rare.join(counts.select(F.col("word").alias("_word"), F.col("c").alias("_c")), "_word", "left")
    joined = joined.groupBy(row).agg(F.sum(F.when(F.col("_c") > 0, F.col("_tf")).otherwise(0)).alias("_known"), F.sum(F.col("_tf") * log).alias("_base"))
    out = first.drop("_words", "_tf", "_codes", "_reps").join(joined, row, "left")
    score = F.col("score")
    if not whole_trie:
        other = first.select(row, F.explode(F.arrays_zip("_codes", "_reps")).alias("r")).select(row, F.col("r._codes").alias("_code"), F.col("r._reps").alias("_reps"))
        known = other.join(logs_of.select(F.col("code").alias("_code"), F.col("log").alias("_log")), "_code")
        out = out.join(known.groupBy(row).agg(F.sum(F.col("_reps") * F.col("_log")).alias("_more")), row, "left")
        score += F.coalesce("_more", F.lit(0.0))
    n_known, base = F.col("n_known") + F.coalesce("_known", F.lit(0)), F.col("_part") + F.coalesce("_base", F.lit(0.0))
    return out.select(*keep, "n_tokens", n_known.alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"))


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model scores of every document, a fifth of the ids being held out of the learning.

    Rows with the same id are told apart by their position in the scan. A null text is an empty one: its only token is the end.
    """
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", F.coalesce(fold(F.col("doc_id"), 5) == 1, F.lit(False)))
    learn = docs.where(~F.col("held_out")).select("text")
    counts = stored(word_counts(learn))
    n_ends = learn.count()
    n_train = (counts.agg(F.sum("c")).first()[0] or 0) + n_ends
    out = scored(docs, code_counts(learn), counts, n_train, n_ends)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
