"""Ranked lexical search by reversal: the items to be searched for are indexed, and the documents stream through the index."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, ascii_lower, bounded_batches, stored, table

#: Runs of ASCII letters and digits and of all characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Pairs of an item and a term that one broadcast index holds at most, but for an item that alone has more.
POSTINGS = 250_000
#: Products of a document's terms and postings worked out at once.
STEP = 1 << 21


class Index:
    """Inverted index over the terms of some items, with the statistics of the documents that the scores need."""

    def __init__(self, postings: list[Row], n_docs: int, n_terms: int):
        """postings: (row, term, df) for each distinct term of each item, row being the item's."""
        self.rows = np.unique(np.array([p["row"] for p in postings], np.int64))
        self.terms = {t: i for i, t in enumerate(dict.fromkeys(p["term"] for p in postings))}
        term = np.array([self.terms[p["term"]] for p in postings], np.int64)
        order = np.argsort(term, kind="stable")
        self.items = np.searchsorted(self.rows, np.array([p["row"] for p in postings], np.int64))[order]
        self.start = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        self.weight = np.zeros(len(self.terms), np.int64)
        for p in postings:
            self.weight[self.terms[p["term"]]] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * p["df"] + 1)))
        self.n_docs, self.n_terms = n_docs, n_terms

    def scores(self, lengths: list[int], terms: list[list[str]], counts: list[list[int]]) -> np.ndarray:
        """Matrix of the scores of documents (rows), given their lengths, distinct terms and term counts, for all items."""
        m = np.array([100 - 90 + 90 * n * self.n_docs // self.n_terms for n in lengths], np.int64)
        known = [(d, self.terms[t], c) for d, (ts, cs) in enumerate(zip(terms, counts, strict=True)) for t, c in zip(ts, cs, strict=True) if t in self.terms]
        out = np.zeros((len(lengths), len(self.rows)), np.int64)
        if known:
            doc, term, tf = np.array(known, np.int64).T
            part = self.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            held = self.start[term + 1] - self.start[term]
            at = np.repeat(self.start[term] - np.cumsum(held) + held, held) + np.arange(held.sum())
            np.add.at(out, (np.repeat(doc, held), self.items[at]), np.repeat(part, held))
        return out


class Heaps:
    """The k best documents of each item so far."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.item, self.doc, self.null, self.score = (np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))

    def update(self, doc: np.ndarray, null: np.ndarray, scores: np.ndarray) -> None:
        """doc: ids of the rows of scores; null: those without an id, which come last among equals."""
        d, i = np.nonzero(scores >= self.least)
        item, score = np.concatenate([self.item, i]), np.concatenate([self.score, scores[d, i]])
        ids, none = np.concatenate([self.doc, doc[d]]), np.concatenate([self.null, null[d]])
        order = np.lexsort((ids, none, -score, item))
        place = np.arange(len(order)) - np.searchsorted(item[order], item[order])
        kept = order[place < self.k]
        self.item, self.doc, self.null, self.score = item[kept], ids[kept], none[kept], score[kept]
        full = np.flatnonzero(place == self.k - 1)
        self.least[item[order[full]]] = score[order[full]]


def term_list(text: Column) -> Column:
    """All terms of a text in order; null for null."""
    return F.regexp_extract_all(ascii_lower(text), F.lit(TERM), 0)


def term_counts(docs: DataFrame, vocabulary: set[str] | None) -> DataFrame:
    """Rows (id, n, terms, counts) for documents (id, text) with a term, ids as text (pandas would turn those of a batch with a null into doubles): how many terms the text has, and its distinct ones (those of the vocabulary, if given)
    with their counts."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)
    find, lower = re.compile(TERM).findall, str.maketrans(UPPER, LOWER)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = known.value
        for batch in batches:
            rows = []
            for i, text in zip(batch["id"].tolist(), batch["text"].tolist(), strict=True):
                counts: Counter[str] = Counter()
                for term, c in Counter(find(text)).items():  # case is folded for distinct terms only
                    counts[term.translate(lower)] += c
                if counts:
                    held = counts if wanted is None else {t: c for t, c in counts.items() if t in wanted}
                    rows.append((i, sum(counts.values()), list(held), list(held.values())))
            yield pd.DataFrame(rows, columns=["id", "n", "terms", "counts"])

    return docs.where(F.col("text").isNotNull()).select("id", "text").mapInPandas(emit, "id string, n long, terms array<string>, counts array<long>")


def best_of(counted: DataFrame, index: Index, k: int) -> DataFrame:
    """Rows (row, id, score): the k best documents of each item within each partition of counted, kept in bounded heaps."""
    shared = counted.sparkSession.sparkContext.broadcast(index)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = shared.value
        heaps, step = Heaps(len(index.rows), k), max(1, STEP // max(1, len(index.items)))
        for batch in batches:
            null = batch["id"].isna().to_numpy()
            ids = np.array([int(i or 0) for i in batch["id"]], np.int64)
            for lo in range(0, len(batch), step):
                some = batch.iloc[lo : lo + step]
                heaps.update(ids[lo : lo + step], null[lo : lo + step], index.scores(some["n"].tolist(), some["terms"].tolist(), some["counts"].tolist()))
        yield pd.DataFrame({"row": index.rows[heaps.item], "id": [None if n else str(d) for d, n in zip(heaps.doc, heaps.null, strict=True)], "score": heaps.score})

    return counted.mapInPandas(emit, "row long, id string, score long").withColumn("id", F.col("id").cast("long"))


def grouped(items: DataFrame, postings: int) -> tuple[DataFrame, int]:
    """items (row, terms) with a group each, and the number of groups, so that no group of several items has more than `postings` terms."""
    total = items.agg(F.sum(F.size("terms"))).first()[0] or 0
    groups = -(-total // postings)
    while True:
        out = items.withColumn("group", F.pmod(F.xxhash64("row"), F.lit(max(groups, 1))))
        if groups <= 1:
            return out, groups
        sizes = out.groupBy("group").agg(F.sum(F.size("terms")).alias("terms"), F.count("*").alias("n"))
        if not sizes.where((F.col("terms") > postings) & (F.col("n") > 1)).head(1):
            return out, groups
        groups *= 2


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", postings: int = POSTINGS
) -> DataFrame:
    """The k highest-scoring documents of each item: (item_id, rank, id, score), scores above 0 only, equal scores by id.

    The items' terms make up an inverted index, which is broadcast. Every document's term counts stream through it once; each task keeps the k best documents
    of each item, and the heaps of all tasks are merged. Texts are read once; term counts are stored for the second pass, which needs the frequencies of the
    first. Where the items have more than `postings` terms together they are indexed in groups of at most so many, and the stored counts stream through one
    index after the other; an item is never split, so the largest index is that of one item or `postings`.

    A term's weight is floor(1000 * ln((2N + 2) / (2df + 1))), N being the documents with a term and df those with this one; a document's score sums
    weight * (10^9 * tf div (1000 * tf + 8m)) over an item's distinct terms, m being 10 + 90 * n * N div L for a document of n terms and L terms in all.
    Null and empty texts have no term and take no part. Documents with null or repeated ids count and rank as rows of their own, null ids last among equals; items
    with repeated or null ids are ranked row by row. Other columns are ignored, so names can't clash; empty tables give no row.
    """
    spark = bounded_batches(docs.sparkSession)
    source = docs.select(F.col(id_col).cast("long").cast("string").alias("id"), F.col(text).alias("text"))
    asked = items.select(F.col(item_id).alias("item"), F.array_distinct(term_list(F.col(item_text))).alias("terms")).where(F.size("terms") > 0)
    asked, groups = grouped(stored(asked.withColumn("row", F.monotonically_increasing_id())), postings)
    pairs = asked.select("group", "row", F.explode("terms").alias("term"))
    vocabulary = {r["term"] for r in pairs.select("term").distinct().collect()} if groups <= 1 else None
    counted = stored(term_counts(source, vocabulary))
    n_docs, n_terms = counted.agg(F.count("*"), F.sum("n")).first()
    seen = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    pairs = stored(pairs.join(seen, "term"))
    found = spark.createDataFrame([], "row long, id long, score long")
    for g in range(groups):
        some = pairs.where(F.col("group") == g).select("row", "term", "df").collect()  # at most `postings`, or one item's
        if some:
            found = found.union(best_of(counted, Index(some, n_docs, n_terms), k))
    order = Window.partitionBy("row").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.join(asked.select("row", "item"), "row").select(F.col("item").alias(item_id), "rank", F.col("id").alias(id_col), "score")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for each benchmark item."""
    return ranked(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))


OP12_SQL = rf"""
with docs as (
    select doc_id, row_number() over () as r, regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}') as terms from documents where text is not null
), items as (
    select item_id, row_number() over () as i, list_distinct(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{TERM}')) as terms from benchmark where text is not null
), total as (select count(*) as n_docs, sum(len(terms)) as n_terms from docs where len(terms) > 0
), asked as (select item_id, i, unnest(terms) as term from items
), counts as (
    select r, term, count(*) as tf from (select r, unnest(terms) as term from docs) where term in (select term from asked) group by all
), weights as (
    select term, cast(floor(1000 * ln(cast(2 * any_value(n_docs) + 2 as double) / (2 * count(*) + 1))) as bigint) as w from counts, total group by term
), sizes as (
    select r, doc_id, cast(100 - 90 + (90 * len(terms) * n_docs) // n_terms as bigint) as m from docs, total where len(terms) > 0
), scored as (
    select item_id, i, doc_id, r, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) as bigint) as score
    from asked join weights using (term) join counts using (term) join sizes using (r) group by all
), placed as (
    select *, row_number() over (partition by i order by score desc, doc_id nulls last) as rank from scored where score > 0
)
select item_id, cast(rank as int) as rank, doc_id, score from placed where rank <= 10
"""
