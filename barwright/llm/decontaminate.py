"""Benchmark decontamination by latent semantic retrieval of passages, checked by longest common subsequences and answers."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, stored, table

#: Words of a passage; passages start every HALF words.
WINDOW, HALF = 32, 16
#: Words of a text that are worked on at a time, a multiple of HALF.
STRETCH = 1 << 14
#: Latent dimensions and extra random directions.
RANK, EXTRA = 256, 16
#: A task sums the products of pairs of terms in a table of up to so many cells, else it multiplies passage by passage.
CELLS = 1 << 24
#: Least cosine of a candidate; share of the item's words in common subsequence that decides alone, or together with the answer's share.
MIN_COSINE, VERBATIM, PARAPHRASE, ANSWER = 0.28, 0.8, 0.55, 0.8
#: A passage is projected for an item if their cosine before the projection can reach this share of the least one. An item's commonest
#: terms are left out of that bound, up to the share COMMON of its length.
GATE, COMMON = 0.875, 0.1
#: Benchmark items that share a latent basis, and blocks of items that are searched in one pass over the documents.
BLOCK, PASS = 512, 8
#: Shares in cosines are summed in a table of passages and items with up to so many cells for each share, else by sorted pairs.
DENSE = 32

_words = re.compile(r"[^\W_]+").findall
_parted = bytes(c if chr(c).isalnum() else 32 for c in range(256))  # Latin-1


def words(text: str | None) -> list[str]:
    """Lower-cased runs of letters and digits."""
    low = (text or "").lower()
    try:
        return low.encode("latin-1").translate(_parted).decode("latin-1").split()  # as the other way, but faster
    except UnicodeEncodeError:
        return _words(low)


def lcs(a: list, b: list) -> int:
    """Length of the longest common subsequence, by bit-parallel rows."""
    at: dict[object, int] = {}
    for i, w in enumerate(a):
        at[w] = at.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        if m := at.get(w):
            u = row & m
            row = ((row + u) | (row - u)) & full
    return len(a) - row.bit_count()


def item_parts(text: str | None, answer: str | None) -> tuple[list[str], list[str]]:
    """Words of an item, and of its answer: the given one, else the item's last quarter, where questions state what is asked for."""
    w = words(text)
    return w, words(answer) or w[-max(1, len(w) // 4) :]


def leak(item: list, answer: list, span: list) -> tuple[float, float, bool]:
    """Share of the item's and of the answer's words (or their ids) found in order in a span, and whether the span is a leak of the item.

    The words of an item of under HALF words must stand within twice as many words of the span.
    """
    if len(item) < HALF and len(span) > 2 * len(item):
        parts = [span[lo : lo + 2 * len(item)] for lo in range(0, len(span) - len(item), len(item))]
    else:
        parts = [span]
    found = [(lcs(item, part) / len(item), lcs(answer, part) / len(answer)) for part in parts]
    share, answered = max(found)
    return share, answered, any(s >= VERBATIM or (s >= PARAPHRASE and a >= ANSWER) for s, a in found)


class Passages(NamedTuple):
    """Passages of some texts. ids: the texts' words in rows of HALF, the last row being empty; first, second: the two rows of each passage;
    text, at: its text and its first word there. Ids are those of the terms, then one for all other words, and one for no word."""

    ids: np.ndarray
    first: np.ndarray
    second: np.ndarray
    text: np.ndarray
    at: np.ndarray


def passages(texts: Iterable[np.ndarray], terms: int) -> Iterator[Passages]:
    """All passages of texts of words' ids, those of about STRETCH words at a time. They start every HALF words, the last one of a text reaches its end."""
    group, size = [], 0
    for t, ids in enumerate(texts):
        for lo in range(0, len(ids), STRETCH):
            if not lo or len(ids) - lo > HALF:  # passages that begin in this stretch
                group.append((t, lo, np.minimum(ids[lo : lo + STRETCH + HALF], terms)))
                size += len(group[-1][2])
            if size >= STRETCH:
                yield _packed(group, terms + 1)
                group, size = [], 0
    if group:
        yield _packed(group, terms + 1)


def _packed(group: list[tuple[int, int, np.ndarray]], none: int) -> Passages:
    text, lo = (np.array(x) for x in zip(*(g[:2] for g in group), strict=True))
    rows = np.array([(len(ids) - 1) // HALF + 1 for _, _, ids in group])
    begin = np.cumsum(rows) - rows
    out = np.full((rows.sum() + 1, HALF), none, np.int64)
    for b, (_, _, ids) in zip(begin.tolist(), group, strict=True):
        out.ravel()[b * HALF : b * HALF + len(ids)] = ids
    n = np.maximum(rows - 1, 1)
    part = np.repeat(np.arange(len(group)), n)
    k = np.arange(len(part)) - (np.cumsum(n) - n)[part]
    first = begin[part] + k
    return Passages(out, first, np.where(rows[part] > 1, first + 1, len(out) - 1), text[part], lo[part] + k * HALF)


def _passage_sums(rows: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of each passage of a text of n words."""
    starts = np.arange(0, n, HALF)
    blocks = np.add.reduceat(rows, starts, axis=0)
    return blocks[:1] if len(blocks) == 1 else blocks[:-1] + blocks[1:]


def _tfidf(p: Passages, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Passages as a sparse matrix in triples (passage, term, value), in order of both, and their number; rows of unit length over all their words."""
    n, terms = len(p.first), len(idf) - 1
    row, column = np.nonzero(p.ids < terms)
    own = p.ids[row, column]
    key = []
    for half in (p.first, p.second):
        of = np.full(len(p.ids), -1)
        of[half] = np.arange(n)
        of[-1] = -1
        key.append((of[row] * terms + own)[of[row] >= 0])
    key, tf = np.unique(np.concatenate(key), return_counts=True)
    ps, ts = np.divmod(key, terms)
    vs = tf * idf[ts]
    other = (p.ids == terms).sum(1)
    square = np.bincount(ps, vs * vs, n) + (other[p.first] + other[p.second]) * idf[-1] ** 2
    return ps, ts, vs / np.maximum(np.sqrt(square[ps]), 1e-12), n


def _gram_times(triples, basis: np.ndarray, columns: int = 32) -> np.ndarray:
    """A'(A basis) of a sparse matrix A, some columns at a time, as every entry of A makes a row of them."""
    ps, ts, vs, _ = triples
    out = np.zeros_like(basis)
    if len(ps):
        starts = np.flatnonzero(np.diff(ps, prepend=-1))  # entries stand in order of their passages
        row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ps))))
        order = np.argsort(ts, kind="stable")
        firsts = np.flatnonzero(np.diff(ts[order], prepend=-1))
        for lo in range(0, basis.shape[1], columns):
            image = np.add.reduceat(vs[:, None] * basis[ts, lo : lo + columns], starts, axis=0)
            out[ts[order][firsts], lo : lo + columns] = np.add.reduceat(vs[order, None] * image[row[order]], firsts, axis=0)
    return out


def _add_gram(triples, gram: np.ndarray) -> None:
    """Adds A'A of a sparse matrix A to gram: its upper triangle, and half its diagonal."""
    ps, ts, vs, _ = triples
    np.add.at(gram.reshape(-1), ts * (len(gram) + 1), vs * vs / 2)
    starts = np.flatnonzero(np.diff(ps, prepend=-1))
    size = np.diff(np.append(starts, len(ps)))
    for n in np.unique(size[size > 1]).tolist():  # passages of n terms each
        at = starts[size == n][:, None] + np.arange(n)
        i, j = np.triu_indices(n, 1)
        term, value = ts[at], vs[at]
        np.add.at(gram.reshape(-1), (term[:, i] * len(gram) + term[:, j]).ravel(), (value[:, i] * value[:, j]).ravel())


def latent_basis(texts: DataFrame, items: list[np.ndarray], place: np.ndarray, idf: np.ndarray, rank: int = RANK, seed: int = 5) -> np.ndarray:
    """Right singular vectors (terms x rank) of the TF-IDF passages of all texts (column ids) and items.

    place: the term of each id, len(idf) - 1 for other words and len(idf) for none. The items' passages weigh as much as the texts' together,
    so that the basis spans what is searched for. Randomised decomposition by Nystroem's method: the executors multiply A'A of all
    passages by random directions, in one pass over the texts; the products are summed by blocks of terms, and the driver decomposes a matrix of
    terms x (rank + EXTRA).
    """
    spark, n = texts.sparkSession, len(idf) - 1
    width = min(rank + EXTRA, n)
    start = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, width)))[0]
    shared = spark.sparkContext.broadcast((place, idf, start))

    def multiplied(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, idf, start = shared.value
        total, count = np.zeros_like(start), 0
        gram = np.zeros((len(start),) * 2) if start.shape[0] ** 2 <= CELLS else None
        for batch in batches:
            for p in passages(map(_ids, batch["ids"]), len(place) - 2):
                triples = _tfidf(p._replace(ids=place[p.ids]), idf)
                count += triples[3]
                if gram is None:
                    total += _gram_times(triples, start)
                else:
                    _add_gram(triples, gram)
        if not count:
            return
        if gram is not None:
            whole = np.add(gram, gram.T, out=np.empty(gram.shape, np.float32), casting="same_kind")
            total += whole @ start.astype(np.float32)
        blocks = range(0, len(total), 1024)
        yield pd.DataFrame({"block": [-1, *blocks], "part": [np.array([count], float).tobytes(), *(total[b : b + 1024].tobytes() for b in blocks)]})

    def summed(parts: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": parts["block"][:1], "part": [sum(np.frombuffer(p) for p in parts["part"]).tobytes()]})

    rows = texts.select("ids").mapInPandas(multiplied, "block long, part binary").groupBy("block").applyInPandas(summed, "block long, part binary").collect()
    shared.destroy()
    parts = {r["block"]: np.frombuffer(r["part"]) for r in rows}
    own = [_tfidf(p._replace(ids=place[p.ids]), idf) for p in passages(items, len(place) - 2)]
    weight = max(1.0, float(parts.pop(-1, [0.0])[0]) / max(sum(t[3] for t in own), 1))
    product = weight * sum(_gram_times(t, start) for t in own)
    for block, part in parts.items():
        product[block : block + 1024] += part.reshape(-1, width)
    values, vectors = np.linalg.eigh(start.T @ product)
    kept = values > 1e-9 * values[-1]
    return np.linalg.svd(product @ (vectors[:, kept] / np.sqrt(values[kept])), full_matrices=False)[0][:, :rank]


def document_frequencies(texts: DataFrame, terms: int) -> tuple[np.ndarray, int]:
    """In how many texts (column ids) each term occurs, and the number of all texts."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, n = np.zeros(terms + 1, np.int64), 0
        for batch in batches:
            n += len(batch)
            for ids in map(_ids, batch["ids"]):
                holds = np.zeros(terms + 1, bool)
                holds[np.minimum(ids, terms)] = True
                total += holds
        some = np.flatnonzero(total[:-1])
        yield pd.DataFrame({"term": np.append(some, -1), "n": np.append(total[some], n)})

    rows = texts.select("ids").mapInPandas(counted, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow().to_pandas()  # terms of one pass's items
    out = np.zeros(terms + 1)
    out[rows["term"]] = rows["n"]
    return out[:-1], int(out[-1])


def _ids(stored: bytes) -> np.ndarray:
    """Ids of a text's words; words of no item have the largest one."""
    return np.frombuffer(stored, np.uint32).astype(np.int64)


def word_ids(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """Stored rows (id, ids), one for each text: the ids of all its words in order, for the passes over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get, other = shared.value.get, itertools.repeat(-1)
        for batch in batches:
            lists = map(words, batch["text"])
            yield pd.DataFrame({"id": batch["id"], "ids": [np.fromiter(map(get, ws, other), np.int32, len(ws)).tobytes() for ws in lists]})

    return stored(docs.mapInPandas(read, f"id {dict(docs.dtypes)['id']}, ids binary"), compression="zstd")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", answer: str | None = None) -> DataFrame:
    """Rows (id, item_id, cosine, lcs_share, answer_share, first_word, n_words): documents with a passage that repeats or paraphrases an item.

    A passage is a candidate for an item if their TF-IDF vectors, projected on the latent basis, have cosine MIN_COSINE or more, the
    whole length of the passage's vector counting; for an item of under HALF words the least cosine falls with the root of its length, as
    such an item fills a passage in part only. Neighbouring candidates are joined to one span and checked; per (document, item) the span
    with the largest share is returned, of equal ones the first. An item leaks where VERBATIM of its words stand in order in the span, or
    PARAPHRASE of them with ANSWER of its answer; shorter quotes of an item are no leak. All passages of all documents are compared with
    all items: for every PASS * BLOCK items the documents are read once and the ids of their words stored, which are read for the document
    frequencies, for the basis of each BLOCK, and for the search.
    Null or wordless texts and items give no row; a null id stays null; repeated rows of docs give repeated results, repeated items too;
    columns of the two tables other than those named are ignored, so their names can't clash. Empty tables give an empty result.
    """
    spark = bounded_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    asked = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).alias("text"), (F.col(answer) if answer else F.lit(None).cast("string")).alias("answer"))
    out = None
    items = ((r["item"], *item_parts(r["text"], r["answer"])) for r in asked.toLocalIterator() if words(r["text"]))
    while some := list(itertools.islice(items, PASS * BLOCK)):
        found = _search(docs, some)
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], f"id {dict(docs.dtypes)['id']}, item {dict(asked.dtypes)['item']}, cosine double, lcs_share double, answer_share double, first_word long, n_words long")
    return out.withColumnsRenamed({"id": id_col, "item": "item_id"})


class Postings(NamedTuple):
    """For every term the items that hold it, with the term's share in the cosine of a passage that holds the term once.

    The cosine here is that of whole vectors before the projection. least: what the sum of shares must reach for each item, the
    terms left out (COMMON of an item's length at most) being counted as if the passage held them all. The entries of term t stand at
    first[t] and the size[t] - 1 places after; the last two terms are any word that no item holds, and none.
    """

    item: np.ndarray
    share: np.ndarray
    first: np.ndarray
    size: np.ndarray
    least: np.ndarray

    def near(self, p: Passages, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (passage, item) whose cosine before the projection can be large enough."""
        ids = p.ids.ravel()
        size = self.size[ids]
        total = int(size.sum())
        if not total:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.repeat(self.first[ids] - np.cumsum(size) + size, size) + np.arange(total)
        half, item, n = np.repeat(np.arange(len(ids)) // HALF, size), self.item[at], len(self.least)
        if (cells := len(p.ids) * n) <= DENSE * total:
            sums = np.bincount(half * n + item, self.share[at], cells).reshape(-1, n)
            return np.nonzero(sums[p.first] + sums[p.second] >= self.least * np.sqrt(whole)[:, None])
        key, share = [], []
        for row in (p.first, p.second):  # a half belongs to the passage that begins with it and the one before
            of = np.full(len(p.ids), -1)
            of[row] = np.arange(len(row))
            own = of[half] >= 0
            key.append(of[half[own]] * n + item[own])
            share.append(self.share[at[own]])
        key, where = np.unique(np.concatenate(key), return_inverse=True)
        sums, passage = np.bincount(where, np.concatenate(share)), key // n
        kept = sums >= self.least[key % n] * np.sqrt(whole[passage])
        return passage[kept], key[kept] % n


def postings_of(items: list[np.ndarray], idf: np.ndarray) -> Postings:
    rows, least = [], np.zeros(len(items))
    for i, ids in enumerate(items):
        term, tf = np.unique(ids, return_counts=True)
        square = (tf * idf[term]) ** 2
        length = float(np.sqrt(square.sum()))
        order = np.argsort(square)
        out = order[np.cumsum(square[order]) <= (COMMON * length) ** 2]
        least[i] = max(GATE * least_cosine(len(ids)) - float(np.sqrt(square[out].sum())) / length, 1e-6)
        kept = np.setdiff1d(np.arange(len(term)), out)
        rows.append((term[kept], np.full(len(kept), i), tf[kept] * idf[term[kept]] ** 2 / length))
    term, item, share = (np.concatenate(x) for x in zip(*rows, strict=True))
    order = np.argsort(term, kind="stable")
    first = np.searchsorted(term[order], np.arange(len(idf)))
    return Postings(item[order].astype(np.int32), share[order].astype(np.float32), np.append(first[:-1], [0, 0]), np.append(np.diff(first), [0, 0]), least)


def least_cosine(length: int) -> float:
    """Least cosine between a passage and an item of that many words."""
    return MIN_COSINE * min(1.0, (length / HALF) ** 0.5)


class Latent(NamedTuple):
    """A block of items: rows of the projected terms (0 for all others and for none), the items' passages, and where each item's passages begin."""

    row: np.ndarray
    projected: np.ndarray
    queries: np.ndarray
    begins: np.ndarray


def _latent(texts: DataFrame, items: list[np.ndarray], idf: np.ndarray) -> Latent:
    own = np.unique(np.concatenate(items))
    place = np.append(np.full(len(idf), len(own)), len(own) + 1)
    place[own] = np.arange(len(own))
    basis = latent_basis(texts, items, place, np.append(idf[own], idf[-1]))
    projected = np.vstack([np.zeros((1, basis.shape[1])), basis * idf[own, None]]).astype(np.float32)
    row = np.zeros(len(place), np.int32)
    row[own] = np.arange(1, len(own) + 1)
    queries = [_passage_sums(projected[row[ids]], len(ids)) for ids in items]
    begins = np.cumsum([0, *map(len, queries)])
    queries = np.concatenate(queries)
    return Latent(row, projected, (queries / np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)).astype(np.float32), begins)


def _search(docs: DataFrame, items: list[tuple]) -> DataFrame:
    """Leaks of PASS * BLOCK items at most."""
    spark = docs.sparkSession
    vocabulary = {w: i for i, w in enumerate(sorted({w for _, ws, _ in items for w in ws}))}
    terms = len(vocabulary)
    for w in itertools.chain.from_iterable(answer for *_, answer in items):
        vocabulary.setdefault(w, len(vocabulary))  # other words of answers only count in the check
    items = [(key, *(np.array([vocabulary[w] for w in ws]) for ws in parts)) for key, *parts in items]
    asked = [ids for _, ids, _ in items]
    texts = word_ids(docs, vocabulary)
    df, n = document_frequencies(texts, terms)
    idf = np.log((1 + n) / (1 + df)) + 0.1
    idf = np.append(idf, idf.mean())  # the last: any other word weighs as a term of the items does on average
    blocks = [_latent(texts, asked[lo : lo + BLOCK], idf) for lo in range(0, len(asked), BLOCK)]
    shared = spark.sparkContext.broadcast((np.append(idf**2, 0), tuple(postings_of(asked, idf)), [tuple(b) for b in blocks], items))  # PASS * BLOCK items at most
    schema = f"id {dict(docs.dtypes)['id']}, item long, cosine double, lcs_share double, answer_share double, first_word long, n_words long"

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squares, postings, blocks, items = shared.value
        squares, postings, blocks, lengths = squares.astype(np.float32), Postings(*postings), [Latent(*b) for b in blocks], [len(ids) for _, ids, _ in items]
        parts = [(ids.tolist(), answer.tolist()) for _, ids, answer in items]
        for batch in batches:
            texts = [_ids(ids) for ids in batch["ids"]]
            hits = [h for p in passages(texts, len(squares) - 2) for h in _hits(p, squares, postings, blocks, lengths)]
            best: dict[tuple, tuple] = {}
            for text, item, lo, hi, cosine in _spans(hits):
                span = texts[text][max(lo - HALF, 0) : hi + HALF].tolist()
                share, answered, hit = leak(*parts[item], span)
                if hit and ((text, item) not in best or share > best[text, item][3]):
                    best[text, item] = (batch["id"][text], items[item][0], cosine, share, answered, max(lo - HALF, 0), len(span))
            yield pd.DataFrame(list(best.values()), columns=["id", "item", "cosine", "lcs_share", "answer_share", "first_word", "n_words"])

    return texts.mapInPandas(searched, schema)


def _spans(hits: list[tuple[int, int, int, float]]) -> Iterator[tuple[int, int, int, int, float]]:
    """Spans (text, item, first word, end, cosine) of neighbouring passages that come near an item."""
    hits.sort()
    at = 0
    while at < len(hits):
        text, item, first, best = hits[at]
        end = first + WINDOW
        at += 1
        while at < len(hits) and hits[at][:2] == (text, item) and hits[at][2] <= end:
            end, best = max(end, hits[at][2] + WINDOW), max(best, hits[at][3])
            at += 1
        yield text, item, first, end, best


def _hits(p: Passages, squares: np.ndarray, postings: Postings, blocks: list[Latent], lengths: list[int]) -> Iterator[tuple[int, int, int, float]]:
    """Passages (text, item, first word, cosine) that come near one of the item's passages."""
    whole = squares[p.ids].sum(1)
    whole = whole[p.first] + whole[p.second]
    passage, item = postings.near(p, whole)
    for b in np.unique(item // BLOCK):
        latent = blocks[b]
        mine = item // BLOCK == b
        some, at = np.unique(passage[mine], return_inverse=True)
        rows = latent.row[np.hstack([p.ids[p.first[some]], p.ids[p.second[some]]])]
        known = np.flatnonzero(rows)
        first = np.searchsorted(known, np.arange(len(some)) * WINDOW)  # a candidate holds a term of the item
        sums = np.add.reduceat(latent.projected[rows.ravel()[known]], first, axis=0) / np.sqrt(whole[some])[:, None]
        begin = latent.begins[item[mine] % BLOCK]
        size = latent.begins[item[mine] % BLOCK + 1] - begin
        ends = np.cumsum(size)
        query = np.repeat(begin - ends + size, size) + np.arange(ends[-1])
        cosines = np.maximum.reduceat(np.einsum("ij,ij->i", latent.queries[query], sums[np.repeat(at, size)]), ends - size)
        for k, i, cosine in zip(passage[mine].tolist(), item[mine].tolist(), cosines.tolist(), strict=True):
            if cosine >= least_cosine(lengths[i]):
                yield int(p.text[k]), i, int(p.at[k]), cosine


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, exactly or paraphrased, with the item and the span."""
    return leaks(table(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark", "item_id", "text"))
