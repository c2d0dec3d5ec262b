"""Toxicity scores by non-negative positive-unlabelled learning."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded_batches, fold, stored, table, unit_hash

#: Bounds of the training sample: confirmed toxic rows, unlabelled rows, words and beginnings used as features.
MAX_POSITIVE, MAX_UNLABELLED, MAX_FEATURES = 8_000, 16_000, 20_000
#: Features in fewer texts, or whose rates in the two samples differ by fewer standard errors, are left out.
MIN_COUNT, MIN_Z = 5, 4.5
#: Lengths of the beginnings of words that are features beside the words, so that inflected and compound forms share what is learnt.
BEGINNINGS = (5, 7)
#: Name of the feature that stands for the length of a text, and how many distinct words count as one unit of it.
LENGTH, UNIT = "", 64

_words = re.compile(r"[^\W\d_]+").findall


def features(text: str | None) -> set[str]:
    """The distinct lower-cased words of a text, and the beginnings that two (one trailing dash), or three and more (two dashes, too) of them share."""
    found = set(_words((text or "").lower()))
    shared = Counter(w[:n] for n in BEGINNINGS for w in found if len(w) > n)
    return found.union(*([b + "-", b + "--"][: k - 1] for b, k in shared.items() if k > 1))


def length_units(found: Iterable[str]) -> int:
    """Length of a text of those features, in units of UNIT distinct words. A long text holds more words by chance, which a weight of its own can offset."""
    return sum(not w.endswith("-") for w in found) // UNIT


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_nnpu(rows: list[np.ndarray], positive: np.ndarray, prior: float, start: np.ndarray, seed: int, steps: int = 400, rate: float = 0.02, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear classifier over the features present in a row, from start weights.

    Minimises prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)]) with the sigmoid loss l(g) = 1 / (1 + exp(g)). Where the
    estimated risk of negatives falls below zero, the step goes against it instead, so unlabelled rows are not fitted as negatives.
    """
    rng = np.random.default_rng(seed)
    groups = [np.flatnonzero(positive), np.flatnonzero(~positive)]
    k = len(start)
    x, m, v = np.append(start, np.log(prior / (1 - prior))), np.zeros(k + 1), np.zeros(k + 1)
    for step in range(1, steps + 1):
        parts = []
        for group in groups:
            chosen = rng.choice(group, min(len(group), 1024))
            lengths = np.fromiter((len(rows[i]) for i in chosen), np.int64, len(chosen))
            flat = np.concatenate([rows[i] for i in chosen]).astype(np.int64)
            owner = np.repeat(np.arange(len(chosen)), lengths)
            parts.append((flat, owner, _logistic(np.bincount(owner, x[flat], len(chosen)) + x[k])))
        (fp, op, sp), (fu, ou, su) = parts
        slope_p, slope_u = sp * (1 - sp) / len(sp), su * (1 - su) / len(su)
        if su.mean() - prior * sp.mean() >= 0:
            cp, cu = -2 * prior * slope_p, slope_u
        else:
            cp, cu = prior * slope_p, -slope_u
        grad = np.append(np.bincount(fp, cp[op], k) + np.bincount(fu, cu[ou], k), cp.sum() + cu.sum()) + l2 * (x - np.append(start, x[k]))
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        x = x - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return x[:k], float(x[k])


def platt(g: np.ndarray, toxic: np.ndarray, prior: float) -> tuple[float, float]:
    """Slope and offset that turn g into probabilities on labelled rows, weighted to the class prior."""
    w = np.where(toxic, prior / max(toxic.sum(), 1), (1 - prior) / max((~toxic).sum(), 1))
    design, ab = np.stack([g, np.ones(len(g))], 1), np.array([1.0, 0.0])
    for _ in range(50):
        p = _logistic(design @ ab)
        hessian = (design * (w * p * (1 - p))[:, None]).T @ design + 1e-4 * np.eye(2)
        ab = ab - np.clip(np.linalg.solve(hessian, design.T @ (w * (p - toxic)) + 1e-4 * (ab - [1.0, 0.0])), -2, 2)
    return float(max(ab[0], 0.1)), float(ab[1])


def _drawn(learn: DataFrame, labels: DataFrame, models: int) -> tuple[DataFrame, float] | tuple[None, tuple[float, ...]]:
    """Bounded sample of distinct texts (digest, kind, words) and the class prior; without any positive, None and the biases of an empty model."""
    key, digest = F.xxhash64("doc_id", "text"), F.xxhash64("text")
    known = learn.select("doc_id", key.alias("key"), digest.alias("digest"))
    known = known.join(labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "doc_id", "left")
    n, n_known, n_toxic = known.agg(F.count("*"), F.count("toxic"), F.count_if(F.col("toxic") == 1)).first()
    if not n_toxic:
        return None, (-30.0,) * models
    free, n_clean = n - n_known, n_known - n_toxic
    u = unit_hash(F.col("key"), F.lit("sample"))
    clean = F.col("toxic").isNotNull() & ((u < MAX_POSITIVE / max(n_clean, 1)) if free else (u * 2 < 1))
    kind = F.when(F.col("toxic") == 1, "toxic").when(clean, "clean").otherwise("free")
    bound = F.when(F.col("kind") == "toxic", MAX_POSITIVE / n_toxic).when(F.col("kind") == "clean", MAX_POSITIVE / max(n_clean, 1)).otherwise(MAX_UNLABELLED / max(free or n, 1))
    usable = (F.col("kind") != "free") | F.col("toxic").isNull() | F.lit(not free)
    drawn = known.withColumn("kind", kind).where((u < bound) & usable).groupBy("key").agg(F.max("kind").alias("kind"))  # the bounds hold for distinct keys

    @F.pandas_udf("array<string>")
    def distinct_words(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([sorted(features(t)) for t in batch])

    rows = learn.select(key.alias("key"), digest.alias("digest"), "text").join(F.broadcast(drawn), "key")
    texts = rows.groupBy("digest").agg(F.max("kind").alias("kind"), F.first("text").alias("text"))  # a text counts once, as toxic if any copy is
    return stored(texts.select("digest", "kind", distinct_words("text").alias("words"))), min(max(n_toxic / n_known, 1e-4), 1 - 1e-4)


def _word_rates(sample: DataFrame) -> DataFrame:
    """Rows (word, p, u): in how many toxic and unlabelled texts of the sample a word occurs."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for kind in ("toxic", "free"):
                if not (total := Counter(w for words in batch["words"][batch["kind"] == kind] for w in words)):
                    continue
                n = np.fromiter(total.values(), np.int64, len(total))
                yield pd.DataFrame({"word": list(total), "p": n * (kind == "toxic"), "u": n * (kind == "free")})

    return sample.select("kind", "words").mapInPandas(counted, "word string, p long, u long").groupBy("word").agg(F.sum("p").alias("p"), F.sum("u").alias("u"))


def train(learn: DataFrame, labels: DataFrame, models: int = 3) -> tuple[dict[str, tuple[float, ...]], tuple[float, ...]]:
    """Weights of words, beginnings of words and length, and biases of the classifiers, one value for each model.

    learn: doc_id, text of the rows that may be learnt from; labels: doc_id, toxic. Positives are rows that a label confirms as toxic,
    the unlabelled sample is drawn from the rows without label (from all of them if each has one). The class prior is the toxic
    share of labelled rows. Rows labelled clean, and a quarter of the positives, only set the scale of the scores. The three samples are
    bounded by MAX_POSITIVE, MAX_UNLABELLED and MAX_POSITIVE on average, and drawn by a hash of id and text. An id with several labels
    is toxic if one of them says so. Rows that repeat an id are rows of their own; a text that occurs more than once is in the sample
    once, and toxic if one of its rows is. Null ids are unlabelled, null texts empty. Neither the order nor the partitions of the rows
    matter. Without a toxic row, or without unlabelled ones, there are no weights.
    """
    bounded_batches(learn.sparkSession)
    sample, prior = _drawn(learn, labels, models)
    if sample is None:
        return {}, prior
    of = lambda k: F.count_if(F.col("kind") == k)
    n_p, n_u = sample.agg(of("toxic"), of("free")).first()
    if not n_p or not n_u:
        return {}, (float(np.log(prior / (1 - prior))),) * models
    rate_p, rate_u, pooled = F.col("p") / n_p, F.col("u") / n_u, (F.col("p") + F.col("u")) / (n_p + n_u)
    z = F.abs(rate_p - rate_u) / F.sqrt(pooled * (1 - pooled) * (1 / n_p + 1 / n_u) + 1e-12)
    clean_rate = F.greatest((rate_u - prior * rate_p) / (1 - prior), F.lit(0.0))
    counts = _word_rates(sample).withColumns({"z": z, "start": F.log((rate_p + 0.5 / n_p) / (clean_rate + 2 / n_u))})
    likely = counts.where((F.col("p") + F.col("u") >= MIN_COUNT) & (F.col("z") >= MIN_Z))
    chosen = likely.orderBy(F.desc("z"), "word").limit(MAX_FEATURES).select("word", "start").toArrow().to_pandas()
    chosen = pd.concat([chosen, pd.DataFrame({"word": [LENGTH], "start": [0.0]})], ignore_index=True)
    shared = learn.sparkSession.sparkContext.broadcast({w: i for i, w in enumerate(chosen["word"])})  # MAX_FEATURES and the length at most

    @F.pandas_udf("array<int>")
    def present(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = shared.value
        for batch in batches:
            yield pd.Series([[index[w] for w in words if w in index] + [index[LENGTH]] * length_units(words) for words in batch])

    hits = sample.select("digest", "kind", present("words").alias("present")).toArrow().sort_by("digest").to_pandas()  # bounded sample
    rows = [np.asarray(x, np.int64) for x in hits["present"]]
    toxic, clean = (hits["kind"] == "toxic").to_numpy(), (hits["kind"] == "clean").to_numpy()
    aside = clean | (toxic & (hits["digest"].to_numpy() % 4 == 3))
    used = np.flatnonzero(~aside)
    fits = []
    for seed in range(models):
        w, b = fit_nnpu([rows[i] for i in used], toxic[used], prior, chosen["start"].to_numpy(float), seed)
        g = np.array([w[rows[i]].sum() + b for i in np.flatnonzero(aside)])
        slope, offset = platt(g, toxic[aside], prior) if clean.any() else (1.0, 0.0)
        fits.append((w * slope, b * slope + offset))
    return {word: tuple(float(w[i]) for w, _ in fits) for i, word in enumerate(chosen["word"])}, tuple(float(b) for _, b in fits)


def scored(docs: DataFrame, model: tuple[dict, tuple], text: str = "text", threshold: float = 0.3) -> DataFrame:
    """Adds score, the mean probability of the classifiers over the whole text, and predicted (score >= threshold).

    A null or empty text gets the score of a text without any known word; equal texts get equal scores. Columns of docs with these two
    names are replaced, all others stay. An empty table gives no row. Nothing is shuffled.
    """
    shared = bounded_batches(docs.sparkSession).sparkContext.broadcast(model)  # MAX_FEATURES words at most

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, biases = shared.value
        biases = np.asarray(biases)
        for batch in batches:
            out = np.empty(len(batch))
            for i, t in enumerate(batch):
                found = features(t)
                length = length_units(found) * np.asarray(weights.get(LENGTH, 0.0))
                out[i] = _logistic(biases + sum((np.asarray(weights[w]) for w in sorted(weights.keys() & found)), length)).mean()
            yield pd.Series(out)

    return docs.withColumn("score", score(F.col(text))).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document; a quarter of the ids is held out of the learning."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").withColumn("held_out", F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False)))
    learn = docs.where(~F.col("held_out")).select("doc_id", "text")
    return scored(docs, train(learn, table(spark, sf_dir, "labels", "doc_id", "toxic"))).select("doc_id", "held_out", "score", "predicted")
