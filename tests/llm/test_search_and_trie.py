"""Prefix trie, reversed lexical search and nearest neighbours: odd rows against SQL, brute force and recall."""

import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from barwright.llm import lexical, polytope, prefix_trie, queries
from tests.oracle import compare, rows_of

TURNS = "conv_id long, turn long, role string, text string"


def written(spark, folder, name, rows, schema):
    folder.mkdir(exist_ok=True)
    spark.createDataFrame(rows, schema).withColumns({c: F.lit("clash") for c in ("conv", "k", "d", "n", "row", "v", "rep", "first", "terms", "score", "rank", "group", "words")}).write.mode(
        "overwrite"
    ).parquet(f"{folder}/{name}.parquet/part")
    return str(folder)


def sql_rows(folder, name, tables):
    """Columns and rows of the query's SQL on a folder's tables."""
    con = duckdb.connect()
    for t in tables:
        con.sql(f"create view {t} as select * from read_parquet('{folder}/{t}.parquet/part/*.parquet')")
    r = con.sql(queries.ORACLE_SQL[name])
    columns, expected = [d[0] for d in r.description], r.fetchall()
    return columns, expected


def conversations():
    rng = random.Random(41)
    rows = [(None, 0, "a", "nobody's"), (4, None, None, None), (4, None, "x", ""), (4, 2, "b", "two words"), (4, 2, "b", "two words"), (4, 2, "a", "tie")]
    for c in [*range(20, 46), *range(60, 75), 103, 107, -3]:  # no conversation 100, so its block is built on nothing
        first = rng.choice(["hi", "hello there", "hi"])
        rows += [(c, t, rng.choice("ab") if t else "a", first if not t else f"t{rng.randrange(2)} x y") for t in range(rng.choice([1, 1, 2, 3, 5, 8]))]
    rows += [(81, t, "a", "all the same") for t in range(70)] + [(82, t, "a", "all the same") for t in range(64)] + [(83, 7, "a", "one turn") for _ in range(40)]
    return rows


@pytest.mark.parametrize("band", [2, 3, 16])
def test_trie_of_odd_and_long_conversations(spark, tmp_path, monkeypatch, band):
    monkeypatch.setattr(prefix_trie, "BAND", band)
    folder = written(spark, tmp_path / "turns", "conversations", conversations(), TURNS)
    df = prefix_trie.prefix_trie(spark.read.parquet(f"{folder}/conversations.parquet/part").repartition(5))
    columns, expected = sql_rows(folder, "op11_prefix_trie", ["conversations"])
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, expected)


def test_trie_by_hand(spark):
    rows = [(c, t, "a", x) for c, texts in {0: ["p q", "r"], 20: ["p q", "r"], 40: ["p q", "s t u"], 60: []}.items() for t, x in enumerate(texts)]
    got = {(r["conv_id"], r["depth"]): r for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, TURNS)).collect()}
    assert sorted(got) == [(0, 0), (0, 1), (0, 2), (40, 2)]
    assert got[0, 0]["n_leaves"] == 2 and got[0, 0]["saved_tokens"] == 2 * 2 + 1 and got[0, 1]["n_children"] == 2 and got[40, 2]["parent_conv_id"] == 0


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_lexical_search"])
def test_oracle(spark, sf, name):
    compare(spark, sf, queries.QUERIES[name], queries.ORACLE_SQL[name])


@pytest.mark.parametrize("postings", [250_000, 40])
def test_search_of_odd_texts(spark, tmp_path, postings):
    rng = random.Random(42)
    words = [f"w{i}" for i in range(40)] + ["Été", "x-y", "ÄB", "a1", "don't", "\u0085", "z" * 500]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 60)))) for i in range(120)]
    docs += [(None, "W1 w2 w3"), (None, "w1 W2 w3"), (7, docs[7][1]), (500, None), (501, ""), (502, " -- \n"), (503, "w1 " * 3000), (2**60 + 1, "w4 w5"), (2**60, "w4 w5")]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 15)))) for i in range(25)] + [(3, "w1 w1 W1"), (None, "w2 w4"), (30, None), (31, ""), (32, "nothing like it")]
    folder = written(spark, tmp_path / "docs", "documents", docs, "doc_id long, text string")
    written(spark, tmp_path / "docs", "benchmark", items, "item_id long, text string")
    read = lambda t: spark.read.parquet(f"{folder}/{t}.parquet/part")
    df = lexical.ranked(read("documents").repartition(4), read("benchmark"), postings=postings)
    columns, expected = sql_rows(folder, "op12_lexical_search", ["documents", "benchmark"])
    assert sorted(df.columns) == sorted(columns) and expected
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, expected)


def test_items_are_dealt_to_bounded_groups(spark):
    items = spark.createDataFrame([(i, [f"t{j}" for j in range(10 if i else 90)]) for i in range(30)], "row long, terms array<string>")
    dealt, groups = lexical.grouped(items, 60)
    sizes = dealt.groupBy("group").agg(F.sum(F.size("terms")).alias("terms"), F.count("*").alias("n")).collect()
    assert groups >= 7 and sum(s["n"] for s in sizes) == 30 and all(s["terms"] <= 60 or s["n"] == 1 for s in sizes)


def vectors():
    rng = np.random.default_rng(43)
    x = rng.standard_normal((900, 24)) * rng.uniform(0.2, 3, (900, 1))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(i, rows[40][1]) for i in range(900, 1000)]  # copies
    rows += [(i, (np.array(rows[60][1]) + 1e-3 * rng.standard_normal(24)).tolist()) for i in range(1000, 1200)]  # near copies
    rows += [(1200, None), (1220, []), (1240, [0.0] * 24), (1260, [None] + [1.0] * 23), (1280, [float("nan")] * 24), (1300, [float("inf")] * 24), (None, rows[3][1]), (20, rows[5][1]), (1320, [1.0, 2.0]), (1340, [2.0, 1.0])]
    return rows


def brute_force(rows, k):
    """Scores of the k nearest of each query row, best first."""
    usable = [(i, np.array(v, float)) for i, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for at, (i, q) in enumerate(usable):
        if i is not None and i % 20 == 0:
            out.setdefault(i, []).append(sorted(((float(q @ v), j) for n, (j, v) in enumerate(usable) if n != at and len(v) == len(q)), key=lambda s: (-s[0], s[1] is None, s[1] or 0))[:k])
    return out


@pytest.mark.parametrize("chunk", [polytope.CHUNK, 24 * 32])
def test_nearest_neighbours_by_brute_force(spark, tmp_path, chunk):
    rows = vectors()
    folder = written(spark, tmp_path / "vectors", "embeddings", rows, "vec_id long, embedding array<double>")
    df = polytope.neighbours(spark.read.parquet(f"{folder}/embeddings.parquet/part"), F.col("vec_id") % 20 == 0, chunk=chunk)
    got = {}
    for r in df.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = brute_force(rows, 20)
    assert got.keys() == {q for q, lists in want.items() if any(lists)}
    met = total = 0
    for q, lists in want.items():
        found = sorted(got.get(q, []), key=lambda r: r[0])
        assert len(found) == sum(map(len, lists)) and (len(lists) > 1 or [r[0] for r in found] == list(range(1, len(found) + 1)))
        if len(lists) == 1:
            assert [-r[2] for r in found] == sorted(-r[2] for r in found) and q not in [r[1] for r in found]
            near = [round(s, 9) for s, _ in lists[0]]
            met += sum(round(r[2], 9) >= near[-1] for r in found) if near else 0
            total += len(near)
    assert met >= 0.93 * total
    # a query among copies meets those with the smallest ids, in order
    copies = [r[1] for r in sorted(got[960]) if r[1] == 40 or 900 <= r[1] < 1000]
    assert len(copies) >= 10 and copies == [40, *range(900, 1000)][: len(copies)]


def test_hadamard_keeps_norms_and_cells_attract_near_vectors():
    rng = np.random.default_rng(44)
    x = rng.standard_normal((50, 64))
    assert np.allclose(np.linalg.norm(polytope.hadamard(x), axis=1), np.linalg.norm(x, axis=1))
    assert np.allclose(polytope.hadamard(polytope.hadamard(x)), x)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    same = [(polytope.own_cell(x, t, 1) == polytope.own_cell(x + 0.01 * rng.standard_normal(x.shape), t, 1)).mean() for t in range(4)]
    other = [(polytope.own_cell(x, t, 1) == polytope.own_cell(x[::-1].copy(), t, 1)).mean() for t in range(4)]
    assert np.mean(same) > 0.8 > 0.2 > np.mean(other)


def test_recall_on_the_table(spark, sf):
    got = {}
    for r in queries.QUERIES["op13_nearest_neighbours"](spark, sf).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = {q: {j for _, j in lists[0]} for q, lists in brute_force(rows, 20).items()}
    assert sum(len(want[q] & got[q]) for q in want) >= 0.9 * sum(map(len, want.values()))
