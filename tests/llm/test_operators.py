"""The operators against brute force, on small tables with null, empty, long, tied and repeated rows and clashing column names."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwright.llm import chat, common, decontaminate, language, lattice, mixing, ppm, queries, secrets, simhash, token_counts, toxicity
from tests.oracle import compare

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, id string, fp string, score string, words string"


def docs_of(spark, texts, sources=("a",)):
    rows = [(i, t, "en", sources[i % len(sources)], 0, "r", "i", "f", "s", "w") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def roots(ids, linked):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def odd_texts(n=40, seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 7)))
    base = [" ".join(word() for _ in range(rng.randrange(1, 60))) for _ in range(n)]
    near = [t + " " + word() for t in base[:10]]
    return [None, "", " \t\n", "One", "Two words", *base, *base[:5], *near, "x " * 30000 + "end"]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(i, i + 1) for i in range(100, 130)]
    got = {r["node"]: r["root"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots({x for e in edges for x in e}, edges)
    assert got == {k: v for k, v in want.items() if k in got} and all(k in got for e in edges if e[0] != e[1] for k in e)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("hot", [1, 1000])
def test_simhash_links(spark, hot):
    rng = random.Random(4)
    fps = {0}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(8):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    pairs = [(min(a, b), max(a, b)) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= 2]
    got = [tuple(r) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), hot).collect()]
    assert set(got) <= set(pairs) | {(b, a) for a, b in pairs}
    assert roots(signed, got) == roots(signed, pairs)
    if hot > 1:
        assert {tuple(sorted(g)) for g in got} == set(pairs)


def test_simhash_near_duplicates(spark):
    texts = odd_texts()
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    fps = {i: simhash.fingerprint(t) for i, t in enumerate(texts)}
    want = roots(list(fps), [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 2])
    assert {i: r["component_id"] for i, r in got.items()} == want and fps[0] == fps[1] == fps[2] == 0
    assert simhash.near_duplicates(docs_of(spark, [])).count() == 0


def test_token_counts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(6)
    bits = [" ", "  ", "\n", "\t", " \n ", "the", "The", "'s", "I'm", "123", "ß", "日本", "🙂", "...", "<|endoftext|>", "\x1c", " ", "　", "zqx", "-", "é"]
    texts = [*odd_texts(), *("".join(rng.choice(bits) for _ in range(rng.randrange(1, 25))) for _ in range(400))]
    out = token_counts.token_counts(docs_of(spark, texts), open(path, encoding="utf-8").read(), public_tokenizers.PATTERN, 10)
    for r in out.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect():
        t = texts[r["doc_id"]] or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r["n_tokens"], r["n_bytes"], r["over_limit"]) == (n, len(t.encode()), n > 10), t[:50]


def brute_ppm(tables, s, order):
    total = 0.0
    for j in range(order, len(s)):
        gone = set()
        for k in range(order, -1, -1):
            seen = tables[k].get(s[j - k : j])
            if not seen:
                continue
            left, kinds = sum(v for a, v in seen.items() if a not in gone), sum(a not in gone for a in seen)
            if s[j] in seen:
                total += math.log10(seen[s[j]] / (left + kinds))
                break
            if left:
                total += math.log10(kinds / (left + kinds))
            gone = set(seen)
        else:
            total -= math.log10(256 - len(gone))
    return total


def test_lm_scores(spark, tmp_path):
    texts = odd_texts(60)[:-1] + ["new WORDS here", "x " * 500]
    docs_of(spark, texts).write.parquet(str(tmp_path / "documents.parquet"))
    got = {r["doc_id"]: r for r in ppm_query(spark, tmp_path).collect()}
    tok = lambda t: (t or "").encode().lower().split()
    learn = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 5 != 1]
    counts = collections.Counter(w for i in learn for w in [*tok(texts[i]), None])
    n, v = sum(counts.values()), len(counts)
    tables = [collections.defaultdict(collections.Counter) for _ in range(ppm.ORDER + 1)]
    pad = ppm.END * ppm.ORDER
    for i in learn:
        s = pad + ppm.stream(texts[i]) + ppm.END
        for j in range(ppm.ORDER, len(s)):
            for k in range(ppm.ORDER + 1):
                tables[k][s[j - k : j]][s[j]] += 1
    for i, t in enumerate(texts):
        words, r = [*tok(t), None], got[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(words), sum(counts[w] > 0 for w in words), n, i not in learn)
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words))
        assert r["score"] == pytest.approx(brute_ppm(tables, pad + ppm.stream(t) + ppm.END, ppm.ORDER))


def ppm_query(spark, path):
    return queries.QUERIES["op6_lm_scores"](spark, str(path))


def test_trie_pruning_bound(spark):
    texts = docs_of(spark, odd_texts())
    full, few = ppm.train(texts), ppm.train(texts, max_leaves=200)
    assert len(few[0]) <= 200 < len(full[0]) and few[1].min() > 1


@pytest.mark.parametrize("max_leaves", [0, 200])
def test_lm_scores_beyond_the_shipped_leaves(spark, max_leaves):
    """More leaves than are shipped change no score: rare and unseen codes are joined."""
    texts = [*odd_texts(60)[:-1], "new WORDS here", "x " * 500, "日本 тест 🙂"]
    docs = docs_of(spark, texts).select("doc_id", "text")
    learn = docs.where("doc_id % 3 <> 1")
    counts = common.stored(ppm.word_counts(learn))
    args = (ppm.code_counts(learn), counts, 1000, learn.count())
    want = {r["doc_id"]: r for r in ppm.scored(docs, *args).collect()}
    got = {r["doc_id"]: r for r in ppm.scored(docs, *args, max_leaves=max_leaves).collect()}
    assert got.keys() == want.keys() and args[0].count() > 200
    assert all(got[i]["score"] == pytest.approx(want[i]["score"]) and got[i][:-1] == want[i][:-1] for i in want)


@pytest.mark.parametrize(("crowd", "chunk"), [(64, 1024), (2, 5)])
def test_embeddings(spark, crowd, chunk):
    """Links, components and counts against brute force, by listed pairs and by blocks of crowded cells, whatever the scale of a vector."""
    rng = np.random.default_rng(8)
    base = rng.standard_normal((120, 64))
    near = base[:40] + rng.standard_normal((40, 64)) * 0.2
    dense = base[100] + rng.standard_normal((30, 64)) * 0.12
    far = base[90] + rng.standard_normal(64) * 0.45  # cosine of some 0.9, not linked at any scale
    rows = [*base.tolist(), *near.tolist(), *base[:5].tolist(), *(base[:3] * 2).tolist(), *dense.tolist(), *dense[:4].tolist()]
    rows += [(base[10] * 1e200).tolist(), (base[11] * 1e-200).tolist(), (base[90] * 1e200).tolist(), (far * 1e200).tolist(), (far * 1e-200).tolist()]
    rows += [None, [0.0] * 64, [float("nan")] * 64, [None] * 64, [float("inf")] * 64, [1.0] * 8, [1.0] * 8, []]
    vectors = spark.createDataFrame([(i, v, 1, "x") for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int, rep string")
    good = [i for i, v in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    scaled = {i: np.array(rows[i]) / np.abs(rows[i]).max() for i in good}
    unit = {i: x / np.linalg.norm(x) for i, x in scaled.items()}
    pairs = [(a, b) for a, b in itertools.combinations(good, 2) if len(rows[a]) == len(rows[b]) and unit[a] @ unit[b] >= 0.95]
    degree, want = collections.Counter(x for p in pairs for x in p), roots(range(len(rows)), pairs)
    got = {r["vec_id"]: r for r in lattice.near_duplicates(vectors, crowd=crowd, chunk=chunk).collect()}
    assert len(pairs) > 400 and sum(r["n_links"] for r in got.values()) >= 0.95 * 2 * len(pairs)
    assert all(r["n_links"] <= degree[i] for i, r in got.items())
    assert sum(r["component_id"] == want[i] for i, r in got.items()) >= 0.95 * len(rows)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i in range(len(rows)) if i not in good)
    other = {r["vec_id"]: r["n_links"] for r in lattice.near_duplicates(vectors, crowd=10**6).collect()}
    assert {i: r["n_links"] for i, r in got.items()} == other  # a pair counts once, wherever it meets


def test_embeddings_odd_tables(spark):
    schema = "vec_id long, embedding array<double>, first string, size int, root int"
    assert lattice.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 2.0]), (5, [2.0, 4.0]), (5, [-1.0, 0.5]), (5, [1.0, 2.0]), (None, None)]
    got = lattice.near_duplicates(spark.createDataFrame([(*r, "f", 1, 2) for r in rows], schema)).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=str) == sorted([(None, 2, 5), (5, 2, 5), (5, 0, 5), (5, 2, 5), (None, 0, None)], key=str)


def test_lattice_decoding():
    rng = np.random.default_rng(9)
    roots_ = lattice.minimal_vectors()
    assert roots_.shape == (240, 8) and np.allclose((roots_**2).sum(1), 2)
    y = rng.standard_normal((200, 8)) * 2
    p = lattice.nearest_e8(y)
    assert np.allclose(np.mod(p.sum(1), 2), 0) and np.allclose(np.mod(2 * p, 1), 0)
    d = ((y - p) ** 2).sum(1)
    assert d.max() <= 1 + 1e-9 and all((((y[i] - p[i] - roots_) ** 2).sum(1) >= d[i] - 1e-9).all() for i in range(200))


def test_targets_and_mix(spark):
    rng = random.Random(10)
    texts = [None, ""] + [" ".join(["w"] * rng.randrange(0, 200)) for _ in range(300)]
    sources = ["big"] * 12 + ["b", "c", None, "tiny"]
    df = docs_of(spark, texts, sources).withColumn("size", F.lit("clash"))
    rows = mixing.mixed(df).collect()
    again = mixing.mixed(df.repartition(7)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again)) and len(rows) == len(texts)
    size = {r["doc_id"]: len((texts[r["doc_id"]] or "").split()) for r in rows}
    by = collections.defaultdict(list)
    for r in rows:
        assert r["size"] == size[r["doc_id"]] and 0 <= r["taken"] <= 3 * r["size"]
        by[r["source"]].append(r)
    order = sorted((s for s in by if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    cap = {s: 3 * sum(r["size"] for r in by[s]) for s in order}
    total, full = sum(cap.values()) / 3, set()
    while True:
        level = (total - sum(cap[s] for s in full)) / sum(weight[s] for s in order if s not in full)
        over = {s for s in order if s not in full and level * weight[s] > cap[s]}
        if not over:
            break
        full |= over
    for s in order:
        target = cap[s] if s in full else level * weight[s]
        assert by[s][0]["target"] == pytest.approx(target) and by[s][0]["source_size"] == cap[s] // 3
        assert sum(r["taken"] for r in by[s]) == pytest.approx(target, abs=3 * mixing.BLOCK)
    assert mixing.mixed(docs_of(spark, [])).count() == 0


def test_mix_holds_the_texts(spark):
    """The mix is made of whole blocks of the sources' words, in its slots, and taken counts what stands in it."""
    rng = random.Random(16)
    texts = [None, "", *(" ".join(f"d{i}w{j}" for j in range(rng.randrange(0, 150))) for i in range(2, 122)), " \tlong " + "é " * 20000]
    df = docs_of(spark, texts, ("a", "b", None))
    df = df.union(df.limit(9))
    mix = mixing.mix(df, shard=16).collect()
    assert sorted(r["slot"] for r in mix) == list(range(len(mix))) and all(r["shard"] == r["slot"] // 16 for r in mix)
    seen, taken = {}, collections.Counter()
    for r in mix:
        words, ids = r["words"].split(" "), [p["id"] for p in r["parts"] for _ in range(p["n"])]
        assert len(words) == len(ids) <= mixing.BLOCK and seen.setdefault((r["sid"], r["block"]), words) == words
        assert all(w in ("long", "é") if i == len(texts) - 1 else w.startswith(f"d{i}w") for w, i in zip(words, ids))
        taken.update(ids)
    for p in {(p["start"], r["sid"], r["block"]): p for r in mix for p in r["parts"]}.values():
        assert texts[p["id"]]
    whole = collections.defaultdict(list)  # the words of a document's row, from its blocks in order
    for sid, block in sorted(seen):
        row = next(r for r in mix if (r["sid"], r["block"]) == (sid, block))
        at = 0
        for p in row["parts"]:
            whole[sid, p["start"], p["id"]].append((block, seen[sid, block][at : at + p["n"]]))
            at += p["n"]
    complete = 0
    for (_, _, i), cuts in whole.items():
        blocks_, words = [b for b, _ in cuts], [w for _, c in cuts for w in c]
        if len(words) == len(texts[i].split()):
            complete += 1
            assert words == texts[i].split() and blocks_ == list(range(blocks_[0], blocks_[0] + len(blocks_)))
    assert complete > 10
    got = collections.Counter()
    for r in mixing.mixed(df, shard=16).collect():
        got[r["doc_id"]] += r["taken"]
    assert {i: n for i, n in got.items() if n} == dict(taken)


def test_permutations(spark):
    for n in (1, 2, 7, 64, 100):
        out = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(3)).alias("p")).collect()
        assert sorted(r["p"] for r in out) == list(range(n))


def test_chat_oracle(spark, sf):
    compare(spark, sf, queries.QUERIES["op9_chat_rotation"], queries.ORACLE_SQL["op9_chat_rotation"])


def test_chat_cases(spark):
    rows = [(1, 0, "system", "be kind", "x"), (1, 1, "Ann ", "hi", "x"), (1, 2, "bob", None, "x"), (1, 2, "bob", None, "x"), (1, None, " ", "who", "x"), (2, 0, "system", "alone", "x"), (None, 5, "ann", "z" * 50000, "x"), (3, 999, "ann", "", "x"), (3, 3, "bob", "b", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, length string")
    got = chat.rotated(turns).collect()
    views = collections.defaultdict(list)
    for r in got:
        views[r["conv_id"], r["perspective"]].append(r)
    assert set(views) == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "ann"), (3, "ann"), (3, "bob")}
    for (_, who), v in views.items():
        v.sort(key=lambda r: r["char_start"])
        assert [r["char_start"] for r in v] == [0, *itertools.accumulate(len(r["segment"]) for r in v)][:-1]
        assert all((r["mask"] == 1) == (r["name"] == who) == (r["role"] == "assistant") for r in v)
        assert all(r["segment"].startswith("<|user name=" + r["name"]) for r in v if r["role"] == "user")


def test_toxicity(spark):
    rng = random.Random(11)
    plain = lambda: " ".join(rng.choice(["calm", "river", "stone", "tree", "blue"]) + str(rng.randrange(3)) for _ in range(20))
    texts = [None, "", *(plain() + (" vile nasty " if i % 6 == 0 else "") for i in range(900))]
    texts = [t.replace("0", "").replace("1", "").replace("2", "") if t else t for t in texts]
    df = docs_of(spark, texts)
    toxic = lambda i: int(bool(texts[i]) and "vile" in texts[i])
    labels = spark.createDataFrame([(i, toxic(i)) for i in range(2, 700) if i % 2 == 0] * 2, "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.scored(df.drop("score"), toxicity.train(df.select("doc_id", "text"), labels)).collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got.values()) and not got[0]["predicted"] and not got[1]["predicted"]
    assert sum(r["predicted"] == toxic(i) for i, r in got.items()) >= 0.98 * len(texts)
    assert toxicity.train(df.select("doc_id", "text"), labels.where("false"))[0] == {}


def test_toxicity_features():
    assert toxicity.features("Gruselig gruseliger, gruselt") == {"gruselig", "gruseliger", "gruselt", "gruse-", "gruse--", "gruseli-"}
    assert toxicity.features("gruselig gruselig") == {"gruselig"}  # repeats of one word share nothing
    assert toxicity.features(None) == toxicity.features("  ") == set()
    assert toxicity.length_units({f"w{i}" for i in range(130)} | {"gruse-", "gruse--"}) == 2


def test_toxicity_of_new_forms(spark):
    """Insults in forms that the learning rows don't hold are found by the beginnings that they share; long clean texts stay clean."""
    rng = random.Random(11)
    plain = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(3000)]
    text = lambda n, insults: " ".join(rng.sample(plain, n) + ["vilest" + "".join(rng.choices("klmnop", k=4)) for _ in range(insults)])
    rows = [(i, text(rng.choice([20, 40, 300]), 4 if i % 5 == 0 else 0)) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(0, 1500) if i % 3 == 0], "doc_id long, toxic int")
    asked = spark.createDataFrame([(i, text(30, 4 * (i % 2))) for i in range(60)] + [(100, text(2000, 0))], "doc_id long, text string")
    got = {r["doc_id"]: r["predicted"] for r in toxicity.scored(asked, toxicity.train(df, labels)).collect()}
    assert all(got[i] == i % 2 for i in range(60)) and got[100] == 0


def test_language(spark):
    rng = random.Random(12)
    alphabets = {"xa": "abcde", "yb": "fghij", "zc": "klmno"}
    rows = [(i, " ".join("".join(rng.choice(alphabets[k]) for _ in range(4)) for _ in range(15)), k) for i, k in enumerate(list(alphabets) * 40)]
    rows += [(900, None, "xa"), (901, "12 34 !!", None), (902, "", "yb"), (903, "abc " * 20000, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df)
    got = {r["doc_id"]: r for r in language.identified(df, model).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (900, 901, 902))
    assert got[903]["lang_pred"] == "xa" and sum(got[i]["lang_pred"] == k for i, _, k in rows[:120]) >= 118
    assert (model.weights == 0).mean() > 0.9
    empty = language.train(df.where("false"))
    assert {r["lang_pred"] for r in language.identified(df, empty).collect()} == {"und"}


def test_language_learns_from_all_rows(spark):
    """Words that only rows outside the first sample hold count for their language too."""
    rng = random.Random(8)
    say = lambda letters: " ".join("".join(rng.choices(letters, k=4)) for _ in range(12))
    rows = [(i, say("abcde" if i % 2 else "fghij"), "xa" if i % 2 else "yb") for i in range(400)]
    drawn = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("u", common.unit_hash("doc_id", "text", F.lit("lang")))
    late = {r["doc_id"] for r in drawn.where("u > 0.4").collect()}
    rows = [(i, t.translate(str.maketrans("abcdefghij", "pqrstuvwxy")) if i in late else t, k) for i, t, k in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    few = df.withColumn("u", common.unit_hash("doc_id", "text", F.lit("lang"))).where("u < 0.1").select("doc_id").collect()
    assert any(r["doc_id"] not in late for r in few)
    model = language.train(df, max_rows=40)
    assert sum(language.predict(t, *model)[0] == k for _, t, k in rows) >= 0.98 * len(rows)
    same = language.train(df.repartition(5), max_rows=40)
    assert (same.weights == model.weights).all() and same.temperature == model.temperature


def test_language_starts_from_all_rows(spark, monkeypatch):
    """The weights before the pass over all rows do not depend on ids, by a hash of which rows were drawn, and know what one row alone holds."""
    monkeypatch.setattr(language, "corrected", lambda known, langs, idf, z, n, weight: (z, n, 1.0))
    rng = random.Random(9)
    say = lambda letters, n: " ".join("".join(rng.choices(letters, k=4)) for _ in range(n))
    rows = [(i, say("abcde", 9) if i % 2 else say("fghij", 9), "xa" if i % 2 else "yb") for i in range(600)]
    rows[:2] = [(0, say("pqrst", 400), "yb"), (1, say("uvwxy", 400), "xa")]
    models = [language.train(spark.createDataFrame([(i + shift, t, k) for i, t, k in rows], "doc_id long, text string, lang string"), max_rows=20) for shift in (0, 1000)]
    assert (models[0].weights == models[1].weights).all()
    assert language.predict(say("pqrst", 60), *models[0])[0] == "yb" and language.predict(say("uvwxy", 60), *models[0])[0] == "xa"


def test_words_of_all_characters():
    """Runs of letters and digits, whichever way they are found."""
    rng = random.Random(3)
    few = "".join(map(chr, range(256)))
    for chars in (few, few + "İſK٣ⅷ\u2028\U0001d7d8中"):
        texts = ["".join(rng.choices(chars, k=200)) for _ in range(50)] + [chars, " ", "_", ""]
        assert [decontaminate.words(t) for t in texts] == [re.findall(r"[^\W_]+", t.lower()) for t in texts]
    assert decontaminate.words(None) == []


def test_lcs():
    rng = random.Random(13)
    for _ in range(60):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(1, 20))] for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert decontaminate.lcs(a, b) == t[-1][-1]


def test_decontamination(spark):
    rng = random.Random(14)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(900)]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [text(n) for n in (14, 25, 40, 60, 33, 18, 90, 21)]
    texts, leaked = [None, "", "one"], set()
    for i in range(60):
        if i % 3 == 0:
            k = i // 3 % len(items)
            w = items[k].split()
            if i % 2:
                w[len(w) // 3] = "changed"
            leaked.add((len(texts), k))
            texts.append(f"{text(rng.randrange(120))} {' '.join(w).title()}. {text(rng.randrange(300))}")
        else:
            texts.append(text(rng.randrange(1, 400)))
    leaked.add((len(texts), 2))
    texts.append(text(30000) + " " + items[2])
    bench = spark.createDataFrame([*enumerate(items), (98, None), (99, "")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs_of(spark, texts), bench).collect()}
    assert got == leaked
    assert decontaminate.leaks(docs_of(spark, texts), bench.where("false")).count() == 0
    assert decontaminate.leaks(docs_of(spark, []), bench).count() == 0


def test_secrets(spark):
    rng = random.Random(15)
    hexes = lambda n: "".join(rng.choice("0123456789abcdef") for _ in range(n))
    texts, planted = [None, "", "plain words only", "w " * 40000], {}
    for i in range(240):
        kind = i % 6
        value = ["AKIA" + "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567") for _ in range(15)) + "7", hexes(18) + "1", hexes(39) + "2", f"user{i}.name@mail7.example.com", f"10.20.30.{100 + i % 90}:80", hexes(40)][kind]
        written = [value, f"password={value}", f'token = "{value}"', value, value, f"commit {value}"][kind]
        if kind < 3:
            planted[len(texts)] = value
        texts.append(f"some text before {written} and after")
    df = docs_of(spark, texts, ("src/app", "docs/test"))
    found = secrets.secrets(df)
    got = {r["doc_id"]: r["value"] for r in found.collect()}
    assert got == planted
    clean = {r["doc_id"]: r["text"] for r in secrets.redacted(df, found).collect()}
    assert len(clean) == len(texts) and all((planted[i] not in clean[i] and secrets.REDACTED in clean[i]) if i in planted else clean[i] == texts[i] for i in clean)
    assert secrets.secrets(docs_of(spark, [])).count() == 0


def test_secret_candidates(spark):
    """Candidates against a plain search; short values and plain words are candidates where a credential's name precedes them."""
    texts = [None, "", "password=Tr0ub4dor", "the passphrase token is horsebattery now", "secret: short1", "pwd=abc", "policy words only", 'api_key="abc_DEF"', "see https://example.com/a1b2c3d4 or mail"]
    got = collections.defaultdict(list)
    for r in secrets.candidates(docs_of(spark, texts)).collect():
        got[r["id"]].append((r["value"], r["previous"], r["next"], r["key"]))
    assert sorted(got) == [2, 3, 4, 7, 8]
    assert got[2] == [("Tr0ub4dor", " ", "", "password")] and got[4] == [("short1", " secret:", "", "")] and got[7] == [("abc_DEF", " ", "", "api_key")]
    assert [v for v, *_ in got[3]] == ["horsebattery"] and got[8][0][:3] == ("https://example.com/a1b2c3d4", " see", "or")
    rng = random.Random(18)
    words = [rng.choice(["a", "bb", "password", "token=", "x1" * rng.randrange(1, 9), "plainword", "A" * 17, "k=v2v2v2v2v2v2"]) for _ in range(3000)]
    keyword = lambda x: any(k in x.lower() for k in secrets.KEYWORDS)
    want = []
    for i, x in enumerate(words):
        named = len(x) >= 6 and (keyword(" ".join(words[max(i - 2, 0) : i])) or ("=" in x and keyword(x.split("=")[0]) and len(x.split("=")[1]) >= 6))
        v = x.partition("=")[2] or x if x.startswith("k=") else x
        if (len(x) >= 12 and (any(map(str.isdigit, x)) or x.startswith("A" * 16))) or named:
            if len(v) >= 12 or (len(v) >= 6 and named):
                want.append((i, v))
    found = secrets.candidates(docs_of(spark, [" ".join(words)])).select("place", "value").collect()
    assert sorted(map(tuple, found)) == want


def test_secrets_from_reviewed_findings(spark):
    """Findings passed in decide: here letters-only values behind a name are secrets, and long digit strings are not."""
    rng = random.Random(19)
    letters = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    texts = [f"use passphrase password={letters(14)} here" if i % 2 else f"order number {rng.randrange(10**14, 10**15)} came" for i in range(200)]
    df = docs_of(spark, texts)
    reviewed = secrets.candidates(df).where("id < 100").withColumn("label", F.col("value").rlike("[a-z]").cast("double"))
    got = {r["doc_id"]: r["value"] for r in secrets.secrets(df, reviewed).collect()}
    assert got == {i: t.split("=")[1].split()[0] for i, t in enumerate(texts) if i % 2}


def test_secrets_learn_from_all_findings(spark, monkeypatch):
    """More findings than a label weighs: the forest knows the form of one secret in twenty too."""
    monkeypatch.setattr(secrets, "MAX_LABELLED", 8)
    rng = random.Random(20)
    digits = lambda n: "".join(rng.choices("123456789", k=n))
    values = [digits(33) if i % 40 == 7 else "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=14)) if i % 2 else digits(14) for i in range(400)]
    df = docs_of(spark, [f"use it: password={v} here" for v in values])
    reviewed = secrets.candidates(df).withColumn("label", (F.col("id") % 2).cast("double"))
    got = {r["doc_id"]: r["value"] for r in secrets.secrets(df, reviewed).collect()}
    assert got == {i: v for i, v in enumerate(values) if i % 2}


def test_secrets_odd_rows(spark):
    """Repeated rows and null ids give their findings again; clashing columns are left alone."""
    key = "AKIA" + "ABCDEFGHIJKLMNO7"
    rows = [(None, f"a {key} b", "v"), (3, f"a {key} b", "v"), (3, f"a {key} b", "v"), (4, "plain", "v"), (5, None, "v")]
    df = spark.createDataFrame(rows, "doc_id long, text string, value string").withColumns({"source": F.lit(None).cast("string"), "score": F.lit("s"), "words": F.lit(1)})
    extra = docs_of(spark, [f"text with {i} 10.20.30.{100 + i}:8080 and password={i}a{'f0' * 12}" for i in range(60)]).select("doc_id", "text", F.lit("v").alias("value"), "source", "score", F.lit(1).alias("words"))
    found = secrets.secrets(df.union(extra.withColumn("doc_id", F.col("doc_id") + 100)))
    assert sorted((str(r["doc_id"]) for r in found.collect() if r["value"] == key)) == ["3", "3", "None"]
    clean = secrets.redacted(df, found).collect()
    assert clean[0].asDict().keys() == df.first().asDict().keys() and sorted(str(r["doc_id"]) for r in clean) == ["3", "3", "4", "5", "None"]
    assert all(r["value"] == "v" for r in clean) and [r["text"] for r in clean if r["doc_id"] == 3] == [f"a {secrets.REDACTED} b"] * 2


def test_pipeline(spark, sf):
    """run() against its stages by brute force over what each stage receives."""
    import corpus_pipeline as cp

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [r.asDict() for r in docs.collect()]
    stages = dict(cp.STAGES)
    assert list(stages) == ["language_id", "simhash_near_dedup", "benchmark_decontamination", "secret_scan", "source_mix"]
    first = common.stored(stages["language_id"](spark, docs, sf))
    assert first.columns == docs.columns and first.count() >= 0.99 * sum(any(map(str.isalpha, r["text"] or "")) for r in kept)
    second = common.stored(stages["simhash_near_dedup"](spark, first, sf))
    fps = {r["doc_id"]: simhash.fingerprint(r["text"]) for r in first.collect()}
    want = roots(list(fps), [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 2])
    assert sorted(r["doc_id"] for r in second.collect()) == sorted(set(want.values()))
    third = common.stored(stages["benchmark_decontamination"](spark, second, sf))
    items = [decontaminate.words(r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    holds = lambda t, w: f" {' '.join(w)} " in f" {' '.join(decontaminate.words(t))} "
    clean = {r["doc_id"] for r in second.collect() if not any(holds(r["text"], w) for w in items)}
    assert {r["doc_id"] for r in third.collect()} == clean
    fourth = common.stored(stages["secret_scan"](spark, third, sf))
    assert fourth.columns == docs.columns and fourth.count() == third.count()
    assert not [r for r in fourth.collect() if "AKIA" in r["text"] and "password=" in r["text"]]
    sizes = {r["doc_id"]: len(r["text"].split()) for r in fourth.collect()}
    out = cp.run(spark, sf).collect()
    assert {r["doc_id"] for r in out} == set(sizes) and all(r["taken"] <= 3 * r["size"] for r in out)


def test_pipeline_null_and_repeated_ids(spark, tmp_path):
    """Rows without an id and rows that repeat one are documents of their own in every stage."""
    import corpus_pipeline as cp

    rng = random.Random(17)
    text = lambda n=60: " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    a, b, c, d, e, item = (text() for _ in range(6))
    key = "AKIA" + "ABCDEFGHIJKLMNO7"
    rows = [(None, a), (None, b), (7, c), (7, d), (3, d), (None, c), (9, e), (9, e), (None, "see " + item), (4, "see " + item + " too"), (None, f"x {key} y"), (4, text()), (4, f"z {key} {text()}")]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages = dict(cp.STAGES)
    pairs = lambda df: sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=str)
    odd = docs.where(~F.col("text").startswith("see"))
    want = [r for i, r in enumerate(rows) if i not in (3, 5, 7, 8, 9)]
    assert pairs(stages["simhash_near_dedup"](spark, odd, str(tmp_path))) == sorted(want, key=str)
    clean = [r for i, r in enumerate(rows) if i not in (8, 9)]
    assert pairs(stages["benchmark_decontamination"](spark, docs, str(tmp_path))) == sorted(clean, key=str)
    redacted = [(i, t.replace(key, secrets.REDACTED)) for i, t in rows]
    assert pairs(stages["secret_scan"](spark, docs, str(tmp_path))) == sorted(redacted, key=str)
