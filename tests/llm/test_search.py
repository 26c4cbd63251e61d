"""Near vectors, ranked search and phrases against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests import oracle
from tests.llm import data
from voxelmill.llm import phrases, ranking, vectors
from voxelmill.llm import queries as q

# ---------------------------------------------------------------- vectors


def _usable(r):
    v = r["embedding"]
    return r["label"] is not None and bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def _links(rows, cosine=0.98):
    """Per row: number of links and the least id reached."""
    n, near = len(rows), defaultdict(set)
    for i in range(n):
        for j in range(i):
            a, b = rows[i], rows[j]
            if _usable(a) and _usable(b) and a["label"] == b["label"] and len(a["embedding"]) == len(b["embedding"]):
                x, y = np.array(a["embedding"], float), np.array(b["embedding"], float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                    near[i].add(j)
                    near[j].add(i)
    out = []
    for i in range(n):
        reach, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()] - reach:
                reach.add(j)
                todo.append(j)
        ids = [rows[j]["vec_id"] for j in reach if rows[j]["vec_id"] is not None]
        least = min(ids) if ids else None
        out.append((rows[i]["vec_id"], len(near[i]), least, rows[i]["vec_id"] is not None and rows[i]["vec_id"] == least))
    return sorted(out, key=repr)


def _vectors(seed, d=24):
    """Loose vectors, chains of links, one crowded group of a third of all, copies, and every unusable kind."""
    r = np.random.default_rng(seed)
    rows = [(r.normal(size=d), k % 3) for k in range(60)]
    centre = r.normal(size=d)
    rows += [(centre + r.normal(size=d) * np.linalg.norm(centre) * s / np.sqrt(d), 1) for s in r.uniform(0, 0.25, 60)]
    at = r.normal(size=d)
    for _ in range(12):
        at = at + r.normal(size=d) * np.linalg.norm(at) * 0.16 / np.sqrt(d)
        rows.append((at, 2))
    rows = [(v.astype(np.float32).tolist(), label) for v, label in rows]
    rows += [rows[3], rows[3], rows[70], (rows[70][0], 0), (rows[5][0], None), ([0.0] * d, 1), (None, 1), ([], 1), ([None] + [1.0] * (d - 1), 1), ([float("nan")] + [1.0] * (d - 1), 1)]
    rows += [([float("inf")] + [1.0] * (d - 1), 1), ([1.0, 0.5], 1), ([1.0, 0.5001], 1), ([2.0] * 70, 0), ([1.0] * 70, 0)]
    ids = [None if k % 29 == 7 else k // 2 if k % 31 == 4 else k for k in range(len(rows))]
    return [(i, v, label) for i, (v, label) in zip(ids, rows, strict=True)]


@pytest.mark.parametrize(("leaf", "tile"), [(2048, 4096), (8, 10), (16, 1000), (1000, 7)])
def test_links_equal_brute_force(spark, leaf, tile):
    df = spark.createDataFrame(_vectors(leaf), "vec_id long, embedding array<float>, label int")
    want = _links(df.collect())
    assert sum(x[1] for x in want) > 500
    clashing = df.withColumns({c: F.lit(1) for c in ("id", "vec", "node", "d1", "n", "links", "component")})
    got = vectors.near_vectors(clashing.repartition(5), leaf=leaf, tile=tile).collect()
    assert sorted(map(tuple, got), key=repr) == want


def test_pairs_at_the_border(spark):
    r, rows = np.random.default_rng(5), []
    for k in range(200):
        x, y = np.linalg.qr(r.normal(size=(64, 2)))[0].T
        c = 0.98 + (k - 100) * 1e-5 + 5e-6
        rows += [(2 * k, x.tolist(), k % 2), (2 * k + 1, (c * x + np.sqrt(1 - c * c) * y).tolist(), k % 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {x["vec_id"]: x["n_links"] for x in vectors.near_vectors(df, leaf=16, tile=64).collect()}
    assert got == {i: int(i // 2 >= 100) for i in got} and len(got) == 400


def test_many_equal_vectors_and_none(spark):
    df = spark.range(20_000).select(F.col("id").alias("vec_id"), F.array(*(F.lit(float(k)) for k in range(1, 9))).alias("embedding"), F.lit(1).alias("label"))
    assert vectors.near_vectors(df).groupBy("n_links", "component_id").count().collect() == [(19_999, 0, 20_000)]
    assert vectors.near_vectors(df.limit(0)).collect() == []
    assert [tuple(r) for r in vectors.near_vectors(df.limit(1)).collect()] == [(0, 0, 0, True)]


def test_rotation_keeps_lengths_and_a_pair_is_near_in_some_block():
    r = np.random.default_rng(0)
    for d in (3, 64, 100):
        x = vectors.units(r.normal(size=(50, d)))
        y = vectors.units(x + r.normal(size=(50, d)) * 0.12 / np.sqrt(d))
        a, b = vectors.rotated(x), vectors.rotated(y)
        assert np.allclose(np.linalg.norm(a, axis=1), vectors.GRID, rtol=1e-5)
        blocks = ((a - b) ** 2).reshape(50, -1, vectors.WIDTH).sum(axis=2) <= vectors.radius(0.98, d) ** 2
        assert blocks.any(axis=1)[(x * y).sum(axis=1) >= 0.98].all()


def test_probes_reach_every_leaf_within_their_radius():
    r = np.random.default_rng(1)
    x, radius = np.rint(r.normal(size=(300, 4)) * 100), 40.0
    tree = vectors.planes(x, 5)
    row, leaf, home = vectors.leaves(x, tree, 5, radius)
    at = dict(zip(row[home].tolist(), leaf[home].tolist(), strict=True))
    assert len(at) == 300
    seen = set(zip(row.tolist(), leaf.tolist(), strict=True))
    for i in range(300):
        for j in range(300):
            if at[i] <= at[j] and np.linalg.norm(x[i] - x[j]) <= radius:
                assert (i, at[j]) in seen


# ---------------------------------------------------------------- search


def _terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _ranked(docs, items, k):
    own = [Counter(_terms(t)) for _, t in docs]
    full = [c for c in own if c]
    n_docs, total = len(full), sum(sum(c.values()) for c in full)
    df = Counter(t for c in full for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for t, x in df.items()}
    out = []
    for item, text in items:
        scores = []
        for (doc, _), c in zip(docs, own, strict=True):
            m = 75 + (25 * sum(c.values()) * n_docs) // max(1, total)
            score = sum(w[t] * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t in _terms(text) if c[t])
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def _texts(seed, n=150):
    r = random.Random(seed)
    common = data.WORDS[:12]
    word = lambda: r.choice(common) if r.random() < 0.5 else r.choice(data.WORDS).title() + r.choice(["", "1", "é"])
    return [" ".join(word() + r.choice(["", ".", "_x", "-"]) for _ in range(r.choice([3, 20, 60, 300]))) for _ in range(n)]


@pytest.mark.parametrize("finish", [1000, 0])
def test_ranks_equal_brute_force(spark, monkeypatch, finish):
    monkeypatch.setattr(ranking, "FINISH", finish)
    texts = _texts(1)
    docs = list(enumerate(texts)) + [(None, texts[0]), (200, None), (201, ""), (202, "?!"), (203, texts[5]), (203, texts[5]), (204, texts[5]), (205, "word " * 50_000), (206, "\U0001f600 naïve NAÏVE")]
    docs += [(300 + k, "one group of copies that holds a third of all rows") for k in range(80)]
    items = [(k, " ".join(t.split()[:25])) for k, t in enumerate(texts[:30])] + [(90, None), (91, ""), (92, "nothing matches zzz"), (5, texts[9]), (5, texts[9]), (None, "word word naïve"), (93, "copies of one group")]
    a = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("x") for c in ("row", "id", "term", "w", "tier", "score", "item")}).repartition(6)
    b = spark.createDataFrame(items, "item_id long, text string").withColumn("q", F.lit(1)).repartition(3)
    for k in (20, 3):
        assert sorted(map(tuple, ranking.ranked(a, b, k).collect()), key=repr) == _ranked(docs, items, k)


def test_items_without_proof_fall_through(spark, monkeypatch):
    """Each tier answers what it can prove; what it returns is the same wherever an item is answered."""
    docs = spark.createDataFrame(list(enumerate(_texts(2, 400))), "doc_id long, text string")
    asked = ranking.questions(docs.where("doc_id % 20 = 0").select(F.col("doc_id").alias("item_id"), "text"))
    found, whole = ranking.index(docs, asked), []
    look = ranking._whole
    monkeypatch.setattr(ranking, "_whole", lambda pairs, *a: whole.append(pairs.select("item").distinct().count()) or look(pairs, *a))
    monkeypatch.setattr(ranking, "FINISH", 30)
    got = sorted(map(tuple, ranking.search(found, asked, 5).collect()))
    # looked up ahead, and then finished, in the first tier: some items, not all
    assert len(whole) == 4 and 0 < whole[1] < whole[0] and whole[2] >= whole[0] - whole[1]
    monkeypatch.setattr(ranking, "FINISH", -1)
    assert got == sorted(map(tuple, ranking.search(found, asked, 5).collect()))


def test_search_of_empty_tables(spark):
    docs, none = data.frame(spark, ["some words", "more words"]), data.empty(spark)
    items = spark.createDataFrame([(1, "words")], "item_id long, text string")
    assert ranking.ranked(none, items).collect() == []
    assert ranking.ranked(docs, items.limit(0)).collect() == []
    assert ranking.ranked(docs, items.withColumn("text", F.lit("other"))).collect() == []
    assert ranking.ranked(data.frame(spark, ["", None]), items).dtypes == ranking.ranked(docs, items).dtypes


# ---------------------------------------------------------------- phrases


def _phrases(docs, least, first):
    count, total = defaultdict(Counter), Counter()
    for text, lang in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, 6):
                for i in range(len(w) - k + 1):
                    count[lang][tuple(w[i : i + k])] += 1
    out = []
    for lang, c in count.items():
        f, kept = {p: n for p, n in c.items() if n >= least}, []
        inside = Counter()
        for p, n in f.items():
            for m in range(2, len(p)):
                for s in range(len(p) - m + 1):
                    inside[p[s : s + m]] = max(n, inside[p[s : s + m]])
        for p, a in f.items():
            if len(p) > 1 and not inside[p] * 100 >= 100 * a:
                score, _, l, r = min((1000 * a * total[lang] // (c[p[:k]] * c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                kept.append((score, a, " ".join(p), l, r))
        kept.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [(lang, rank, p, a, l, r, total[lang], s) for rank, (s, a, p, l, r) in enumerate(kept[:first], 1)]
    return sorted(out)


def _prose(seed, n=120):
    r = random.Random(seed)
    fixed = ["the red house on the hill", "out of order", "a b c d e f g", "Élan vital", "to be or not to be or not to be"]
    parts = lambda: r.choice(fixed) if r.random() < 0.4 else " ".join(r.choice(data.WORDS[:30]) for _ in range(r.randint(1, 6)))
    return [(r.choice([" ", ". ", "\t", ", ", "\x0b", "\n"]).join(parts() for _ in range(r.randint(1, 40))).title() if r.random() < 0.2 else r.choice([" ", "; "]).join(parts() for _ in range(20)), r.choice(["en", "de", None, "und", ""])) for _ in range(n)]


@pytest.mark.parametrize("numbered", [phrases.NUMBERED, 0])
@pytest.mark.parametrize("least,first", [(5, 2000), (3, 25)])
def test_phrases_equal_brute_force(spark, monkeypatch, numbered, least, first):
    monkeypatch.setattr(phrases, "NUMBERED", numbered)
    docs = _prose(least) + [(None, "en"), ("", None), (" \t ..", "de"), ("long" * 30_000, "en"), ("of the house " * 5_000, "en"), ("\U0001f600 \U0001f600 " * 9, "de")] + [("same words in a row", "fr")] * 90
    df = spark.createDataFrame(docs, "text string, lang string").withColumns({c: F.lit("x") for c in ("h", "word", "n", "f", "key", "score", "rank")})
    want = _phrases([(t, lang if lang is not None else "und") for t, lang in docs], least, first) if "" not in {x for _, x in docs} else _blank(docs, least, first)
    assert sorted(map(tuple, phrases.phrases(df.repartition(7), least, first).collect())) == want


def _blank(docs, least, first):
    """An empty language is a language of its own."""
    out = _phrases([(t, "und" if lang is None else lang or "\0") for t, lang in docs], least, first)
    return sorted((("" if x[0] == "\0" else x[0]), *x[1:]) for x in out)


def test_phrases_of_no_texts(spark):
    assert phrases.phrases(data.empty(spark)).collect() == []
    assert phrases.phrases(data.frame(spark, ["no phrase here", None]).withColumn("lang", F.lit(None).cast("string"))).collect() == []


def test_scores_beyond_64_bits(spark):
    word = lambda *n: b"".join(x.to_bytes(4, "big") for x in n)
    a, n, first, second = 9 * 10**11, 8 * 10**17, 3 * 10**12 + 7, 2 * 10**12 + 1
    single = spark.createDataFrame([(1, "en", "x", first, word(1)), (2, "en", "y", second, word(2))], "h long, lang string, word string, f long, key binary")
    found = spark.createDataFrame([(word(1, 2), a)], "key binary, f long")
    got = phrases._scored(found, single, spark.createDataFrame([("en", n)], "lang string, n long"), 4).first()
    assert got["score"] == 1000 * a * n // (first * second)


@pytest.mark.parametrize("name", ["op11_near_vectors", "op12_ranked_search", "op13_phrases"])
def test_same_rows_as_sql(spark, sf_dir, name):
    oracle.same(q.queries()[name](spark, sf_dir), oracle.connect(sf_dir), q.oracle_sql()[name])
