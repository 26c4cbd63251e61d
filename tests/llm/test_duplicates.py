"""Exact, near and passage duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import oracle
from tests.llm import data
from voxelmill.llm import components, exact, fuse, lines, minhash, passages, queries, suffix
from voxelmill.llm.text import mix


@settings(deadline=None, max_examples=30)
@given(st.lists(st.integers(-(2**63), 2**63 - 1), max_size=300), st.integers(0, 2**32))
def test_filters_have_no_false_negatives(keys, seed):
    f = fuse.build(np.array(keys, np.int64))
    if keys:
        assert fuse.contains(f, np.array(keys, np.int64)).all()
    others = np.random.default_rng(seed).integers(-(2**63), 2**63 - 1, 2000)
    assert fuse.contains(f, others).mean() < 0.01


def test_large_filters():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 100_000)
    f = fuse.build(keys)
    assert fuse.contains(f, keys).all() and len(f) < 2 * 1.3 * 100_000
    assert fuse.contains(f, np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 200_000)).mean() < 1e-3


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_same_rows_as_sql(spark, sf_dir, name):
    oracle.same(queries.queries()[name](spark, sf_dir), oracle.connect(sf_dir), queries.oracle_sql()[name])


def ascii_lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_exact_groups_of_awkward_rows(spark):
    docs, rows = data.awkward(spark)
    docs = data.clashing(docs)
    got = exact.deduplicate(*exact.halves(docs)).collect()
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[ascii_lower(t)].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        ties = sum(i == keep for i in ids)
        want.update((i, keep, len(ids)) for i in ids)
        kept = [r for r in got if r["kept"] and r["text_sha256"] == hashlib.sha256(t.encode()).hexdigest()]
        assert len(kept) == 1 <= ties and kept[0]["doc_id"] == keep
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"]) for r in got) == want
    assert exact.deduplicate(*exact.halves(data.empty(spark))).count() == 0


def test_batch_against_snapshot_screens_by_filter(spark):
    old = data.frame(spark, [data.prose(k, 20) for k in range(400)])
    snapshot = exact.Snapshot.of(exact.digests(old))
    new = data.frame(spark, [data.prose(k, 20) for k in range(300, 1300)])
    batch = exact.groups(exact.digests(new))
    screened = snapshot.screen(batch).count()
    assert 100 <= screened <= 105


def test_boilerplate_of_awkward_rows(spark):
    docs, rows = data.awkward(spark)
    out = lines.remove_boilerplate(data.clashing(docs), min_sites=2)
    assert out.count() == len(rows)
    got = {(r["doc_id"], r["text"]) for r in out.where("doc_id in (3, 4)").collect()}
    assert got == {(3, ""), (4, "")}
    assert lines.remove_boilerplate(data.empty(spark)).count() == 0
    assert set(data.CLASHING) <= set(out.columns)


def test_lines_of_repeated_ids(spark):
    rows = [(1, "a\nb", "s1"), (1, "a\nc", "s2"), (1, "a\nc", "s2"), (2, "b", "s2"), (None, "a", "s3"), (None, "d\nb", None)]
    docs = data.clashing(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3))
    out = lines.remove_boilerplate(docs, min_sites=3)
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter([(1, ""), (1, "c"), (1, "c"), (2, ""), (None, ""), (None, "d")])


def test_lines_of_very_many_rows_without_ids_and_of_a_text_of_very_many_lines(spark):
    """Neither is gathered, or searched line by line: 100,000 of each within seconds."""
    long_ = "\n".join(f"line {k}" if k % 3 else "common" for k in range(100_000))
    rows = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("common\nown "), F.col("id") % 5_000, F.lit("\nseldom")).alias("text"), F.concat(F.lit("s"), F.col("id") % 7).alias("source"))
    rows = rows.withColumn("text", F.when(F.col("source") != "s1", F.regexp_replace("text", "\nseldom", "")).otherwise(F.col("text")))
    docs = rows.unionByName(spark.createDataFrame([(k, long_, f"s{k}") for k in range(6)], rows.schema))
    out = lines.remove_boilerplate(docs, min_sites=6).groupBy(F.isnull("doc_id").alias("none"), "n_lines", "n_removed").count()
    got = {(r["none"], r["n_lines"], r["n_removed"]): r["count"] for r in out.collect()}
    # "own" lines stand on all seven sites, line k of the long texts on six
    few = rows.where("source = 's1'").count()
    assert got == {(True, 3, 2): few, (True, 2, 2): 100_000 - few, (False, 100_000, 100_000): 6}


def test_spread_near_the_threshold_is_exact(spark):
    texts, sites = [], []
    for n in range(1, 60):
        for s in range(n):
            texts += [f"line on {n} sites\nown {n} {s}"] * (1 + n % 2)
            sites += [f"site{s}"] * (1 + n % 2)
    out = lines.remove_boilerplate(data.frame(spark, texts, sites), min_sites=40)
    gone = {t.split("\n")[0] for t, r in zip(texts, sorted(out.collect(), key=lambda r: r["doc_id"])) if r["n_removed"]}
    assert gone == {f"line on {n} sites" for n in range(40, 60)}


# ---------------------------------------------------------------- near duplicates


def test_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(5)
    x = mix(np.arange(300, dtype=np.uint64))
    for low in (1, 4):
        a = r.integers(1, low + 1, 300).astype(float)
        b = a.copy()
        b[:90] = r.integers(1, 6, 90)
        want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        s = minhash.signatures(np.concatenate([x, x]), np.repeat([0, 1], 300), np.concatenate([a, b]), 2, 2048)
        assert abs((s[0] == s[1]).mean() - want) < 0.04
    part = minhash.signatures(np.concatenate([x, x[:200]]), np.repeat([0, 1], [300, 200]), np.ones(500), 2, 2048)
    assert abs((part[0] == part[1]).mean() - 2 / 3) < 0.04


def classes_by_brute_force(texts):
    sets = []
    for t in texts:
        w = re.findall(r"\w+", (t or "").lower())
        sets.append(Counter(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    by = defaultdict(set)
    for k, s in enumerate(sets):
        for x in s:
            by[x].add(k)
    for k, s in enumerate(sets):
        for o in set().union(*(by[x] for x in s)) if s else ():
            if o > k and (s & sets[o]).total() >= 0.8 * (s | sets[o]).total():
                parent[max(root(k), root(o))] = min(root(k), root(o))
    return [root(k) for k in range(len(texts))]


def edited(text, r, share):
    w = text.split()
    return " ".join("edit" + str(r.random())[2:8] if r.random() < share else x for x in w)


def test_near_classes_like_brute_force(spark):
    r = random.Random(3)
    texts = [data.prose(100 + k, 60) for k in range(40)] + [None, "", "one two", "one two", "ONE, two!"]
    hot = data.prose(7, 150)
    texts += [edited(hot, r, r.choice((0, 0.01, 0.02, 0.03, 0.05))) for _ in range(260)]
    for k in range(30):
        texts += [edited(data.prose(500 + k, 80), r, 0.02) for _ in range(r.randint(1, 5))]
    got = {x["doc_id"]: x for x in minhash.classes(data.clashing(data.frame(spark, texts))).collect()}
    want = classes_by_brute_force(texts)
    assert [got[k]["class_id"] for k in range(len(texts))] == want
    assert sum(x["kept"] for x in got.values()) == len(set(want))
    assert all(x["kept"] == (x["class_id"] == k) for k, x in got.items())


def test_weights_are_how_often_a_text_has_a_shingle(spark):
    a, b = data.prose(61, 40), data.prose(62, 40)
    texts = [" ".join([a] * 9), " ".join([a] * 10), a, " ".join([a] * 3 + [b] * 6), " ".join([a, b] * 4), " ".join([b, a] * 4)]
    got = {x["doc_id"]: x["class_id"] for x in minhash.classes(data.frame(spark, texts)).collect()}
    assert [got[k] for k in range(len(texts))] == classes_by_brute_force(texts) == [0, 0, 2, 3, 4, 4]


def test_large_tables_of_links_are_contracted(spark, monkeypatch):
    monkeypatch.setattr(components, "AT_ONCE", 20)
    r = random.Random(4)
    edges = [(k, k + 1) for k in range(400)] + [(1000, 1000 + k) for k in range(1, 200)] + [(r.randint(2000, 2300), r.randint(2000, 2300)) for _ in range(140)] + [(5000, 5000), (6000, 6001), (6001, 6000)]
    got = {x["node"]: x["label"] for x in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert got == {x: root(x) for x in parent if x != 5000}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_recall_of_planted_pairs(spark):
    r = random.Random(12)
    texts, near = [], 0
    for k in range(400):
        t = data.prose(7000 + k, r.randint(30, 300))
        texts += [t, edited(t, r, r.uniform(0, 0.03))]
    got = {x["doc_id"]: x["class_id"] for x in minhash.classes(data.frame(spark, texts)).collect()}
    want = classes_by_brute_force(texts)
    near = [k for k in range(len(texts)) if want[k] != k]
    assert len(near) > 200 and sum(got[k] == want[k] for k in near) >= 0.99 * len(near)
    assert all(got[k] == k for k in range(len(texts)) if want[k] == k)


def test_hot_ids_and_ties_of_exact_copies(spark):
    rows = [(5, f"text {k % 700}".upper() if k % 3 else f"text {k % 700}") for k in range(2100)] + [(k, "Text 1") for k in range(3)]
    got = exact.deduplicate(*exact.halves(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))).collect()
    assert len(got) == len(rows) and sum(r["kept"] for r in got) == 700
    assert {r["keep_id"] for r in got} == {5} and Counter(r["group_size"] for r in got) == {3: 699 * 3, 6: 6}


def test_a_batch_larger_than_its_snapshot(spark, monkeypatch):
    monkeypatch.setattr(exact, "SHARD_KEYS", 5)
    old, new = data.frame(spark, [data.prose(k, 8) for k in range(300)]), data.frame(spark, [data.prose(k, 8) for k in range(250, 2250)])
    snapshot = exact.Snapshot.of(exact.digests(old))
    batch = exact.groups(exact.digests(new))
    assert 50 <= snapshot.screen(batch).count() <= 55
    assert sum(r["kept"] for r in exact.deduplicate(old, new).collect()) == 2250


def test_near_classes_of_awkward_rows(spark):
    docs, rows = data.awkward(spark)
    got = minhash.classes(docs).collect()
    assert len(got) == len(rows)
    assert {r["class_id"] for r in got if r["doc_id"] in (5, 6)} == {5} and {r["class_id"] for r in got if r["doc_id"] in (3, 4)} == {3}
    assert minhash.classes(data.empty(spark)).count() == 0


def test_components_of_chains_and_stars(spark):
    r = random.Random(9)
    edges = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(200, 260)] + [(300, 301), (301, 302), (302, 300)]
    ids = list({x for e in edges for x in e})
    to = dict(zip(ids, r.sample(range(10_000), len(ids))))
    got = {x["node"]: x["label"] for x in components.components(spark.createDataFrame([(to[a], to[b]) for a, b in edges], "a long, b long")).collect()}
    for group in (range(100, 161), [5, *range(200, 260)], (300, 301, 302)):
        assert {got[to[k]] for k in group} == {min(to[k] for k in group)}


# ---------------------------------------------------------------- passages


@settings(deadline=None, max_examples=60)
@given(st.lists(st.binary(min_size=16, max_size=50), min_size=1, max_size=6), st.integers(0, 3))
def test_suffix_arrays_find_repeats(texts, few):
    if few:
        texts = [bytes(b % few for b in x) for x in texts]
    starts = [len(x) - 15 for x in texts]
    seen = Counter(x[i : i + 16] for x, n in zip(texts, starts) for i in range(n))
    for x, mark in zip(texts, suffix.repeated(texts, starts, 16)):
        assert mark.tolist() == [seen[x[i : i + 16]] > 1 for i in range(len(mark))]


def test_suffixes_are_in_order_and_prefixes_are_right():
    texts = [b"banana bandana banana band", b"\0\0\0\0\0\0\0\0\0\0\0\0\0\0\0\0\0\0"]
    sa, base = suffix.two_stage(texts, [11, 3], 16)
    at = lambda p: (lambda k: texts[k][p - base[k] :][:16])(int(np.searchsorted(base, p, "right")) - 1)
    keys = [at(int(p)) for p in sa]
    assert keys == sorted(keys) and len(sa) == 14
    for a, b, n in zip(keys, keys[1:], suffix.common_prefixes(texts, sa, 16)):
        common = next((i for i in range(16) if a[i] != b[i]), 16)
        assert n == common // 8 * 8


def without_repeats(texts, depth):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[k : k + depth] for b in raw for k in range(len(b) - depth + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - depth + 1):
            if seen[b[k : k + depth]] > 1:
                gone[k : k + depth] = b"\1" * depth
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


@pytest.mark.parametrize("most", [400, 1000, 4096])
def test_anchors_of_pieces_are_those_of_the_whole(most):
    for text in (data.prose(1, 700), "x" * 3000, "ab" * 900 + data.prose(2, 300) + "\0" * 800, "é" * 1500):
        buf = np.frombuffer(text.encode(), np.uint8)
        offsets = np.array([0, len(buf)])
        want = passages.anchors(buf, offsets)
        got = [np.concatenate(x) for x in zip(*passages.in_pieces(buf, offsets, 200, most))]
        assert len(want[0]) > 5
        for a, b in zip(got, want):
            assert a.tolist() == b.tolist()


@pytest.mark.parametrize("crowd, hot", [(2048, 1000), (3, 1), (2048, 1e9)])
def test_passages_like_brute_force(spark, monkeypatch, crowd, hot):
    monkeypatch.setattr(passages, "CROWD", crowd)
    monkeypatch.setattr(passages, "HOT", hot)
    r = random.Random(2)
    shared = [data.prose(900 + k, n) for k, n in enumerate((40, 60, 200))]
    texts = [None, "", "x" * 700, "é" * 300, data.prose(1, 300) + data.prose(1, 300)]
    for k in range(60):
        t = data.prose(2000 + k, r.randint(5, 120))
        for _ in range(r.randint(0, 2)):
            p = r.choice(shared)
            a = r.randint(0, 30)
            t += "é" * r.randint(0, 2) + p[a : a + r.randint(150, 900)] + data.prose(3000 + k, 9)
        texts.append(t)
    texts += [texts[5], texts[6], edited(texts[7] + shared[2], r, 0.02), shared[2] + "\0"]
    got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], bytes(x["kept"])) for x in passages.remove_repeats(data.clashing(data.frame(spark, texts))).collect()}
    want = without_repeats(texts, 200)
    assert [got[k] for k in range(len(texts))] == want
    assert sum(x[1] for x in want) > 10_000


def test_passages_of_awkward_rows(spark):
    docs, rows = data.awkward(spark)
    got = passages.remove_repeats(docs).collect()
    want = without_repeats([t for _, t, _ in rows], 200)
    assert Counter((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in got) == Counter((i, *w[:3]) for (i, *_), w in zip(rows, want))
    assert passages.remove_repeats(data.empty(spark)).count() == 0


def test_pages_of_one_template_meet_only_where_similar(spark):
    """Sets of one template (similarity 0.7) share 70 shingles, but only what is similar may meet by them."""
    r = np.random.default_rng(5)
    sets, label = [], []
    for template in range(3):
        common = mix(np.arange(70, dtype=np.uint64) + np.uint64(1000 * template))
        for k in range(400):
            sets.append(np.concatenate([common, mix(r.integers(0, 1 << 60, 15).astype(np.uint64))]))
            label.append(-1 - len(label))
    for k in range(60):  # similar to another one, sizes that differ; some have its label
        of = sets[k * 7]
        sets.append(np.concatenate([of[: len(of) - k % 9], mix(r.integers(0, 1 << 60, k % 5).astype(np.uint64))]))
        label.append(label[k * 7] if k % 4 == 0 else -1 - len(label))
    rest = r.random(len(sets)) < 0.4
    nodes = spark.createDataFrame([(k, label[k], bool(rest[k])) for k in range(len(sets))], "_row long, label long, rest boolean")
    table = spark.createDataFrame([(k, bytearray(minhash.packed(x).tobytes())) for k, x in enumerate(sets)], "_row long, set binary")
    met = {(x["a"], x["b"]) for x in minhash.searched(nodes, table, 0.8).collect()}
    plain, want = [set(x.tolist()) for x in sets], set()
    for a in range(len(sets)):
        for b in range(a):
            common = len(plain[a] & plain[b]) if label[a] != label[b] and (rest[a] or rest[b]) else 0
            if common >= 0.8 * (len(plain[a]) + len(plain[b]) - common):
                want.add((b, a))
    assert len(want) > 20 and want <= met and len(met) < 10 * len(sets)
    assert all(a < b and label[a] != label[b] and (rest[a] or rest[b]) for a, b in met)
