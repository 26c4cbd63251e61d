"""Toxicity, sharding, decontamination, packing and the whole pipeline."""

import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import data
from voxelmill.llm import decontam, packing, queries, sharding, toxicity
from voxelmill.llm.numbering import numbered
from voxelmill.llm.storage import materialise


# ---------------------------------------------------------------- toxicity


@pytest.fixture(scope="module")
def language(spark):
    texts = [data.prose(k, 60) + " you idiot and stupid moron, loser; is this trash really pathetic?" for k in range(200)]
    return toxicity.language_model(toxicity.trigram_counts(data.frame(spark, texts)))


def test_counts_cover_every_text(spark):
    got = toxicity.trigram_counts(data.frame(spark, ["abc", "ABCD", None, "", "ab", "é1"]))
    a = toxicity.LETTERS
    assert got[(0 * a + 1) * a + 2] == 2 and got[(1 * a + 2) * a + 3] == 1


@pytest.mark.parametrize("token,word", [("1d10t", "idiot"), ("stup1d", "stupid"), ("m0r0n", "moron"), ("l0$er", "loser"), ("p4thet1c", "pathetic"), ("idiooooot", "idiot"), ("s.t.u.p.i.d", "stupid"), ("t r a s h", "trash"), ("tr@sh", "trash")])
def test_disguised_words_are_restored(language, token, word):
    assert toxicity.restore(token, language) == word


def test_decoding_is_the_best_path(language):
    for token in ("l0s", "5tu", "1d1"):
        options = toxicity.readings(token)

        def value(path):
            text = "".join(p for p, _ in path)
            x = [27, 27, *(toxicity._number(c) for c in text), 27]
            return sum(language[a, b, c] for a, b, c in zip(x, x[1:], x[2:])) - sum(c for _, c in path)

        best = max(itertools.product(*options), key=value)
        assert toxicity.restore(token, language) == "".join(p for p, _ in best)


def test_suspects_are_found_where_they_are():
    texts = ["you 1d10t s t u p i d nooo way 2024 word!! fine a b c", "", "deadbeef0123456789deadbeef0123456789deadbeef01234567", "x"]
    from voxelmill.llm.text import flat, lowered

    buf, offsets = flat(lowered(pa.array(texts)))
    got = [(d, buf[a:b].tobytes().decode()) for d, a, b in toxicity.suspects(buf, offsets)]
    assert got == [(0, "1d10t"), (0, "nooo"), (0, "s t u p i d")]


BAD = ["idiot", "stupid", "moron", "loser", "trash"]


def _corpus(n, r):
    texts, toxic = [], []
    for k in range(n):
        bad = r.random() < 0.25
        w = data.prose(k, r.randint(20, 60)).split()
        if bad:
            for _ in range(4):
                x = r.choice(BAD)
                w.insert(r.randint(0, len(w)), r.choice([x, x.upper(), x.replace("i", "1").replace("o", "0"), "".join(c * r.choice((1, 1, 4)) for c in x)]))
        texts.append(" ".join(w))
        toxic.append(int(bad))
    return texts, toxic


def test_scores_on_the_held_out_fold(spark):
    texts, toxic = _corpus(900, random.Random(4))
    docs = data.frame(spark, texts)
    labels = spark.createDataFrame(list(enumerate(toxic)), "doc_id long, toxic int")
    out = toxicity.score(docs, toxicity.fit(docs, labels)).withColumn("held_out", toxicity.held_out())
    rows = [r for r in out.collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows) and len(rows) > 100
    assert np.mean([(r["score"] >= 0.5) == toxic[r["doc_id"]] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_labels_of_the_held_out_fold_change_nothing(spark):
    texts, toxic = _corpus(200, random.Random(5))
    docs = data.frame(spark, texts)
    held = [zlib.crc32(str(k).encode()) % 5 == 0 for k in range(len(texts))]
    scores = []
    for flip in (0, 1):
        labels = spark.createDataFrame([(k, t ^ flip if h else t) for k, (t, h) in enumerate(zip(toxic, held))], "doc_id long, toxic int")
        scores.append({r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()})
    assert scores[0] == pytest.approx(scores[1])


def test_toxicity_of_awkward_rows(spark):
    docs, rows = data.awkward(spark)
    docs = data.clashing(docs)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(3, 1), (5, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    for labels, low in ((none, True), (one, False)):
        got = toxicity.score(docs, toxicity.fit(docs, labels)).collect()
        assert len(got) == len(rows) and all((r["score"] < 0.01) == low for r in got)
    assert toxicity.score(data.empty(spark), toxicity.fit(data.empty(spark), none)).count() == 0


def test_a_labelled_id_that_repeats_counts_once(spark):
    docs = spark.range(3000).select((F.col("id") % 3).alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(0, 1), (1, 0), (1, 1), (2, 0), (None, 1)], "doc_id long, toxic int")
    some = toxicity.labelled(docs, labels, "doc_id", "text", "toxic", 2).collect()
    assert len(some) <= 2
    every = toxicity.labelled(docs.unionByName(docs), labels, "doc_id", "text", "toxic", 10).collect()
    want = [int(i in (0, 1)) for i in range(3) if zlib.crc32(str(i).encode()) % 5]
    assert sorted(r["_toxic"] for r in every) == sorted(want)
    assert sorted(map(tuple, every)) == sorted(map(tuple, toxicity.labelled(docs, labels, "doc_id", "text", "toxic", 10).collect()))


# ---------------------------------------------------------------- shards and numbers


def test_shards_against_a_plain_plan(spark, sf_dir):
    """Every row's shard by hand: slots by size, the largest first, each to the lightest shard so far."""
    rows = queries.op6_virtual_slots(spark, sf_dir).toPandas()
    assert set(rows["map_version"]) == {1} and rows["vslot"].between(0, sharding.SLOTS - 1).all()
    size = rows.groupby("vslot")["size"].sum().to_dict()
    load, where = [0] * queries.SHARDS, {}
    for slot in sorted(range(sharding.SLOTS), key=lambda k: (-size.get(k, 0), k)):
        where[slot] = min(range(queries.SHARDS), key=lambda k: (load[k], k))
        load[where[slot]] += size.get(slot, 0)
    assert all(r.shard == where[r.vslot] for r in rows.itertuples())
    for _, own in rows.groupby("shard"):
        order = own.sort_values(["vslot", "doc_id", "text_crc32", "size"])
        assert list(order["slot"]) == list(range(len(own)))
    again = queries.op6_virtual_slots(spark, sf_dir).toPandas()
    key = ["doc_id", "vslot", "shard", "slot"]
    assert rows[key].sort_values(key).reset_index(drop=True).equals(again[key].sort_values(key).reset_index(drop=True))


def test_shards_are_even_and_slots_gapless(spark, sf_dir):
    rows = queries.op6_virtual_slots(spark, sf_dir).toPandas()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert len(rows) == len(texts) and set(rows["law"]) == {"bytes"} and rows["grown_shard"].isna().all()
    for r in rows.itertuples():
        raw = texts[r.doc_id].encode()
        assert r.size == len(raw) + 1 and r.text_crc32 == zlib.crc32(raw)
    for _, own in rows.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))
    loads = rows.groupby("shard")["size"].sum()
    assert loads.max() - loads.min() <= rows["size"].max()


def test_rebalancing_moves_little_and_versions_stay(spark, tmp_path):
    r = random.Random(0)
    sizes = [r.randint(1, 1000) for _ in range(sharding.SLOTS)]
    first = sharding.SlotMap.plan(sizes, 16)
    assert max(first.loads()) - min(first.loads()) <= 1000
    same = first.rebalanced(sizes)
    assert same.shard_of == first.shard_of and same.version == 2
    grown = first.rebalanced(sizes, shards=17)
    moved = [k for k in range(len(sizes)) if grown.shard_of[k] != first.shard_of[k]]
    assert all(grown.shard_of[k] == 16 for k in moved) and max(grown.loads()) - min(grown.loads()) < 0.02 * sum(sizes) / 17
    for m in (first, grown):
        m.store(spark, str(tmp_path / "maps"))
    assert sharding.SlotMap.load(spark, str(tmp_path / "maps")).shard_of == grown.shard_of
    assert sharding.SlotMap.load(spark, str(tmp_path / "maps"), 1) == first


def test_numbers_of_a_hot_group(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 3).otherwise(7).alias("g"))
    out = numbered(df, "g", F.pmod(F.xxhash64("id"), F.lit(16)).cast("int"), ["id"], "n").toPandas()
    for _, own in out.groupby("g"):
        assert sorted(own["n"]) == list(range(len(own)))


# ---------------------------------------------------------------- packing


def padding(lengths, ends):
    return sum(min(e for e in ends if e >= x) for x in lengths)


def test_boundaries_are_optimal():
    r = random.Random(1)
    for _ in range(60):
        lengths = [r.randint(1, 30) for _ in range(r.randint(1, 25))]
        values, counts = np.unique(lengths, return_counts=True)
        k = r.randint(1, 4)
        best = min(padding(lengths, (*c, values[-1])) for n in range(k) for c in itertools.combinations(values[:-1], min(n, len(values) - 1)))
        assert padding(lengths, packing.boundaries(values, counts, k)) == best
    assert packing.boundaries(np.zeros(0, int), np.zeros(0, int), 4) == []


def test_packing_keeps_every_document_once(spark):
    docs, rows = data.awkward(spark)
    got = packing.pack(data.clashing(docs), buckets=4, budget=1000).toPandas()
    assert len(got) == len(rows)
    want = sorted(len(re.findall(r"\S+", t or "")) for _, t, _ in rows)
    assert sorted(got["n_tokens"]) == want and (got["padded_len"] >= got["n_tokens"]).all()
    for (_, _), own in got.groupby(["bucket", "batch"]):
        room = max(1, 1000 // own["padded_len"].iloc[0])
        assert len(own) <= room and sorted(own["place"]) == list(range(len(own)))
    for _, own in got.groupby("bucket"):
        room = max(1, 1000 // own["padded_len"].iloc[0])
        assert own["batch"].nunique() == -(-len(own) // room)
    assert packing.pack(data.empty(spark)).count() == 0


def test_packing_spreads_rows_that_repeat(spark, monkeypatch):
    """A hundred thousand rows without id, all of one length: no part has five times the median."""
    seen, number = [], packing.numbered
    monkeypatch.setattr(packing, "numbered", lambda rows, group, fine, *a: seen.append(rows.groupBy(fine.alias("part")).count().toPandas()["count"]) or number(rows, group, fine, *a))
    docs = spark.range(100_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("three words here").alias("text"))
    got = packing.pack(docs, budget=3_000).groupBy("bucket", "batch").agg(F.count("*").alias("n"), F.count_distinct("place").alias("places")).toPandas()
    assert seen[0].sum() == 100_000 and seen[0].max() < 5 * seen[0].median()
    assert got["n"].sum() == 100_000 and (got["n"] == got["places"]).all() and len(got) == 100


def test_long_lengths_are_rounded_up_a_little(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 32768, 32769, 100_001, 10**9 + 7)], "n long").select("n", packing.on_grid(F.col("n")).alias("g"))
    for r in df.collect():
        assert r["g"] >= max(1, r["n"]) and r["g"] <= max(1, r["n"]) * 1.001


# ---------------------------------------------------------------- decontamination

QUESTION = "Anna has 12 apples and buys 30 more at the market for 5 dollars each, then gives 12 to Peter before lunch; how many apples are left?"


@pytest.mark.parametrize(
    "text,found",
    [
        (QUESTION, True), (data.prose(1, 50) + " " + QUESTION.upper() + "!! " + data.prose(2, 50), True),
        ("x y. " + QUESTION.replace("Anna", "Maria").replace("Peter", "Paul").replace("12", "7").replace("30", "41").replace("5 dollars", "9 euros"), True),
        # the same number in the question is two numbers here: another question
        ("x y. " + QUESTION.replace("has 12", "has 7").replace("gives 12", "gives 8").replace("30", "41").replace("Anna", "Maria"), False),
        (QUESTION[:60], False), (data.prose(5, 400), False), ("", False), (None, False),
    ],
)
def test_reparameterised_questions(spark, text, found):
    items = spark.createDataFrame([(1, QUESTION), (2, QUESTION), (3, data.prose(77, 40)), (4, None), (5, ""), (None, "x y z")], "item_id long, text string")
    r = decontam.contaminated(data.frame(spark, [text]), items).first()
    assert r["contaminated"] == found and r["items"] == ([1, 2] if found else [])


def test_short_questions_and_blocks(spark, monkeypatch):
    items = spark.createDataFrame([(k, data.prose(k, 20)) for k in range(30)] + [(99, "Why so blue")], "item_id long, text string")
    texts = [data.prose(1000 + k, 30) + " " + data.prose(k, 20) + " " + data.prose(2000 + k, 30) for k in range(30)] + ["oh why SO blue, then", "why so"]
    one = decontam.contaminated(data.frame(spark, texts), items).collect()
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 500)
    many = decontam.contaminated(data.frame(spark, texts), items).collect()
    want = {k: [k] for k in range(30)} | {30: [99], 31: []}
    for got in (one, many):
        assert {r["doc_id"]: r["items"] for r in got} == want


def test_decontamination_like_brute_force(spark, sf_dir):
    words = lambda t: re.findall(r"\w+", t.lower())
    grams = lambda w: {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    items = {r["item_id"]: grams(words(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    for r in queries.op7_decontamination(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id").collect():
        g = grams(words(r["text"]))
        assert {i for i, s in items.items() if s and len(s & g) >= 0.8 * len(s)} == set(r["items"])


def test_decontamination_of_awkward_rows(spark):
    docs, rows = data.awkward(spark)
    items = spark.createDataFrame([(1, data.prose(3, 80))], "item_id long, text string")
    got = decontam.contaminated(data.clashing(docs), items).collect()
    assert len(got) == len(rows) and sum(r["contaminated"] for r in got) == 1
    assert decontam.contaminated(docs, items.limit(0)).where("contaminated").count() == 0
    assert decontam.contaminated(data.empty(spark), items).count() == 0


# ---------------------------------------------------------------- the pipeline


def _tables(spark, folder, texts, toxic, items):
    docs = data.frame(spark, texts).withColumns({"lang": F.lit("en"), "n_chars": F.length("text").cast("long")}).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(toxic, "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_each_stage_acts_on_what_the_last_one_kept(spark, tmp_path):
    texts, toxic = _corpus(500, random.Random(8))
    n = len(texts)
    item = data.prose(9001, 40)
    clean = [k for k in range(n) if not toxic[k]]
    long_ = data.prose(9002, 120)
    texts += [texts[clean[0]], texts[clean[0]].upper(), data.prose(9003, 20) + " " + item + " " + data.prose(9004, 20), long_, long_ + " and a tail", "", None]
    docs = _tables(spark, str(tmp_path), texts, list(enumerate(toxic)), [(1, item)])
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(materialise(stage(spark, seen[-1], str(tmp_path))))
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert all(d.columns == docs.columns for d in seen[:-1])
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    gone = [a - b for a, b in zip(ids, ids[1:])]
    wrong = {k for k in range(n) if (k in gone[0]) != bool(toxic[k])} | {k for k in gone[0] if k >= n}
    assert len(wrong) < 0.03 * n
    assert gone[1] == {clean[0], n, n + 5} - gone[0]
    assert gone[2] == {n + 4} and gone[3] == {n + 2} and gone[4] == set()
    assert seen[-1].count() == len(ids[-1]) == corpus_pipeline.run(spark, str(tmp_path)).count()


def test_pipeline_of_awkward_rows(spark, tmp_path):
    docs, rows = data.awkward(spark)
    _tables(spark, str(tmp_path), ["a"], [(1, 0)], [(1, "b")])
    docs = data.clashing(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, str(tmp_path)))
        if name == "exact_dedup":
            assert docs.count() == len({(t or "").lower() for _, t, _ in rows}) + 0 * len(rows)
    empty = data.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        empty = materialise(stage(spark, empty, str(tmp_path)))
    assert empty.count() == 0


def test_entry_has_them_all(spark):
    import __spark_entry__ as e

    names = e.queries()
    assert [n for k in range(1, 11) for n in names if n.startswith(f"op{k}_")] and sum(n.startswith("op") and n[2].isdigit() for n in names) == 13 and "pipeline" in names
    assert len(corpus_pipeline.STAGES) == 5


