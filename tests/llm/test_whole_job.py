"""Cases in which an operator once did less than its whole job."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import data
from voxelmill.llm import decontam, packing, pii, sharding, toxicity


# ---------------------------------------------------------------- decontamination


def _found(texts, items, share=decontam.SHARE):
    """Per text: found items and their shares, as one batch."""
    t, out = decontam.canonical(pa.array(texts, pa.large_string())), [{} for _ in texts]
    for names in (False, True):
        b = decontam.block(list(enumerate(items)), names)
        for own, got in zip(out, decontam.matches(b, t, names, len(texts), share), strict=True):
            for k, s in got.items():
                own |= {i: max(s, own.get(i, 0.0)) for i in b.ids[k]}
    return out


@pytest.mark.parametrize("letter", ["İ", "ẞ", "Ⱥ", "é"])
def test_letters_whose_lower_case_has_other_bytes(spark, letter):
    question = data.prose(31, 20)
    texts = [f"{letter}x costs 1,000 or 3.14", "so " + question + " then", question]
    assert [sorted(x) for x in _found(texts, [question])] == [[], [0], [0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    items = spark.createDataFrame([(1, question)], "item_id long, text string")
    assert {r["doc_id"]: r["items"] for r in decontam.contaminated(docs, items).collect()} == {0: [], 1: [1], 2: [1]}


LISTS = [
    "what is the median of 3 7 9 12 15 18",
    "3 7 3 9 7 7 12",
    "sort 4 4 2 9 4 1 2 8 into rising order please",
    "add 3 kg 5 g 3 kg 7 g 3 kg and 2 kg",
    "given the values 1,000 3.14 7 7 1,000 2 5 8 what is their mean and how far is 8 from it",
]


@pytest.mark.parametrize("k", range(len(LISTS)))
def test_exact_copies_of_number_lists(k):
    more = [data.prose(5, 30) + ". " + LISTS[k] + ". " + data.prose(6, 30), "8 1 5 " + LISTS[k] + " 5 6 9"]
    for got in _found([LISTS[k], *more], LISTS):
        assert got[k] == 1.0


def test_other_number_lists_are_other_questions():
    # a number of the question is two numbers here, whichever way the lists are laid upon one another
    assert _found(["please sort 4 5 2 9 6 1 3 8 into rising order please"], [LISTS[2]]) == [{}]
    assert _found(["add 3 kg 5 g 4 kg 7 g 6 kg and 2 kg"], [LISTS[3]]) == [{}]
    # drifted words that break the mapping still count against it
    question = "x has 12 apples in the old red basket and later on that day they give 12 to the boys and girls of the town"
    assert _found([question.replace("red", "red big").replace("12 to", "8 to").replace("has 12", "has 7")], [question]) == [{}]


def test_short_questions_of_one_template(spark):
    items = ["What is 2+2", "What is 3+5", "What is 4+9", "Why so blue", "7", "Is 5 5 5"]
    # so short a template says little: the values have to be the question's own
    texts = ["So what is 2+2 then", "what is 3+5", "what is 6+1", "what is it", "oh why so blue", "is 5 5 4", "is 5 5 5"]
    want = [{0}, {1}, set(), set(), {3}, set(), {5}]
    assert [{*x} for x in _found(texts, items)] == want
    table = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = decontam.contaminated(data.frame(spark, texts), table).collect()
    assert {r["doc_id"]: {*r["items"]} for r in got} == dict(enumerate(want))


def test_short_templates_do_not_mark_clean_texts():
    items = ["42", "about 30 km", "what is 2 plus", "what is 9 plus"]
    texts = ["there were 17 of them", "it is about 12 miles away", "so what is 7 plus then", "about 30 km off", "42!", "now what is 9 plus 1, and what is 2 plus"]
    assert [sorted(x) for x in _found(texts, items)] == [[], [], [], [1], [0], [2, 3]]


def test_items_without_an_id_count(spark):
    question = data.prose(32, 12)
    items = spark.createDataFrame([(None, question), (4, question), (None, data.prose(33, 12))], "item_id long, text string")
    got = {r["doc_id"]: r["items"] for r in decontam.contaminated(data.frame(spark, ["so " + question, data.prose(33, 12), "x"]), items).collect()}
    assert got == {0: [4, None], 1: [None], 2: []}


def test_numbers_without_end_take_linear_time(monkeypatch):
    import random
    import time

    r = random.Random(6)
    items = [" ".join(str(r.randint(1, 99)) for _ in range(n)) for n in (6, 60, 300)]
    text = " ".join(str(r.randint(1, 99)) for _ in range(8000))
    texts = [text + " " + items[1] + " " + text, " ".join(["7"] * 20_000), "a " + items[2], items[0]]
    began = time.perf_counter()
    want = [[1], [], [2], [0]]
    assert [[k for k in x if k] if i < 1 else sorted(x) for i, x in enumerate(_found(texts, items))] == want
    assert time.perf_counter() - began < 60
    # a text with too many hits to lay out at once gives the same
    monkeypatch.setattr(decontam, "HITS", 1000)
    assert [[k for k in x if k] if i < 1 else sorted(x) for i, x in enumerate(_found(texts, items))] == want


def test_reparameterised_questions_and_clean_texts():
    import random

    r = random.Random(8)
    names = ("Anna", "Maria", "Peter", "Paul", "Clara", "Oskar", "Ruth", "Hugo")
    forms = [
        "{n} has {a} apples and buys {b} more at the market for {c} dollars each, then gives {a} to {m} before lunch; how many are left?",
        "A train leaves the station at {a} km per hour and another one follows it after {b} minutes at {c} km per hour; when do they meet?",
        "In a box there are {a} red balls and {b} blue balls; {n} draws {c} of them without looking, what is the chance that all are red?",
        "{n} and {m} share {a} dollars so that {n} gets {b} dollars more than {m}; how much does each of them get in the end?",
    ]
    make = lambda f: f.format(n=(x := r.sample(names, 2))[0], m=x[1], **dict(zip("abc", map(str, r.sample(range(2, 99), 3)))))
    items = [make(f) for f in forms]
    texts = [f"{data.prose(k, 40)}. So {make(forms[k % 4])} {data.prose(9000 + k, 40)}" for k in range(200)]
    found = _found(texts, items)
    assert sum(k % 4 in x for k, x in enumerate(found)) >= 0.95 * len(texts)
    assert all({*x} <= {k % 4} for k, x in enumerate(found))
    assert not any(_found([data.prose(k, 200) for k in range(100)], items))


# ---------------------------------------------------------------- shards


def test_repeated_rows_are_spread(spark):
    rows = [(1, "same text")] * 2000 + [(k, data.prose(k, 3)) for k in range(200)] + [(None, None)] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7).withColumn("vslot", F.lit("theirs"))
    some = docs.withColumn("size", (F.octet_length(F.coalesce("text", F.lit(""))) + 1).cast("long"))
    out = sharding.slotted(some, ["doc_id", "text"])
    mapping = sharding.SlotMap.plan(sharding.slot_bytes(out), 16)
    assert out.count() == len(rows) and max(mapping.loads()) - min(mapping.loads()) < 0.1 * sum(mapping.loads()) / 16
    again = sharding.slotted(some.repartition(3), ["doc_id", "text"])
    assert sharding.slot_bytes(again) == sharding.slot_bytes(out)
    got = sharding.shard(out, mapping, ["doc_id"]).toPandas()
    for _, own in got.groupby("shard"):
        assert sorted(own["slot"]) == list(range(len(own)))


# ---------------------------------------------------------------- personal data


def test_long_stretches_are_decoded_piece_by_piece():
    table = pii.labelled_table(300)
    index, field = pii.train(table)
    text = " ".join("call (555) 123-4567 or 12.5 of 9" for _ in range(700))
    spans = pii.tokens(text)
    whole = [[index.get(f, -1) for f in row] for row in pii.described(text, spans.tolist())]
    for piece in (7, 64, 100_000):
        seq = pii.numbers(text, spans, index, piece)
        assert seq.tolist() == whole
        assert (field.decode([seq], piece=piece)[0] == field.decode([seq, seq[:5]])[0]).all()
    digits = " ".join("0123456789"[k % 10] * (k % 9 + 1) for k in range(60_000))
    assert pii.added_spans([digits], [pii.base_spans(digits)], (index, field))


def test_stretches_see_what_whole_texts_show(spark, sf_dir, monkeypatch):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    base, model = [pii.base_spans(t) for t in texts], pii._trained()
    got = {(k, *s) for k, x in enumerate(pii.added_spans(texts, base, model)) for s in x}
    monkeypatch.setattr(pii, "stretches", lambda t: [(0, len(t))])
    want = {(k, *s) for k, x in enumerate(pii.added_spans(texts, base, model)) for s in x}
    assert len(got & want) >= 0.95 * len(want) and len(got - want) <= 0.05 * max(1, len(want))


# ---------------------------------------------------------------- the pipeline


def test_exact_stage_of_equal_ids(spark):
    rows = [(1, "Hello World"), (1, "hello world"), (2, "other"), (2, "other"), (3, None), (3, ""), (None, "Nobody"), (None, "nobody"), (None, "nobody"), (5, "Other")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, kept string").repartition(4)
    got = corpus_pipeline.exact_stage(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, (r["text"] or "").lower()) for r in got) == [(0, "nobody"), (1, "hello world"), (3, ""), (5, "other")]
    assert {r["kept"] for r in got} == {"x"}


def test_near_stage_of_repeated_rows(spark):
    near = data.prose(41, 120)
    rows = [
        (1, data.prose(40, 60), "a"), (1, data.prose(40, 60), "b"), (2, near, "a"), (2, near, "a"), (3, near + " tail", "a"), (3, near + " tail", "a"),
        (None, data.prose(43, 60), "a"), (None, data.prose(43, 60), "a"), (5, "", "a"), (5, None, "a"), (6, data.prose(42, 60), "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, stays string").repartition(3)
    got = corpus_pipeline.near_stage(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got.collect()) == sorted((k or 0, t or "") for k, t, _ in (rows[0], rows[2], rows[6], *rows[8:]))


# ---------------------------------------------------------------- toxicity


@pytest.fixture(scope="module")
def language(spark):
    texts = [data.prose(k, 60) + " you are an idiot and a stupid moron, loser; is this trash really pathetic? what an ass" for k in range(200)]
    return toxicity.language_model(toxicity.trigram_counts(data.frame(spark, texts)))


LONG = "so you are an idiot and a stupid moron and this is really trash " * 3


@pytest.mark.parametrize(
    "text,word",
    [
        ("id" + "i" * 60 + "ot", "idiot"), ("a-plain-and-very-long-chain/of,words-that-hides-1d10t-in-it-all", "idiot"), ("this/is/a/very/long/path/of/words,stup1d,and/more", "stupid"),
        ("one a$$ more", "ass"), ("one a.s.s more", "ass"), ("such a lo$€r", "loser"), (" ".join(LONG.replace(" ", "")), "moron"), (".".join(LONG.replace(" ", "")), "moron"),
        ("x" * 100 + "st0p" + "y" * 3 + "1d10t" * 30, None), ("i d i o t", "idiot"), ("y o u i d i o t", "idiot"),
    ],
)
def test_long_and_short_disguises_are_restored(language, text, word):
    column = pa.array([text, "Then another text"])
    got = list(toxicity.features(column, language))
    assert len(got) == 2
    if word:
        hashes, owner = next(toxicity.features(pa.array([word]), language))
        assert {*hashes[:1].tolist()} <= {*got[1][0][got[1][1] == 0].tolist()}
    assert set(got[1][1].tolist()) == {0}


def test_reading_grows_with_the_text_only(language):
    text = "1d10t" * 20_000
    assert len(toxicity.restore(text, language)) >= 60_000


# ---------------------------------------------------------------- length buckets


def test_buckets_of_very_long_texts_are_exact(spark, monkeypatch):
    lengths = [40_001] * 5 + [40_007] * 3 + [100_003, 0]
    docs = spark.createDataFrame(list(enumerate(lengths)), "doc_id long, n long")
    got = packing.pack(docs, length=F.col("n"), buckets=4).collect()
    assert sorted((r["n_tokens"], r["padded_len"]) for r in got) == sorted((n, max(n, 1)) for n in lengths)
    monkeypatch.setattr(packing, "MOST", 3)
    got = packing.pack(docs, length=F.col("n"), buckets=4).collect()
    assert len(got) == len(lengths) and all(1 <= r["padded_len"] and r["n_tokens"] <= r["padded_len"] <= max(1, r["n_tokens"]) * 1.001 for r in got)
