"""Small tables with every awkward row, and invented prose to hide things in."""

import random

import pandas as pd

WORDS = [a + b + c for a in ("an", "er", "th", "on", "le", "ung") for b in ("ba", "mi", "to", "ra") for c in ("st", "ng", "l", "")]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


#: Names that the operators use themselves.
CLASHING = ["_key", "key", "score", "n_lines", "n_removed", "size", "shard", "slot", "base", "found", "spans", "row", "id", "h", "c", "bands", "_row", "_id", "_text", "kept", "share", "items", "batch", "bucket"]


def awkward(spark, text="text"):
    """Null and empty texts, null and repeated ids, repeated rows, null sources, a very long text, emoji."""
    long_ = prose(1, 60_000)
    rows = [
        (1, "", "s1"), (2, None, "s1"), (3, "short one", None), (4, "short one", "s2"), (5, long_, "s3"), (6, long_ + " tail", "s4"), (None, "no id", "s1"), (None, None, None),
        (7, prose(2, 80), "s1"), (7, prose(2, 80), "s1"), (7, prose(3, 80), "s2"), (8, "\U0001f600 \n\n  \n" + prose(4, 30), "s5"), (9, " ", "s1"), (10, "x", "s1"), (11, "É" * 500, "s2"),
    ]
    df = spark.createDataFrame(rows, f"doc_id long, {text} string, source string").repartition(3)
    return df, rows


def clashing(df):
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit("other") for n in CLASHING if n not in df.columns})


def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def frame(spark, texts, sources=None):
    pdf = pd.DataFrame({"doc_id": list(range(len(texts))), "text": texts, "source": sources or ["s"] * len(texts)})
    return spark.createDataFrame(pdf, "doc_id long, text string, source string").repartition(4)
