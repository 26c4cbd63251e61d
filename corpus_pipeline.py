"""From raw documents to packed batches: each stage works on all rows that the one before it kept.

Stages take and return rows with the columns of ``documents``; only the last returns batches instead.
Rows are told apart by two hashes of id and text (128 bits), so null and repeated ids keep their own
decisions; a null text counts as empty, very long ones are read whole, further columns pass through
whatever their names. Of rows equal in id and text, the deduplicating stages keep one, and the others
treat all alike. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelmill.llm import decontam, exact, minhash, packing, toxicity
from voxelmill.llm.bitmap import bitmap, filtered
from voxelmill.llm.storage import freeing, materialise, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    key, text = free_name(docs, "_key"), F.coalesce("text", F.lit(""))
    return docs.withColumn(key, F.struct(F.xxhash64("doc_id", text).alias("a"), F.xxhash64(text, "doc_id", F.lit(1)).alias("b"))), key


def kept_once(docs: DataFrame, key: str, judged: DataFrame) -> DataFrame:
    """Rows of ``docs`` that ``judged`` (key, kept: one row per row) keeps. Rows that share a key are
    interchangeable: one of them stays if any is kept. Texts of rows that a bitmap of the other keys tells
    apart aren't shuffled."""
    some = materialise(judged.groupBy(key).agg(F.max("kept").alias("stays"), F.min("kept").alias("all_stay")).where(~F.col("all_stay")))
    shared = bitmap(some, key)
    sure, rows = filtered(docs, key, shared, inside=False), filtered(docs, key, shared)
    rows = rows.join(some.where("not stays").select(key), key, "left_anti")
    repeated = some.where("stays").select(key)
    if not repeated.isEmpty():
        once = rows.join(repeated, key, "left_semi").dropDuplicates([key])
        rows = rows.join(repeated, key, "left_anti").unionByName(once)
    return sure.unionByName(rows).drop(key)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that are likelier toxic than not go."""
    score = free_name(docs, "score")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model, out=score).where(F.col(score) < 0.5).drop(score)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased), the row with the largest id stays, one of those that tie for it."""
    rows, key = keyed(docs)
    return kept_once(rows, key, exact.deduplicate(*exact.halves(rows), also=[key]).select(key, "kept"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates, the document of least id stays, one of those that tie for it."""
    rows, key = keyed(docs)
    return kept_once(rows, key, minhash.classes(rows, also=[key]).select(key, "kept"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark question go."""
    rows, key = keyed(docs)
    judged = decontam.contaminated(rows, table(spark, sf_dir, "benchmark"), id_col=key)
    return kept_once(rows, key, judged.select(key, (~F.col("contaminated")).alias("kept")))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Batches: one row per document with its bucket, batch and place."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: Learned models and near duplicates are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Of each stage, only what it returns is left on disk when the next one begins."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        with freeing() as kept:
            docs = materialise(stage(spark, docs, sf_dir))
            kept.append(docs)
    return STAGES[-1][1](spark, docs, sf_dir)
