"""Passages that stand in very many texts."""

from pyspark.sql import functions as F

from tests.llm import data
from voxelmill.llm import passages


def test_rows_of_hot_contexts_are_not_joined(spark, monkeypatch):
    """What is in more than one in ``HOT`` of all rows passes by the joins, once for each of its rows."""
    monkeypatch.setattr(passages, "HOT", 50)
    common = data.prose(3, 60)
    texts = [common] * 40 + [data.prose(100 + k, 80) for k in range(20)] + [data.prose(200, 80)] * 2
    own = data.frame(spark, texts).select(F.col("doc_id").alias("_id"), F.col("text").alias("_text")).withColumn("_text_hash", F.xxhash64("_text"))
    found = passages.spans(own)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and "LeftAnti" not in plan
    rows = found.collect()
    assert len(rows) == len(set(rows))
    covered = {r["_id"] for r in rows}
    assert covered == {r["_id"] for r in own.collect() if texts.count(r["_text"]) > 1}
