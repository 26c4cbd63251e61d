"""Ranked lexical search by a tiered index.

A posting is a document's occurrence count of a term; its impact is what one occurrence in a query adds to the score.
Tier 0 holds the postings of highest impact, further tiers the rest, and each term has a residual bound for every
tier: the highest impact that it has below it. Queries are answered from tier 0 where the bounds prove that no document outside can
enter the result; the others fall through to the next tier. The last tier has no residual, so every answer is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelmill.llm.hashes import BitTable, bit_table
from voxelmill.llm.storage import materialise, scratch
from voxelmill.llm.text import by_size, flat, prefix_hash, signed, span_hash, word_spans

#: Shares of all postings in tier 0 and in tiers 0 and 1; they move work between tiers, never rows.
TIERS = (0.7, 0.9)
#: A query is finished by looking up the whole scores of so many documents at most; with more left it falls through.
FINISH = 1000
#: So many of the best documents, as far as they have been read, are scored in full to find the score to beat: a multiple of the result.
AHEAD = 2
PART = 2 << 20

#: Bytes of a term (fixed): ASCII letters and digits, and every byte of a non-ASCII character.
TERM = np.zeros(256, bool)
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    TERM[_a:_b] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32

POSTING = "row long, id long, n long, term long, tf long"


def _postings(wanted: BitTable | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Term counts by row for terms that may be wanted; and, with a null row, how many rows have terms (tf) and terms with repeats (n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_size(batch, "text", PART):
                buf, offsets = flat(part.column("text"))
                buf = _LOW[buf]
                start, end, doc = word_spans(buf, offsets, TERM)
                n = np.bincount(doc, minlength=part.num_rows)
                h = span_hash(prefix_hash(buf), start, end)
                if wanted is not None:
                    ok = wanted.may_hold(h)
                    h, doc = h[ok], doc[ok]
                terms, rank = np.unique(h, return_inverse=True)
                pair, tf = np.unique(doc * max(1, len(terms)) + rank, return_counts=True)
                doc, rank = np.divmod(pair, max(1, len(terms)))
                cols = [part.column("row").take(pa.array(doc)), part.column("id").take(pa.array(doc)), pa.array(n[doc]), pa.array(signed(terms)[rank]), pa.array(tf)]
                yield pa.RecordBatch.from_arrays(cols, ["row", "id", "n", "term", "tf"])
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array([int(n.sum())]), none, pa.array([int((n > 0).sum())])], ["row", "id", "n", "term", "tf"])

    return run


def _numbered(rows: DataFrame, ids: str, text: str) -> DataFrame:
    return rows.select(F.col(ids).cast("long").alias("id"), F.col(text).alias("text")).withColumn("row", F.monotonically_increasing_id())


def questions(items: DataFrame, ids: str = "item_id", text: str = "text") -> DataFrame:
    """(item, item_id, term, q): how often each item has each term. Items are rows, whatever their ids."""
    found = _numbered(items, ids, text).mapInArrow(_postings(None), POSTING).where(F.col("row").isNotNull())
    return materialise(found.select(F.col("row").alias("item"), F.col("id").alias("item_id"), "term", F.col("tf").alias("q")))


@dataclass(frozen=True)
class Index:
    """impacts (row, id, term, impact, tier), in a folder for each tier, and residuals (term, bound_0, bound_1, ...):
    the highest impact of a term in the tiers below each."""

    impacts: DataFrame
    residuals: DataFrame


LAST = len(TIERS)
#: w: weight of the term; n: terms of the document; 64-bit throughout.
WEIGHT = "cast(floor(1000 * ln((2D * {docs} + 2) / (2D * df + 1))) as long)"
IMPACT = "w * ((1000000000L * tf) div (1000L * tf + 12L * (75L + (25L * n * {docs}L) div {total}L)))"


def index(docs: DataFrame, terms: DataFrame, ids: str = "doc_id", text: str = "text") -> Index | None:
    """The tiered index of whole texts for the terms (hashes in column ``term``) that queries will ask for; None if no
    text has a term. Terms are told apart by 64 bits of hash. Null texts have no terms; documents are rows, whatever their ids."""
    wanted = materialise(terms.select("term").distinct())
    found = materialise(_numbered(docs, ids, text).mapInArrow(_postings(bit_table(wanted, "term")), POSTING))
    n_docs, total = found.where(F.col("row").isNull()).agg(F.sum("tf"), F.sum("n")).first()
    if not n_docs:
        return None
    found = found.where(F.col("row").isNotNull())
    weights = found.groupBy("term").agg(F.count(F.lit(1)).alias("df")).join(wanted, "term")
    weights = materialise(weights.select("term", F.expr(WEIGHT.format(docs=n_docs)).alias("w")))
    scored = found.join(weights, "term").select("row", "id", "term", F.expr(IMPACT.format(docs=n_docs, total=total)).alias("impact"))
    cuts = scored.agg(F.percentile_approx("impact", [1 - x for x in TIERS], 1000)).first()[0] or []
    tier = reduce(lambda a, b: a + b, (F.when(F.col("impact") < F.lit(c), 1).otherwise(0) for c in cuts), F.lit(0))
    path = scratch(docs.sparkSession)
    scored.withColumn("tier", tier).write.partitionBy("tier").parquet(path)
    impacts = docs.sparkSession.read.schema("row long, id long, term long, impact long, tier int").parquet(path)
    bounds = [F.coalesce(F.max(F.when(F.col("tier") > k, F.col("impact"))), F.lit(0)).alias(f"bound_{k}") for k in range(LAST + 1)]
    return Index(impacts, materialise(impacts.groupBy("term").agg(*bounds)))


def _whole(pairs: DataFrame, asked: DataFrame, index: Index) -> DataFrame:
    """(item, row, id, score) of pairs (item, row), from all tiers."""
    own = index.impacts.join(pairs, "row").join(asked.select("item", "term", "q"), ["item", "term"])
    return own.groupBy("item", "row").agg(F.first("id").alias("id"), F.sum(F.col("q") * F.col("impact")).alias("score"))


def _first(scores: DataFrame, k: int) -> DataFrame:
    """The first ``k`` rows of each item, numbered: highest score, then least id (no id last), then by row."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(index: Index, asked: DataFrame, k: int = 20) -> DataFrame:
    """(item, rank, row, id, score): for each item of ``asked`` (see ``questions``) its ``k`` documents of highest score above 0."""
    asked = materialise(asked.join(index.residuals, "term"))
    bounds = [f"bound_{t}" for t in range(LAST + 1)]
    unseen = materialise(asked.groupBy("item").agg(*(F.sum(F.col("q") * F.col(b)).alias(f"all_{b}") for b in bounds)))
    partial, still, answers = None, unseen.select("item"), []
    for tier in range(LAST + 1):
        new = index.impacts.where(F.col("tier") == tier).join(asked.join(still, "item", "left_semi"), "term")
        new = new.select("item", "row", "id", (F.col("q") * F.col("impact")).alias("score"), *((F.col("q") * F.col(b)).alias(b) for b in bounds))
        if partial is not None:
            new = new.unionByName(partial.join(still, "item", "left_semi"))
        partial = materialise(new.groupBy("item", "row").agg(F.first("id").alias("id"), F.sum("score").alias("score"), *(F.sum(b).alias(b) for b in bounds)))
        if tier == LAST:
            answers.append(_first(partial.select("item", "row", "id", "score"), k))
            break
        ahead = materialise(_first(partial.select("item", "row", "id", "score"), AHEAD * k).select("item", "row"))
        beat = _first(_whole(ahead, asked, index), k).where(F.col("rank") == k).select("item", F.col("score").alias("beat"))
        # no document outside the tiers that were read can reach the k-th score
        proven = unseen.join(beat, "item").where(F.col(f"all_bound_{tier}") < F.col("beat"))
        able = materialise(
            partial.join(proven, "item").where(F.col("score") + F.col(f"all_bound_{tier}") - F.col(f"bound_{tier}") >= F.col("beat")).select("item", "row")
        )
        done = materialise(able.groupBy("item").count().where(F.col("count") <= max(FINISH, 2 * k)).select("item"))
        answers.append(_first(_whole(able.join(done, "item", "left_semi"), asked, index), k))
        still = materialise(still.join(done, "item", "left_anti"))
        if still.isEmpty():
            break
    return reduce(DataFrame.unionByName, answers).where(F.col("score") > 0)


def ranked(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` documents of highest score above 0 for each row of ``items``, equal
    scores by ascending id (null ids last). Null and empty texts have no terms and match nothing. Rows that repeat are documents, or items,
    of their own: each is counted, ranked and returned. Other columns are not read. An empty table on either side gives no rows.

    All documents are indexed, but only for terms of items, told by a bit table of at most 32 MB. What is shuffled are
    postings by term and sums by item and document; a term that every document has is met in the last tiers, by items
    that need it, and its rows are dealt out by Spark's skew handling as for any join."""
    asked = questions(items)
    found = index(docs, asked)
    names = asked.select("item", "item_id").distinct()
    if found is None:
        return names.select("item_id", F.lit(0).alias("rank"), F.col("item").alias("doc_id"), F.col("item").alias("score")).limit(0)
    return search(found, asked, k).join(names, "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
