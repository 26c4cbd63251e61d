"""Token-budget batches inside length buckets that are optimal for the whole corpus.

The histogram of lengths over all documents is exact. Only where it has more than 2**18 different lengths,
which takes texts of 2**35 tokens, are lengths over 2**15 rounded up to a grid with steps below 0.1 %, so it
stays small whatever the corpus. A dynamic program
over it chooses the bucket boundaries with the least padding. Each bucket is cut into batches of as
many documents as fit the token budget when padded to the bucket's boundary; a document longer than
the budget has a batch of its own and is not cut.

A null or empty text has length 0 and is packed as length 1, a null length as well. Nothing is dropped: rows
that repeat an id are packed like others, rows that tie in id and length in any order. An empty table gives
no rows. Only the id and the length are read, whatever other columns are named.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelmill.llm.numbering import numbered
from voxelmill.llm.storage import materialise

EXACT, PARTS, MOST = 1 << 15, 256, 1 << 18


def word_count(text: str | Column = "text") -> Column:
    """Tokens of a text: its runs of characters other than white space."""
    return F.regexp_count(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(r"\S+"))


def on_grid(length: Column) -> Column:
    """Lengths to pad to: at least 1; above 2**15, a multiple of a power of two under a thousandth of it."""
    step = F.pow(F.lit(2.0), F.floor(F.log2(length.cast("double"))) - 10)
    return F.when(length <= EXACT, F.greatest(length, F.lit(1)).cast("long")).otherwise((F.ceil(length / step) * step).cast("long"))


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` length ranges that cover all lengths with the least padding.

    best[k][j]: least padded total of the first j lengths in k buckets. Its best split moves right with j,
    so each layer is filled by divide and conquer, one level of all middles at a time."""
    order = np.argsort(lengths)
    lengths, counts = lengths[order].astype(np.int64), counts[order].astype(np.int64)
    n = len(lengths)
    if not n:
        return []
    rows = np.concatenate(([0], np.cumsum(counts)))
    best, cuts = np.full(n + 1, np.inf), []
    best[0] = 0
    for _ in range(min(buckets, n)):
        new, cut = np.full(n + 1, np.inf), np.zeros(n + 1, np.int64)
        new[0] = 0
        stack = [(1, n, 0, n - 1)]
        while stack:
            lo, hi, a, b = stack.pop()
            if lo > hi:
                continue
            mid = (lo + hi) // 2
            i = np.arange(a, min(b, mid - 1) + 1)
            cost = best[i] + (rows[mid] - rows[i]) * float(lengths[mid - 1])
            k = int(np.argmin(cost))
            new[mid], cut[mid] = cost[k], i[k]
            stack += [(lo, mid - 1, a, int(i[k])), (mid + 1, hi, int(i[k]), b)]
        best = new
        cuts.append(cut)
    ends, j = [], n
    for cut in reversed(cuts):
        if j:
            ends.append(int(lengths[j - 1]))
            j = int(cut[j])
    return sorted(ends)


def pack(docs: DataFrame, id_col: str = "doc_id", length: Column | None = None, buckets: int = 16, budget: int = 65_536) -> DataFrame:
    """One row per document: id, n_tokens, bucket, padded_len, batch (within the bucket), place (within
    the batch). A batch holds ``max(1, budget // padded_len)`` documents. Rows are numbered when they are first written, and dealt out by
    these numbers, so rows that repeat, or have no id, are spread as evenly as others."""
    length = word_count() if length is None else length
    rows = materialise(docs.select(F.col(id_col), F.coalesce(length, F.lit(0)).cast("long").alias("n_tokens"), F.monotonically_increasing_id().alias("_no")))
    for pads_to in (F.greatest("n_tokens", F.lit(1).cast("long")), on_grid(F.col("n_tokens"))):
        lengths = rows.withColumn("_len", pads_to)
        seen = lengths.groupBy("_len").agg(F.count(F.lit(1)).alias("n")).toArrow()
        if len(seen) <= MOST:
            break
    rows = lengths
    ends = boundaries(seen["_len"].to_numpy(), seen["n"].to_numpy(), buckets)
    if not ends:
        return rows.select(F.col(id_col), "n_tokens", *(F.lit(0).cast(t).alias(n) for n, t in (("bucket", "int"), ("padded_len", "long"), ("batch", "long"), ("place", "int"))))
    table = F.array(*map(F.lit, ends))
    bucket = F.size(F.filter(table, lambda e: e < F.col("_len")))
    placed = rows.withColumn("bucket", bucket.cast("int")).withColumn("padded_len", F.element_at(table, F.col("bucket") + 1).cast("long")).drop("_len")
    part = F.pmod(F.xxhash64("_no"), F.lit(PARTS)).cast("int")
    out = numbered(placed, "bucket", part, [id_col, "n_tokens"], "_row")
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("padded_len")))
    return out.withColumn("batch", F.floor(F.col("_row") / room).cast("long")).withColumn("place", F.pmod(F.col("_row"), room).cast("int")).drop("_row", "_no")
