"""Exact duplicates between an immutable snapshot and a new batch.

A snapshot keeps one row per distinct text and, for every shard of its digests, a static binary-fuse
filter. Incoming rows are first grouped among themselves, by SHA-256 of the normalised text; one row
of each group is screened by the filters: a task reads a shard's filter first and lets the shard's rows
stream past it. Positives join the snapshot's exact buckets, and one text of either side, fetched for
positives only, is compared byte by byte. Negatives need no join at all.

Every text is hashed once. Groups of copies are pre-aggregated before every shuffle, so no task gathers a
hot group; joins from rows back to groups have one row per key on the small side and are split by
adaptive execution.

Defined results: a null text counts as empty; only A-Z are lower-cased; a very long text is hashed and
compared whole; rows with a null id are grouped like others and one of them stays only where all ids of
the group are null; of rows that tie for the largest id, equal in all or not, one stays; an empty table
gives an empty result; columns other than the id, the text and ``also`` are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelmill.llm import fuse
from voxelmill.llm.bitmap import only_of
from voxelmill.llm.storage import materialise

#: Keys of one filter; a filter of this size takes about 230 kB.
SHARD_KEYS, LEAST_SHARDS = 100_000, 64


def normalised(text: str | Column = "text") -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digests(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", also: Sequence[str] = (), side: int = 0) -> DataFrame:
    """_sha, _row (a number that no other row has, on either side), _id and the columns ``also``, written."""
    row = F.monotonically_increasing_id() * 2 + side
    return materialise(df.select(*also, F.col(id_col).alias("_id"), F.unhex(F.sha2(normalised(text_col), 256)).alias("_sha")).withColumn("_row", row))


def groups(rows: DataFrame) -> DataFrame:
    """One row per digest: _top, the id and number of the row that stays, and the size of the group."""
    return rows.groupBy("_sha").agg(F.max(F.struct("_id", "_row")).alias("_top"), F.count(F.lit(1)).alias("_n"))


@dataclass(frozen=True)
class Snapshot:
    """``groups``: _sha, _top, _n. ``filters``: _shard, _filter."""

    groups: DataFrame
    filters: DataFrame
    shards: int

    @classmethod
    def of(cls, rows: DataFrame) -> Snapshot:
        """From digests; both tables are written once and never change."""
        kept = materialise(groups(rows))
        shards = max(LEAST_SHARDS, -(-kept.count() // SHARD_KEYS))

        def make(key: tuple[pa.Scalar, ...], t: pa.Table) -> pa.Table:
            filter_ = fuse.build(t.column("_key").to_numpy())
            return pa.table({"_shard": pa.array([key[0].as_py()], pa.int32()), "_filter": pa.array([filter_], pa.binary())})

        filters = keyed(kept, shards).select("_shard", "_key").groupBy("_shard").applyInArrow(make, "_shard int, _filter binary")
        return cls(kept, materialise(filters), shards)

    def screen(self, incoming: DataFrame) -> DataFrame:
        """_sha of the rows of ``incoming`` (grouped digests, written) whose digest may be in the snapshot.

        A batch much larger than the snapshot is dealt out further, each part with its own copy of the filter."""
        parts = max(1, -(-incoming.count() // (self.shards * SHARD_KEYS)))
        rows = keyed(incoming, self.shards).select("_shard", F.pmod(F.xxhash64("_key"), F.lit(parts)).cast("int").alias("_part"), F.lit(None).cast("binary").alias("_filter"), "_key", "_sha")
        filters = self.filters.select(
            "_shard", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("_part"), "_filter", F.lit(None).cast("long").alias("_key"), F.lit(None).cast("binary").alias("_sha")
        )

        def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            shard, filter_ = None, b""
            for batch in batches:
                at = batch.column("_shard").to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
                for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                    own = batch.slice(a, b - a)
                    if at[a] != shard:
                        shard, filter_ = at[a], b""
                    is_row = own.column("_key").is_valid()
                    for x in own.column("_filter").filter(pc.invert(is_row)):
                        filter_ = x.as_py()
                    own = own.filter(is_row)
                    if filter_ and len(own):
                        found = fuse.contains(filter_, own.column("_key").to_numpy())
                        yield own.select(["_sha"]).filter(pa.array(np.asarray(found)))

        dealt = rows.unionByName(filters).repartition("_shard", "_part").sortWithinPartitions("_shard", "_part", F.col("_key").isNotNull())
        return dealt.mapInArrow(sift, "_sha binary")


def keyed(rows: DataFrame, shards: int) -> DataFrame:
    key = F.xxhash64("_sha")
    return rows.withColumn("_key", key).withColumn("_shard", F.pmod(key, F.lit(shards)).cast("int"))


def byte_checked(pairs: DataFrame, left: DataFrame, right: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Of written pairs (_sha, _top, _top_s, ...), those whose sides have the same bytes. Of all texts, only
    those of rows with the ids that stay are fetched and shuffled."""

    def text(docs: DataFrame, top: str) -> DataFrame:
        rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        some = only_of(rows, "_id", pairs.select(F.col(f"{top}._id").alias("_id"))).select(normalised("_text").alias(f"_text{top}"))
        some = some.withColumn("_sha", F.unhex(F.sha2(f"_text{top}", 256)))
        return some.join(pairs.select("_sha"), "_sha", "left_semi").groupBy("_sha").agg(F.first(f"_text{top}").alias(f"_text{top}"))

    both = pairs.join(text(left, "_top"), "_sha").join(text(right, "_top_s"), "_sha")
    return both.where("_text_top = _text_top_s").drop("_text_top", "_text_top_s")


def deduplicate(old: DataFrame, new: DataFrame, id_col: str = "doc_id", text_col: str = "text", also: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``old`` and ``new``: the id column, keep_id, group_size, kept, text_sha256, and
    the columns ``also``. The row with the largest id stays, whichever side it is on."""
    seen, fresh = digests(old, id_col, text_col, also), digests(new, id_col, text_col, also, side=1)
    snapshot = Snapshot.of(seen)
    batch = materialise(groups(fresh))
    buckets = snapshot.groups.select("_sha", F.col("_top").alias("_top_s"), F.col("_n").alias("_n_s"))
    positives = materialise(batch.join(snapshot.screen(batch), "_sha").join(buckets, "_sha"))
    met = materialise(
        byte_checked(positives, new, old, id_col, text_col)
        .select("_sha", F.greatest("_top", "_top_s").alias("_top_m"), (F.col("_n") + F.col("_n_s")).alias("_n_m"))
    )

    def placed(rows: DataFrame, own: DataFrame) -> DataFrame:
        both = materialise(own.join(met, "_sha", "left").select(
            "_sha", F.coalesce("_top_m", "_top").alias("_top"), F.coalesce("_n_m", "_n").alias("group_size")
        ))  # written, so that the next join is one of two plain shuffles, whose hot partitions Spark can split
        return rows.join(both, "_sha").select(
            F.col("_id").alias(id_col), F.col("_top._id").alias("keep_id"), "group_size", (F.col("_row") == F.col("_top._row")).alias("kept"),
            F.lower(F.hex("_sha")).alias("text_sha256"), *also,
        )

    return placed(seen, snapshot.groups).unionByName(placed(fresh, batch))


def halves(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """All rows, as a snapshot and a new batch: the digest of the id decides, nothing is left out."""
    old = F.pmod(F.xxhash64(F.col(id_col)), F.lit(2)) == 0
    return docs.where(old), docs.where(~old)
