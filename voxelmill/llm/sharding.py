"""Shards of near equal size through fixed virtual slots.

Records are hashed into thousands of slots, whose number never changes; bytes are summed per slot;
a versioned map says which shard holds which slot. The map is small (one row per slot) whatever the
data, so it is planned on the driver and broadcast. Rebalancing edits the map: it writes a new
version in which as few bytes as needed move, and rows follow their slot.

A slot is chosen by a hash of the id, the text and, among rows equal in both, a running number, so neither
a hot source nor a null id nor a row repeated very often makes a slot hot. Null texts have no bytes, very
long ones make their slot as large; an empty table gives no rows. Rows that tie in the order of a shard
are placed in any order. Columns named vslot, shard and slot are replaced, and so are those that begin
with an underscore and are named here.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voxelmill.llm.numbering import numbered
from voxelmill.llm.storage import materialise

SLOTS = 4096


def virtual_slot(keys: list[Column], slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def slotted(rows: DataFrame, keys: Sequence[str], slots: int = SLOTS) -> DataFrame:
    """``rows`` with ``vslot``, written. Rows equal in ``keys`` are numbered in two steps, within the parts
    they were read in and then part by part, so no task holds a hot group of them."""
    rows = materialise(rows.drop("vslot", "_h", "_part", "_no").withColumns({"_h": F.xxhash64(*keys), "_part": F.spark_partition_id(), "_no": F.monotonically_increasing_id()}))
    counts = materialise(rows.groupBy("_h", "_part").agg(F.count(F.lit(1)).alias("_n")))
    more = materialise(counts.groupBy("_h").agg(F.sum("_n").alias("_all")).where("_all > 1").select("_h"))
    before = Window.partitionBy("_h").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(counts.join(more, "_h").withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("_h", "_part", "_start"))
    nth = F.row_number().over(Window.partitionBy("_h", "_part").orderBy("_no")) - 1
    copies = rows.join(more, "_h", "left_semi").withColumn("_nth", nth).join(starts, ["_h", "_part"]).withColumn("_copy", F.col("_start") + F.col("_nth"))
    single = rows.join(more, "_h", "left_anti").withColumn("_copy", F.lit(0).cast("long"))
    out = single.unionByName(copies.select(*single.columns)).withColumn("vslot", virtual_slot([F.col("_h"), F.col("_copy")], slots))
    return materialise(out.drop("_h", "_part", "_no", "_copy"))


@dataclass(frozen=True)
class SlotMap:
    """``shard_of[slot]`` under one version; ``bytes_of[slot]`` is what it was planned with."""

    version: int
    shards: int
    shard_of: tuple[int, ...]
    bytes_of: tuple[int, ...]

    @classmethod
    def plan(cls, bytes_of: list[int], shards: int) -> SlotMap:
        """Version 1: the largest slots first, each to the lightest shard."""
        heap, out = [(0, k) for k in range(shards)], [0] * len(bytes_of)
        for slot in sorted(range(len(bytes_of)), key=lambda k: (-bytes_of[k], k)):
            load, shard = heapq.heappop(heap)
            out[slot] = shard
            heapq.heappush(heap, (load + bytes_of[slot], shard))
        return cls(1, shards, tuple(out), tuple(bytes_of))

    def loads(self) -> list[int]:
        out = [0] * self.shards
        for slot, shard in enumerate(self.shard_of):
            out[shard] += self.bytes_of[slot]
        return out

    def rebalanced(self, bytes_of: list[int], shards: int | None = None, tolerance: float = 0.01) -> SlotMap:
        """The next version for new sizes or more shards: slots move one at a time from the heaviest
        shard to the lightest, the largest that still evens them out, until all are within ``tolerance``
        of the mean or no move helps. Slots that needn't move stay where they are."""
        shards = shards or self.shards
        if shards < self.shards:
            raise ValueError("shards can only be added")
        out = replace(self, version=self.version + 1, shards=shards, bytes_of=tuple(bytes_of))
        where, load = list(self.shard_of), out.loads()
        held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
        for slot, shard in enumerate(where):
            held[shard].append((bytes_of[slot], slot))
        for own in held:
            own.sort()
        mean = sum(bytes_of) / shards
        while True:
            high, low = max(range(shards), key=lambda k: (load[k], -k)), min(range(shards), key=lambda k: (load[k], k))
            gap = load[high] - load[low]
            fits = [x for x in held[high] if 0 < x[0] < gap]
            if gap <= tolerance * mean or not fits:
                return replace(out, shard_of=tuple(where))
            move = min(fits, key=lambda x: (abs(gap / 2 - x[0]), x[1]))
            held[high].remove(move)
            held[low].append(move)
            where[move[1]] = low
            load[high] -= move[0]
            load[low] += move[0]

    def frame(self, spark: SparkSession) -> DataFrame:
        """version, shards, slot, shard, bytes: as it is stored."""
        rows = [(self.version, self.shards, k, s, b) for k, (s, b) in enumerate(zip(self.shard_of, self.bytes_of, strict=True))]
        return spark.createDataFrame(rows, "version int, shards int, vslot int, shard int, slot_bytes long")

    def store(self, spark: SparkSession, path: str) -> None:
        """Add this version to the table of maps; older versions stay readable."""
        self.frame(spark).write.partitionBy("version").mode("append").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        maps = spark.read.parquet(path)
        version = version or maps.agg(F.max("version")).first()[0]
        rows = sorted(maps.where(F.col("version") == version).select("vslot", "shard", "slot_bytes", "shards").collect())
        return cls(version, rows[0][3], tuple(r[1] for r in rows), tuple(r[2] for r in rows))


def slot_bytes(rows: DataFrame, slots: int = SLOTS, slot: str = "vslot", size: str = "size") -> list[int]:
    """Bytes per slot: one number per slot comes to the driver."""
    out = [0] * slots
    for k, n in rows.groupBy(slot).agg(F.sum(size)).collect():
        out[k] = int(n)
    return out


def shard(rows: DataFrame, mapping: SlotMap, order: list[str]) -> DataFrame:
    """Add ``shard`` and ``slot``, the row's gapless place within its shard, to rows with ``vslot``. The map
    that is broadcast has one row for each of the fixed slots."""
    small = mapping.frame(rows.sparkSession).select("vslot", "shard")
    return numbered(rows.drop("shard", "slot").join(F.broadcast(small), "vslot"), "shard", F.col("vslot"), order, "slot")
