"""Connected components of a table of links, without gathering a table of unbounded size in one place."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelmill.llm.storage import materialise

#: So many links (16 MB) are solved by one task; more are contracted first.
AT_ONCE = 1 << 20


def solved(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes and labels of links: the least node of each component. Roots are hooked onto lesser roots,
    then every node is sent to its root, until both ends of all links agree."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, label = ends[: len(a)], ends[len(a) :], np.arange(len(nodes))
    while True:
        x, y = label[a], label[b]
        open_ = x != y
        if not open_.any():
            return nodes, nodes[label]
        a, b = a[open_], b[open_]
        np.minimum.at(label, np.maximum(x, y)[open_], np.minimum(x, y)[open_])
        while (label != label[label]).any():
            label = label[label]


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts = [(x.column("a").to_numpy(), x.column("b").to_numpy()) for x in batches]
    if parts:
        nodes, labels = solved(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(labels)], ["node", "label"])


def _plain(links: DataFrame, rows: int | None, a: str = "a", b: str = "b") -> DataFrame:
    return materialise(links.where(f"{a} <> {b}").select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct(), rows)


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """node, label for every node of links (a, b), about ``rows`` of them: label is the least node of its component.

    While there are more than ``AT_ONCE`` links, every node goes over to the neighbour of least hash, and
    from there to that one's; links are redrawn between the nodes that are left, a fraction of those before
    (hashes are salted anew, so no order of nodes makes long chains). Nodes never leave their component, so
    each node's path of moves, followed to the end, tells its label. A link from a node to itself counts
    for nothing. No links give no rows."""
    links, moves, no = _plain(links, rows), [], 0
    while (rows := links.count()) > AT_ONCE:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(links.select("a", F.col("a").alias("b"))).unionByName(links.select(F.col("b").alias("a"), "b"))
        to = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min_by("b", F.xxhash64("b", F.lit(no))).alias("to")), rows)
        move = materialise(to.join(to.select(F.col("node").alias("to"), F.col("to").alias("far")), "to").select("node", F.col("far").alias("to")), rows)
        for end in ("a", "b"):
            links = links.join(move.select(F.col("node").alias(end), F.col("to").alias(f"to_{end}")), end)
        links, no = _plain(links, rows, "to_a", "to_b"), no + 1
        moves.append(move)
    found = links.coalesce(1).mapInArrow(_solve, "node long, label long")
    if not moves:
        return materialise(found)
    for move in reversed(moves):
        found = materialise(move.join(found.select(F.col("node").alias("to"), "label"), "to", "left").select("node", F.coalesce("label", "to").alias("label")))
    least = found.groupBy("label").agg(F.min("node").alias("least"))
    return materialise(found.join(least, "label").select("node", F.col("least").alias("label")))


def labelled(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) with label_a and label_b; a node without a component is its own."""
    for end in ("a", "b"):
        own = found.select(F.col("node").alias(end), F.col("label").alias(f"label_{end}"))
        pairs = pairs.join(own, end, "left").withColumn(f"label_{end}", F.coalesce(f"label_{end}", end))
    return pairs.select("a", "b", "label_a", "label_b")


def merged(found: DataFrame, links: DataFrame, rows: int | None = None) -> DataFrame:
    """Components after more links: these are drawn between components, which are far fewer than nodes."""
    between = labelled(links, found).select(F.col("label_a").alias("a"), F.col("label_b").alias("b"))
    top = components(between, rows)
    new = found.join(top.select(F.col("node").alias("label"), F.col("label").alias("up")), "label", "left").select("node", F.coalesce("up", "label").alias("label"))
    return materialise(new.unionByName(top.join(found, "node", "left_anti")), found.count())
