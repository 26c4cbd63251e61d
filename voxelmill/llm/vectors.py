"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors of cosine ``c`` lie within a squared distance of 2 - 2c. A rotation spreads it over all coordinates;
these are cut into blocks, and in at least one block of two linked vectors the squared distance is within
the block's share of that budget. So every block is range-joined by itself: a tree of planes sends each vector to its leaf and,
as a probe, to all later leaves that its ball reaches; inside a leaf the range join goes on in numpy. A pair is
verified by its whole vectors where its first block within budget is joined, and nowhere else, so candidates
of all blocks are united without being written.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelmill.llm.components import components, solved
from voxelmill.llm.storage import materialise

#: Coordinates of a block.
WIDTH = 16
#: Vectors at home in a leaf, about, and rows that meet in one task at most twice over.
LEAF, TILE = 2048, 4096
#: Numbers of the sample (4 MB) that planes are drawn from, whatever the row count. Planes change the work, not the links.
SAMPLE = 1 << 19
#: Rotated coordinates are whole multiples of 2**-20, so that sums of squares are exact in whatever order.
GRID = float(1 << 20)
#: Vectors of a side that are compared at once.
CHUNK = 512


def _padded(d: int) -> int:
    return max(WIDTH, 1 << int(d - 1).bit_length())


def units(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in doubles."""
    x = np.ascontiguousarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def rotated(x: np.ndarray) -> np.ndarray:
    """Unit vectors after two rounds of fixed sign changes and a Walsh-Hadamard transform, in whole steps of ``GRID``."""
    n, d = x.shape
    p = _padded(d)
    y = np.zeros((n, p))
    y[:, :d] = x
    for signs in np.where(np.random.default_rng(p).random((2, p)) < 0.5, -1.0, 1.0):
        y *= signs
        step = 1
        while step < p:
            z = y.reshape(n, p // (2 * step), 2, step)
            y = np.stack((z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]), axis=2).reshape(n, p)
            step *= 2
        y /= np.sqrt(p)
    return np.rint(y * GRID)


def radius(cosine: float, d: int) -> float:
    """Distance within a block in steps of ``GRID``, with room for the rounding of both ends."""
    return (np.sqrt(max(0.0, 2 - 2 * cosine) * WIDTH / _padded(d)) + 1e-9) * GRID + np.sqrt(WIDTH)


def _matrix(col: pa.Array) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)


def planes(x: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Coordinate and place of each inner node's plane in a full binary tree: the median of the sample that reaches
    the node, along its widest coordinate. A node that no sample reaches takes its parent's coordinate, at zero."""
    dim, cut = np.zeros((1 << depth) - 1, np.int64), np.zeros((1 << depth) - 1)
    here = [np.arange(len(x))]
    for level in range(depth):
        after = []
        for k, own in enumerate(here):
            node = (1 << level) - 1 + k
            dim[node] = np.argmax(np.ptp(x[own], axis=0)) if len(own) else dim[max(0, (node - 1) // 2)]
            cut[node] = np.floor(np.median(x[own, dim[node]])) if len(own) else 0
            right = x[own, dim[node]] > cut[node]
            after += [own[~right], own[right]]
        here = after
    return dim, cut


def leaves(x: np.ndarray, tree: tuple[np.ndarray, np.ndarray], depth: int, r: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, leaf and whether it is at home there: each row once at home, and as a probe in all later leaves within ``r``."""
    row, node, home = np.arange(len(x)), np.zeros(len(x), np.int64), np.ones(len(x), bool)
    for _ in range(depth):
        off = x[row, tree[0][node]] - tree[1][node]
        left = off <= np.where(home, 0, r)
        right = off > np.where(home, 0, -r)
        also = home & left & (off >= -r)  # from home on the left to the right
        row, node, home = (np.concatenate(y) for y in ((row[left], row[right], row[also]), (2 * node[left] + 1, 2 * node[right] + 2, 2 * node[also] + 2), (home[left], home[right], np.zeros(also.sum(), bool))))
    return row, node - ((1 << depth) - 1), home


def near(x: np.ndarray, a: np.ndarray, b: np.ndarray, r: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of ``a`` and ``b`` so that any two rows of them within ``r`` of one another meet in exactly one: ``a`` is
    halved along the widest coordinate, ``b`` with an overlap of ``r``, while that saves work."""
    if not len(a) or not len(b):
        return
    if len(a) * len(b) > CHUNK * CHUNK:
        both = np.concatenate((x[a], x[b]))
        dim = int(np.argmax(np.ptp(both, axis=0)))
        cut = np.median(x[a, dim])
        al, ar, bl, br = a[x[a, dim] <= cut], a[x[a, dim] > cut], b[x[b, dim] <= cut + r], b[x[b, dim] > cut - r]
        if len(al) * len(bl) + len(ar) * len(br) < 0.8 * len(a) * len(b):
            yield from near(x, al, bl, r)
            yield from near(x, ar, br, r)
            return
    for i in range(0, len(a), CHUNK):
        for j in range(0, len(b), CHUNK):
            yield a[i : i + CHUNK], b[j : j + CHUNK]


def _within(x: np.ndarray, a: np.ndarray, b: np.ndarray, r: float) -> np.ndarray:
    square = (x * x).sum(axis=1)
    return square[a][:, None] + square[b] - 2 * (x[a] @ x[b].T) <= r * r


def linked(x: np.ndarray, weight: np.ndarray, home: np.ndarray, block: int, a: np.ndarray, b: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Of rows x: the weight of each one's links, and the least row that it reaches by them. Of pairs between ``a`` and
    ``b``, those count whose first block within budget is ``block``, two probes apart."""
    unit, r = units(x), radius(cosine, x.shape[1])
    turned = rotated(unit)
    part = lambda k: turned[:, k * WIDTH : (k + 1) * WIDTH]
    count, ends = np.zeros(len(x), np.int64), []
    both = len(a) == len(b) and (a == b).all()
    for i, j in near(part(block), a, b, r):
        ok = _within(part(block), i, j, r) & (home[i][:, None] | home[j])
        if both:
            ok &= i[:, None] < j
        for k in range(block):
            if ok.any():
                ok &= ~_within(part(k), i, j, r)
        if not ok.any():
            continue
        if ok.sum() * 8 > ok.size:
            p, q = np.nonzero(ok & (unit[i] @ unit[j].T >= cosine))
            p, q = i[p], j[q]
        else:
            p, q = np.nonzero(ok)
            p, q = i[p], j[q]
            sure = np.einsum("ij,ij->i", unit[p], unit[q]) >= cosine
            p, q = p[sure], q[sure]
        if len(p):
            count += np.bincount(p, weight[q], len(x)).astype(np.int64) + np.bincount(q, weight[p], len(x)).astype(np.int64)
            ends.append(solved(p, q))
    least = np.arange(len(x))
    if ends:
        nodes, label = solved(*(np.concatenate(y) for y in zip(*ends, strict=True)))
        least[nodes] = label
    return count, least


def usable(vector: str, label: str) -> Column:
    finite = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(F.col(label).isNotNull() & finite & F.exists(vector, lambda v: v != 0), F.lit(False))


def _scatter(cosine: float, depth: int, trees: dict, whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims):
                own = batch.filter(pa.array(dims == d))
                for at in range(0, own.num_rows, 2048):
                    part = own.slice(at, 2048)
                    turned = rotated(units(_matrix(part.column("vec"))))
                    for block in range(turned.shape[1] // WIDTH):
                        tree = trees.get((int(d), block))
                        row, leaf, home = leaves(turned[:, block * WIDTH : (block + 1) * WIDTH], tree, depth if tree else 0, radius(cosine, d))
                        names = ["node", "label", "dims", "weight", "vec"] if whole else ["label", "dims"]
                        cols = [part.column(c).take(pa.array(row)) for c in names] + [pa.array(np.full(len(row), block, np.int32)), pa.array(leaf), pa.array(home)]
                        yield pa.RecordBatch.from_arrays(cols, [*names, "block", "leaf", "home"])

    return run


def _joined(cosine: float) -> Callable[[tuple, pa.Table], pa.Table]:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        node, side = table["node"].to_numpy(), table["side"].to_numpy()
        x, block, i, j = _matrix(table["vec"].combine_chunks()), key[2].as_py(), key[4].as_py(), key[5].as_py()
        a, b = np.flatnonzero(side == i), np.flatnonzero(side == j)
        count, least = linked(x, table["weight"].to_numpy(), table["home"].to_numpy(), block, a, b, cosine)
        at = np.flatnonzero(count)
        return pa.table({"node": node[at], "links": count[at], "to": node[least[at]]})

    return run


def _trees(reps: DataFrame, depth: int) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]:
    """Planes for the most common length of vectors; vectors of other lengths have one leaf, which is split by rows."""
    if not depth:
        return {}
    d = reps.groupBy("dims").count().orderBy(F.desc("count"), "dims").first()["dims"]
    sample = reps.where(F.col("dims") == d).select("vec", "node").orderBy(F.xxhash64("node")).limit(max(1, SAMPLE // d)).toArrow()
    turned = rotated(units(_matrix(sample["vec"].combine_chunks())))
    return {(d, k): planes(turned[:, k * WIDTH : (k + 1) * WIDTH], depth) for k in range(turned.shape[1] // WIDTH)}


def near_vectors(rows: DataFrame, ids: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = 0.98, leaf: int = LEAF, tile: int = TILE) -> DataFrame:
    """(ids, n_links, component_id, kept) for every row: how many other vectors of its label and length have a cosine
    of at least ``cosine`` with it, the least id that such links reach, and whether that is its own.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and rows without a label, link with
    nothing. Equal vectors of a label are linked and counted without being compared. Rows that repeat an id are vectors
    of their own. Null ids are never a component's id while it has others; ``kept`` is false for them. Columns besides
    the three are not read. No rows give no rows.

    Each vector is sent to ``dims / WIDTH`` leaves, and to more as a probe where it lies near planes. A leaf of more than ``tile`` rows, such as a
    group of near copies, is dealt out by pairs of its pieces, so no task holds more than two pieces; what leaves a
    task is one row per vector, not per pair. The work for a group in which all are linked still grows with its square,
    as its links do."""
    rows = rows.select(F.col(ids).alias("id"), F.col(vector).alias("vec"), F.col(label).alias("label"))
    ok = usable("vec", "label")
    rows = rows.select("id", "label", "vec", ok.alias("ok")).withColumns({"d1": F.when(ok, F.xxhash64("vec", "label")), "d2": F.when(ok, F.xxhash64(F.lit(1), "label", "vec"))})
    groups = rows.where("ok").groupBy("d1", "d2").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("weight"), F.min("id").alias("least"))
    reps = materialise(groups.withColumns({"node": F.monotonically_increasing_id(), "dims": F.size("vec")}))
    most = reps.groupBy("label", "dims").count().agg(F.max("count")).first()[0] or 0
    depth = int(max(0, -(-most // leaf) - 1)).bit_length()
    trees = _trees(reps, depth)
    kinds = reps.schema["label"].dataType.simpleString(), reps.schema["vec"].dataType.simpleString()
    where = ["label", "dims", "block", "leaf"]
    light = reps.select("label", "dims", "vec").mapInArrow(_scatter(cosine, depth, trees, False), f"label {kinds[0]}, dims int, block int, leaf long, home boolean")
    large = materialise(light.groupBy(*where).count().where(F.col("count") > tile).select(*where, F.ceil(F.col("count") / tile).cast("int").alias("sides")))
    sent = reps.select("node", "label", "dims", "weight", "vec").mapInArrow(_scatter(cosine, depth, trees, True), f"node long, label {kinds[0]}, dims int, weight long, vec {kinds[1]}, block int, leaf long, home boolean")
    sent = sent.join(large, where, "left").withColumn("sides", F.coalesce("sides", F.lit(1)))
    side = F.pmod(F.xxhash64("node"), F.col("sides")).cast("int")
    dealt = sent.withColumn("side", side).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    dealt = dealt.select("node", "weight", "vec", "home", "side", *where, F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    found = materialise(dealt.groupBy(*where, "i", "j").applyInArrow(_joined(cosine), "node long, links long, to long"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    class_ = components(found.select(F.col("node").alias("a"), F.col("to").alias("b")).where("a <> b"))
    own = reps.select("d1", "d2", "node", "weight", "least").join(counts, "node", "left").join(class_, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = own.groupBy("label").agg(F.min("least").alias("component"))
    own = own.join(least, "label").select("d1", "d2", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "component")
    out = rows.select("id", "d1", "d2").join(own, ["d1", "d2"], "left")
    # a row that links with nothing has no digest
    component = F.when(F.col("d1").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select(F.col("id").alias(ids), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
