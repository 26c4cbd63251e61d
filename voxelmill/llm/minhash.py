"""Near duplicates by DartMinHash over word shingles.

Each element of a weighted set owns a Poisson process of darts on (weight, rank), fixed by hashes of the
element alone. A set keeps the darts below its elements' weights and below a rank that falls with its
total weight, so about k ln k darts are thrown for any size of set; each dart names one of k coordinates,
and the dart of least rank in a coordinate is the signature's value there. Two sets agree in a
coordinate with the probability of their weighted Jaccard similarity. An element is a shingle, its weight
how often the text has it; where no shingle repeats, this is the similarity of shingle sets.

Signatures are cut into bands. Texts with the same shingles are one node from the start. Within a bucket
of few nodes all pairs are candidates; in a large one every node is paired with a leader, drawn in one of
a few orders of all nodes, so that buckets with the same nodes have the same few leaders, and the bucket is
split again by the next band, where the same holds. Candidates are verified
by the weighted similarity itself, first two partners of each node, then what still joins
different components. Nodes of a large bucket that don't belong to its main component after that are
searched for exactly among all nodes of such buckets: two sets that are similar enough share one of their
rarest shingles, so these are joined (prefix filtering). So no pair that meets in a bucket is lost, and no
bucket's pairs are all formed. Classes are the connected components of the links.

Words are runs of letters and digits, lower-cased. A text of fewer than five words is one shingle; a
null text or one without words belongs to no class but its own. A very long text is signed and compared
whole, in a part of its own. Rows with the same id are rows of their own; of rows equal in all, one is
kept. Of ids that tie for the least, the row read first is kept. Null ids are kept only in classes without
another. An empty table gives no rows. Only the id, the text and the columns ``also`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelmill.llm.bitmap import only_of
from voxelmill.llm.components import components, labelled, merged
from voxelmill.llm.storage import materialise
from voxelmill.llm.text import U, by_size, flat, lowered, mix, prefix_hash, shingles, signed, span_hash, word_spans

WORDS, SIMILAR = 5, 0.8
COORDINATES, BAND = 128, 4
SMALL, ORDERS = 16, 4
KEPT_BYTES = 5
_UNIT = 1.0 / (1 << 53)


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> U(11)).astype(np.float64) * _UNIT


def _poisson(u: np.ndarray, mean: float) -> np.ndarray:
    """Poisson counts of the given quantiles."""
    n = int(mean + 12 * np.sqrt(mean) + 20)
    k = np.arange(1, n)
    steps = np.concatenate(([-mean], -mean + np.cumsum(np.log(mean) - np.log(k))))
    return np.searchsorted(np.cumsum(np.exp(steps)), u, "right")


def _cells(most: float) -> list[tuple[float, float]]:
    """[0, 1), [1, 2), [2, 4), ... as far as ``most``."""
    out, low, high = [], 0.0, 1.0
    while low < most:
        out.append((low, high))
        low, high = high, high * 2
    return out


def signatures(element: np.ndarray, owner: np.ndarray, weight: np.ndarray, sets: int, k: int = COORDINATES) -> np.ndarray:
    """(sets, k) dart names for sets given as (element, set number, weight) rows, each pair once.
    A set without weight has a signature of zeros."""
    total = np.bincount(owner, weight, minlength=sets)
    out, todo, factor = np.zeros((sets, k), U), np.flatnonzero(total > 0), 1.0
    while len(todo):
        bound = np.zeros(sets)
        bound[todo] = factor * k * (np.log(k) + 3) / total[todo]
        best, name = np.full(sets * k, np.inf), np.zeros(sets * k, U)
        in_play = bound[owner] > 0
        for rank_no, (r0, r1) in enumerate(_cells(float(bound.max()))):
            for weight_no, (w0, w1) in enumerate(_cells(float(weight[in_play].max()))):
                rows = np.flatnonzero(in_play & (bound[owner] > r0) & (weight > w0))
                if not len(rows):
                    continue
                seed = mix(element[rows] + U((rank_no * 64 + weight_no + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1))
                count = _poisson(_uniform(seed), (r1 - r0) * (w1 - w0))
                rows, dart = np.repeat(rows, count), np.repeat(seed, count)
                nth = np.arange(len(dart)) - np.repeat(np.cumsum(count) - count, count)
                dart = mix(dart + (nth + 1).astype(U) * U(0x9FB21C651E98DF25))
                rank = r0 + (r1 - r0) * _uniform(dart)
                ok = rank < bound[owner[rows]]
                if (weight[rows] < w1).any():
                    ok &= w0 + (w1 - w0) * _uniform(mix(dart + U(1))) < weight[rows]
                rows, dart, rank = rows[ok], dart[ok], rank[ok]
                name_of = mix(dart + U(2))
                at = owner[rows] * k + (name_of % U(k)).astype(np.int64)
                np.minimum.at(best, at, rank)
                hit = best[at] == rank
                # a later, lower dart replaces the name; cells come by rising rank, so few are replaced
                name[at[hit]] = name_of[hit]
        full = np.isfinite(best.reshape(sets, k)[todo]).all(1)
        out[todo[full]] = name.reshape(sets, k)[todo[full]]
        todo, factor = todo[~full], factor * 2
    return out


def weighted_sets(column: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of all texts, sorted within each, the text's number, and how often it has them."""
    buf, offsets = flat(lowered(column))
    start, end, doc = word_spans(buf, offsets)
    h, owner = shingles(span_hash(prefix_hash(buf), start, end), doc, words)
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    once = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))) if len(h) else np.zeros(0, np.int64)
    return h[once], owner[once], np.diff(np.append(once, len(h)))


def units(h: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Each element as often as it weighs, under another name each time: plain sets of these have the
    similarity that weighted sets have."""
    nth = np.arange(weight.sum()) - np.repeat(np.cumsum(weight) - weight, weight)
    h = np.repeat(h, weight)
    more = np.flatnonzero(nth)
    h[more] = mix(h[more] + nth[more].astype(U) * U(0xD1B54A32D192ED03))
    return h


def packed(h: np.ndarray) -> np.ndarray:
    """The upper 40 bits, five bytes each, in order: distinct shingles of a text collide once in about
    a million texts of a thousand words."""
    return np.ascontiguousarray((h >> U(24)).view(np.uint8).reshape(-1, 8)[:, :KEPT_BYTES]).ravel()


def unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, KEPT_BYTES)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :KEPT_BYTES] = raw
    return out.view(U).ravel()


def signed_rows(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS, k: int = COORDINATES, band: int = BAND, also: Sequence[str] = ()) -> DataFrame:
    """_row, _id, k1, k2, n (of shingles, repeated ones too), bands, set (of ``units``), and the columns ``also``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(whole, text_col):
                rows = len(batch)
                h, owner, weight = weighted_sets(batch.column(text_col), words)
                sig = signatures(h, owner, weight.astype(float), rows, k)
                h, owner = units(h, weight), np.repeat(owner, weight)
                bands = np.zeros((rows, k // band), U)
                for j in range(band):
                    bands = mix(bands * U(31) + sig[:, j::band])
                bands = mix(bands + np.arange(k // band, dtype=U)[None] * U(0x9E3779B97F4A7C15))
                n = np.bincount(owner, minlength=rows)
                sums = np.zeros((2, rows), U)
                for row, salt in zip(sums, (1, 2), strict=True):
                    np.add.at(row, owner, mix(h + U(salt)))
                cuts = np.append(0, np.cumsum(n)) * KEPT_BYTES
                sets = pa.LargeBinaryArray.from_buffers(pa.large_binary(), rows, [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(packed(h))])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * (k // band)), pa.array(signed(bands.ravel())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col), pa.array(signed(sums[0])), pa.array(signed(sums[1])), pa.array(n.astype(np.int64)), lists, sets.cast(pa.binary()), *(batch.column(c) for c in also)],
                    ["_id", "k1", "k2", "n", "bands", "set", *also],
                )

    more = "".join(f", `{c}` {docs.schema[c].dataType.simpleString()}" for c in also)
    return docs.select(id_col, text_col, *also).mapInArrow(sign, f"_id {kind}, k1 long, k2 long, n long, bands array<long>, set binary{more}").withColumn("_row", F.monotonically_increasing_id())


def candidates(nodes: DataFrame, count: int) -> tuple[DataFrame, DataFrame]:
    """a, b, times (how many bands name the pair), size (of the largest bucket whose leader is one of them, or
    0) from nodes (_row, bands), ``count`` at most; and _row, h1 of large buckets."""
    rows = nodes.select("_row", F.posexplode("bands").alias("_no", "h1"), "bands").select(
        "_row", "h1", F.xxhash64("h1", F.element_at("bands", F.pmod(F.col("_no") + 1, F.size("bands")) + 1)).alias("h2")
    )
    drawn = lambda key: F.min_by("_row", F.xxhash64("_row", F.pmod(key, F.lit(ORDERS)))).alias("leader")
    size = F.count(F.lit(1)).alias("size")
    shared = rows.groupBy("h1").agg(size, drawn(F.col("h1"))).where("size > 1")
    met = materialise(rows.join(shared, "h1"), count * COORDINATES // BAND)
    large = met.where(F.col("size") > SMALL)
    again = large.select("_row", "h2").distinct()
    split = again.groupBy("h2").agg(size, drawn(F.col("h2"))).where("size > 1")
    met_again = again.join(split, "h2").select("_row", F.col("h2").alias("h1"), "size", "leader")
    both = met.select("_row", "h1", "size", "leader").unionByName(met_again)
    few = both.where(F.col("size") <= SMALL).groupBy("h1").agg(F.array_sort(F.collect_list("_row")).alias("own"))
    pairs = few.select(F.posexplode("own").alias("i", "a"), "own").select("a", F.explode(F.slice("own", F.col("i") + 2, SMALL)).alias("b"), F.lit(0).cast("long").alias("size"))
    star = both.where(F.col("size") > SMALL).select(F.least("_row", "leader").alias("a"), F.greatest("_row", "leader").alias("b"), "size")
    return pairs.unionByName(star).where("a <> b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("times"), F.max("size").alias("size")), large.select("_row", "h1")


def unsettled(large: DataFrame, found: DataFrame, rows: int) -> DataFrame:
    """_row, label, rest: nodes of large buckets that hold several components; rest: not in a bucket's main one."""
    labelled = large.join(found.withColumnRenamed("node", "_row"), "_row", "left").withColumn("label", F.coalesce("label", "_row"))
    each = labelled.groupBy("h1", "label").agg(F.count(F.lit(1)).alias("n"))
    main = materialise(each.groupBy("h1").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), rows)
    return labelled.join(main, "h1").groupBy("_row", "label").agg(F.max(F.col("label") != F.col("main")).alias("rest"))


COUNTERS = 1 << 20


def rarest(sets: DataFrame, similar: float) -> DataFrame:
    """_row, label, rest, n, shingle, place: of each set (_row, label, rest, set) the rarest shingles, as many as a set of that
    similarity can't lack. Any order that is the same for all sets is exact; this one is by counters of
    fixed number that shingles are hashed to, so that common ones come last."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for x in batch.column("set"):
                np.add.at(total, (mix(unpacked(x.as_py())) % U(COUNTERS)).astype(np.int64), 1)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["k", "n"])

    counts = np.zeros(COUNTERS, np.int64)
    seen = sets.select("set").mapInArrow(count, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    counts[seen["k"].to_numpy()] = seen["n"].to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for whole in batches:
            for batch in by_size(whole, "set"):
                got, sizes = [], []
                for x in batch.column("set"):
                    h = unpacked(x.as_py())
                    h = h[np.lexsort((h, table[(mix(h) % U(COUNTERS)).astype(np.int64)]))]
                    sizes.append(len(h))
                    got.append(h[: len(h) - int(np.ceil(similar * len(h) - 1e-9)) + 1])
                owner = pa.array(np.repeat(np.arange(len(got)), [len(g) for g in got]))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).take(owner) for c in ("_row", "label", "rest")), pa.array(sizes, pa.int64()).take(owner),
                        pa.array(signed(np.concatenate(got) if got else np.zeros(0, U))), pa.array(np.concatenate([np.arange(len(g)) for g in got] or [np.zeros(0, np.int64)])),
                    ],
                    ["_row", "label", "rest", "n", "shingle", "place"],
                )

    return sets.select("_row", "label", "rest", "set").mapInArrow(pick, "_row long, label long, rest boolean, n long, shingle long, place long")


def searched(nodes: DataFrame, sets: DataFrame, similar: float) -> DataFrame:
    """Candidates (a, b) of different labels, one of them marked ``rest``: they share a shingle early enough
    that what follows it in both can still make them similar. Of sets that are similar, the smaller (x)
    lacks less than the larger (y) may: it has 2 s / (1 + s) of its own shingles in common with the
    larger, so it is looked up by fewer of its rarest ones. Pages of one template that aren't similar so don't
    meet by the template's shingles, which are among the larger's only. The larger is of the same step
    of a geometric scale of sizes, or of the next."""
    step = F.floor(F.log("n") / -np.log(similar) + 1e-9).cast("int")
    rows = materialise(rarest(sets.join(nodes, "_row"), similar).withColumn("step", step))
    few = F.col("place") <= F.col("n") - F.ceil(F.lit(2 * similar / (1 + similar)) * F.col("n") - 1e-6)
    small = rows.where(few).withColumn("step", F.explode(F.array(F.col("step"), F.col("step") + 1))).alias("x")
    large = rows.alias("y")
    x, y = (lambda c: F.col(f"x.{c}")), (lambda c: F.col(f"y.{c}"))
    enough = F.least(x("n") - x("place"), y("n") - y("place")) >= F.lit(similar / (1 + similar)) * (x("n") + y("n")) - 1e-6
    ordered = (x("n") < y("n")) | ((x("n") == y("n")) & (x("_row") < y("_row")))
    on = (x("shingle") == y("shingle")) & (x("step") == y("step")) & (x("label") != y("label")) & ordered & enough
    met = small.where("rest").join(large, on).select(x("_row").alias("a"), y("_row").alias("b"))
    met = met.unionByName(small.where("not rest").join(large.where("rest"), on).select(x("_row").alias("a"), y("_row").alias("b")))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, similar: float = SIMILAR) -> DataFrame:
    """Those of the pairs (a, b) whose shingle sets are at least that similar."""
    one = sets.select(F.col("_row").alias("b"), F.col("set").alias("set_b"))
    two = sets.select(F.col("_row").alias("a"), F.col("set").alias("set_a"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(len(batch), bool)
            for k, (x, y) in enumerate(zip(batch.column("set_a"), batch.column("set_b"), strict=True)):
                p, q = unpacked(x.as_py()), unpacked(y.as_py())
                if min(len(p), len(q)) >= similar * max(len(p), len(q)):
                    common = len(np.intersect1d(p, q, assume_unique=True))
                    ok[k] = common >= similar * (len(p) + len(q) - common) - 1e-9
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return pairs.select("a", "b").join(one, "b").join(two, "a").select("a", "b", "set_a", "set_b").mapInArrow(judge, "a long, b long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR, words: int = WORDS, also: Sequence[str] = ()) -> DataFrame:
    """One row per row of docs: the id column, class_id (the least id of its class), class_size, kept
    (one row of each class, of the least id), n_shingles, and the columns ``also``."""
    table = materialise(signed_rows(docs, id_col, text_col, words, also=also))
    total = table.count()
    rows = table.select("_row", "_id", "k1", "k2", "n", "bands", *also)
    with_words = rows.where("n > 0")
    # groups are written before rows join them: Spark can split a hot partition of a join only where both
    # sides come straight from a shuffle
    same = materialise(with_words.groupBy("k1", "k2", "n").agg(F.min("_row").alias("rep")), total)
    members = materialise(
        with_words.drop("bands").join(same, ["k1", "k2", "n"]).select("_row", "_id", "n", "rep", *also)
        .unionByName(rows.where("n = 0").select("_row", "_id", "n", F.col("_row").alias("rep"), *also)), total
    )
    nodes = with_words.join(same.select(F.col("rep").alias("_row")), "_row", "left_semi").select("_row", "bands")
    pairs, large = candidates(nodes, total)
    pairs = materialise(pairs, 2 * total)
    ends = pairs.select(F.col("a").alias("_row")).unionByName(pairs.select(F.col("b").alias("_row")))
    sets = materialise(only_of(table.select("_row", "set"), "_row", ends))

    def checked(some: DataFrame) -> tuple[DataFrame, int]:
        """Those of written candidates that are similar, and how many; Python compares some thousands in a task."""
        links = materialise(verified(some, sets, similar), some.count(), each=1 << 12)
        return links, links.count()

    way = lambda x, y: pairs.select(F.col(x).alias("node"), F.col(y).alias("other"), "times", "size")
    # first each node's likeliest partner, and the leader of its largest bucket, which holds a group together
    best = way("a", "b").unionByName(way("b", "a")).groupBy("node").agg(
        F.max_by("other", F.struct("times", "other")).alias("near"), F.max_by("other", F.struct("size", "times", "other")).alias("hub")
    )
    first = best.select("node", F.explode(F.array_distinct(F.array("near", "hub"))).alias("other"))
    first = materialise(first.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), 2 * total)
    found = components(*checked(first))
    rest = labelled(pairs.select("a", "b").join(first, ["a", "b"], "left_anti"), found).where("label_a <> label_b")
    more, count = checked(materialise(rest, 2 * total))
    if count:
        found = merged(found, more, count)
    open_ = materialise(unsettled(large, found, total), total)
    if not open_.where("rest").isEmpty():
        last, count = checked(materialise(searched(open_, sets, similar), total))
        if count:
            found = merged(found, last, count)
    placed = materialise(
        members.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("_row", "_id", "n", F.coalesce("label", "rep").alias("label"), *also), total
    )
    by_class = materialise(placed.groupBy("label").agg(
        F.min("_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.coalesce(F.min_by("_row", "_id"), F.min("_row")).alias("stays")
    ), total)
    return placed.join(by_class, "label").select(
        F.col("_id").alias(id_col), "class_id", "class_size", (F.col("_row") == F.col("stays")).alias("kept"), F.col("n").alias("n_shingles"), *also
    )
