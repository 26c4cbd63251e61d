"""Repeated passages: every byte covered by a string of 200 bytes that begins anywhere else, too.

Every window of 200 bytes names an anchor, the least hash among its strings of 50 bytes, so equal windows
name equal anchors. The windows of one anchor in a text begin next to one another; the stretch of text
that they cover is the anchor's context. Only contexts whose anchor hash occurs twice can hold repeated
windows. A context that occurs as a whole elsewhere is repeated in full and needs no text. The other
contexts of such an anchor are fetched and brought together by anchor hash; a suffix array of each block
of anchors, built by two-stage sorting, and the prefixes that neighbours in it have in common tell which
of their windows are repeated.

An anchor with more than ``CROWD`` distinct contexts (what stands around a passage in very many texts)
isn't sorted in one block: the hashes of its windows are counted instead, with a combine before the
shuffle, which is exact for it. Copies are counted, not gathered, so no task holds a hot passage.

Rows are known by id and text hash: rows equal in both are interchangeable. A null text is empty. A text
below 200 bytes keeps all its bytes; a very long one is searched for anchors in pieces that share a whole
context, so memory doesn't grow with its length there. Matches never cross texts. Strings
that tie for the least hash name the leftmost of them, in every window alike. An empty table gives no rows.
Only the id and the text are read, whatever other columns are named.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxelmill.llm.bitmap import bitmap, filtered, only_of
from voxelmill.llm.storage import materialise
from voxelmill.llm.suffix import repeated
from voxelmill.llm.text import U, by_size, flat, mix, prefix_hash, signed, span_hash

DEPTH, ANCHOR, CROWD = 200, 50, 2048
#: A context with more than one in so many of all rows isn't joined: there are fewer than so many.
HOT = 1000
PART, BLOCK = 1 << 18, 1 << 18
_PLACE = U(31)


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minima of all windows of ``width`` values."""
    done = 1
    while done * 2 <= width:
        x = np.minimum(x[:-done], x[done:])
        done *= 2
    return x if done == width else np.minimum(x[: len(x) - (width - done)], x[width - done :])


def anchors(buf: np.ndarray, offsets: np.ndarray, depth: int = DEPTH, size: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Anchor hash, context hash, text number, first and last window start (in the buffer) of every anchor."""
    none = np.zeros(0, np.int64)
    if len(buf) < depth:
        return none.view(U), none.view(U), none, none, none
    c = prefix_hash(buf, 10)
    at = np.arange(len(buf) - size + 1)
    h = span_hash(c, at, at + size)
    # places in the low bits: of equal hashes the leftmost is taken, in every text alike
    least = _least((h >> _PLACE << _PLACE) | at.astype(U), depth - size + 1)
    place = (least & U((1 << 31) - 1)).astype(np.int64)
    longs = np.flatnonzero(np.diff(offsets) >= depth)
    edge = np.zeros(len(place) + 1, np.int32)
    np.add.at(edge, offsets[longs], 1)
    np.add.at(edge, offsets[longs + 1] - depth + 1, -1)
    inside = np.cumsum(edge[:-1]) > 0
    new = inside & np.append(True, (place[1:] != place[:-1]) | ~inside[:-1])
    end = inside & np.append(new[1:] | ~inside[1:], True)
    first, last = np.flatnonzero(new), np.flatnonzero(end)
    context = span_hash(c, first, last + depth)
    context = mix(context + (place[first] - first).astype(U))
    return h[place[first]], context, np.searchsorted(offsets, first, "right") - 1, first, last


def in_pieces(buf: np.ndarray, offsets: np.ndarray, depth: int, most: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``anchors`` of a buffer; one long text is taken in pieces of ``most`` bytes. The last anchor of a
    piece may go on, so the next piece begins at its first window."""
    at = 0
    while len(offsets) == 2 and len(buf) - at > most:
        h, context, doc, first, last = anchors(buf[at : at + most], np.array([0, most]), depth)
        yield h[:-1], context[:-1], doc[:-1], first[:-1] + at, last[:-1] + at
        at += int(first[-1])
    h, context, doc, first, last = anchors(buf[at:], np.append(offsets[:1], offsets[1:] - at), depth)
    yield h, context, doc, first + at, last + at


def anchor_rows(docs: DataFrame, depth: int) -> DataFrame:
    """h, c, _id, _text_hash, first, last: one row per anchor of a text."""
    kind = docs.schema["_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(whole, "_text", PART):
                buf, offsets = flat(batch.column("_text"))
                for h, c, doc, first, last in in_pieces(buf, offsets, depth, PART):
                    owner = pa.array(doc)
                    base = offsets[doc]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(h)), pa.array(signed(c)), batch.column("_id").take(owner), batch.column("_text_hash").take(owner), pa.array((first - base).astype(np.int32)), pa.array((last - base).astype(np.int32))],
                        ["h", "c", "_id", "_text_hash", "first", "last"],
                    )

    return docs.mapInArrow(find, f"h long, c long, _id {kind}, _text_hash long, first int, last int")


def with_text(contexts: DataFrame, docs: DataFrame, depth: int) -> DataFrame:
    """h, one, _id, _text_hash, first, context (bytes) for rows with first and last.

    Rows equal in id and text give a context twice, but only one that isn't ``one`` anyway."""
    some = only_of(docs, "_text_hash", contexts)
    met = contexts.groupBy("_id", "_text_hash").agg(F.collect_list(F.struct("h", "one", "first", "last")).alias("own"))
    joined = some.join(
        met.withColumnsRenamed({"_id": "_id2", "_text_hash": "_text_hash2"}),
        F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_text_hash") == F.col("_text_hash2")),
    )
    kind = docs.schema["_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(whole, "_text", PART):
                lists = batch.column("own")
                n = np.diff(lists.offsets.to_numpy()) if len(batch) else np.zeros(0, np.int64)
                owner = np.repeat(np.arange(len(batch)), n)
                rows = lists.flatten()
                first, last = rows.field("first").to_numpy(), rows.field("last").to_numpy()
                buf, offsets = flat(batch.column("_text"))
                data = buf.tobytes()
                starts = offsets[owner] + first
                take = pa.array(owner)
                step = 20_000
                for k in range(0, len(owner), step):
                    s = slice(k, k + step)
                    pieces = [data[a:b] for a, b in zip(starts[s].tolist(), (starts[s] + (last[s] - first[s]) + depth).tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [rows.field("h").slice(k, step), rows.field("one").slice(k, step), batch.column("_id").take(take.slice(k, step)), batch.column("_text_hash").take(take.slice(k, step)), pa.array(first[s]), pa.array(pieces, pa.binary())],
                        ["h", "one", "_id", "_text_hash", "first", "context"],
                    )

    return joined.select("_id", "_text_hash", "_text", "own").mapInArrow(cut, f"h long, one boolean, _id {kind}, _text_hash long, first int, context binary")


def _runs(mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mark.astype(np.int8), [0]))))
    return edge[::2], edge[1::2]


def sorted_blocks(contexts: DataFrame, depth: int) -> DataFrame:
    """_id, _text_hash, span of the repeated windows: the rows of an anchor come together, and blocks of
    whole anchors are sorted."""
    kind = contexts.schema["_id"].dataType.simpleString()

    def tell(rows: pa.Table) -> pa.RecordBatch:
        texts = rows.column("context").to_pylist()
        got = repeated(texts, [len(x) - depth + 1 for x in texts], depth)
        one, first = rows.column("one").to_pylist(), rows.column("first").to_numpy()
        owner, spans = [], []
        for k, mark in enumerate(got):
            if one[k] and mark.any():
                for a, b in zip(*_runs(mark), strict=True):
                    owner.append(k)
                    spans.append(int(first[k] + a) << 32 | int(first[k] + b - 1 + depth))
        take = pa.array(owner, pa.int64())
        column = lambda c: rows.column(c).combine_chunks().take(take)
        return pa.RecordBatch.from_arrays([column("_id"), column("_text_hash"), pa.array(spans, pa.int64())], ["_id", "_text_hash", "span"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for whole in batches:
            for batch in by_size(whole, "context", BLOCK // 4):
                h = batch.column("h").to_numpy()
                if size >= BLOCK and held:
                    # the anchor that is being read goes on at the front of this part
                    open_ = held[-1].column("h")[-1].as_py()
                    n = int(np.argmax(h != open_)) if (h != open_).any() else len(h)
                    if n:
                        held.append(batch.slice(0, n))
                    if n < len(h):
                        yield tell(pa.Table.from_batches(held))
                        held, size, batch = [], 0, batch.slice(n)
                    else:
                        continue
                held.append(batch)
                size += batch.column("context").nbytes
        if held:
            yield tell(pa.Table.from_batches(held))

    parts = contexts.repartition("h").sortWithinPartitions("h")
    return parts.mapInArrow(scan, f"_id {kind}, _text_hash long, span long")


def counted_windows(contexts: DataFrame, depth: int) -> DataFrame:
    """The same for crowded anchors, by counting window hashes."""
    kind = contexts.schema["_id"].dataType.simpleString()

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(whole, "context", BLOCK // 4):
                if not len(batch):
                    continue
                sizes = np.array([len(x) for x in batch.column("context").to_pylist()])
                buf = np.frombuffer(b"".join(batch.column("context").to_pylist()), np.uint8)
                base, n = np.cumsum(sizes) - sizes, sizes - depth + 1
                owner = np.repeat(np.arange(len(n)), n)
                place = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                at = base[owner] + place
                w = [signed(span_hash(prefix_hash(buf, seed), at, at + depth)) for seed in (21, 22)]
                first = batch.column("first").to_numpy()[owner] + place
                take = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[0]), pa.array(w[1]), batch.column("one").take(take), batch.column("_id").take(take), batch.column("_text_hash").take(take), pa.array(first.astype(np.int64))],
                    ["w1", "w2", "one", "_id", "_text_hash", "at"],
                )

    windows = materialise(contexts.mapInArrow(open_, f"w1 long, w2 long, one boolean, _id {kind}, _text_hash long, at long"))
    twice = materialise(windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w1", "w2"))
    found = windows.where("one").join(twice, ["w1", "w2"])
    return found.select("_id", "_text_hash", F.shiftleft("at", 32).bitwiseOR(F.col("at") + depth).alias("span"))


def spans(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """_id, _text_hash, span (start << 32 | end), overlapping ones too, of docs (_id, _text, _text_hash)."""
    found = materialise(anchor_rows(docs, depth))
    twice = materialise(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    rows = materialise(only_of(found, "h", twice).join(twice, "h", "left_semi"))
    context = rows.groupBy("h", "c").agg(
        F.count(F.lit(1)).alias("n"), F.min("_text_hash").alias("_text_hash"), F.min_by("_id", "_text_hash").alias("_id"),
        F.min_by("first", "_text_hash").alias("first"), F.min_by("last", "_text_hash").alias("last"),
    )
    context = materialise(context)
    # rows of a hot context aren't dealt out by it: its numbers tell them where they are read (a context's hash has but one anchor)
    often = context.where("n > 1").select("h", "c", "n")
    hot = often.where(F.col("n") > rows.count() / HOT).collect()
    is_hot = F.col("c").isin([r["c"] for r in hot]) & F.col("h").isin([r["h"] for r in hot])
    whole = rows.where(~is_hot).join(often.where(~is_hot).select("h", "c"), ["h", "c"])
    if hot:
        whole = whole.unionByName(rows.where(is_hot))
    span = F.shiftleft(F.col("first").cast("long"), 32).bitwiseOR(F.col("last").cast("long") + depth).alias("span")
    full = whole.select("_id", "_text_hash", span)
    mixed = context.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1")
    open_ = materialise(context.join(mixed.select("h", "kinds"), "h").withColumn("one", F.col("n") == 1))
    few = with_text(open_.where(F.col("kinds") <= CROWD), docs, depth)
    out = full.unionByName(sorted_blocks(few, depth))
    crowded = open_.where(F.col("kinds") > CROWD)
    if not crowded.isEmpty():
        out = out.unionByName(counted_windows(with_text(crowded, docs, depth), depth))
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH) -> DataFrame:
    """One row per row of docs: the id column, n_bytes, n_removed, n_spans, kept (the remaining bytes)."""
    own = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).withColumn("_text_hash", F.xxhash64("_text"))
    each = materialise(spans(own, depth))
    found = each.groupBy("_id", "_text_hash").agg(F.collect_set("span").alias("spans"))
    found = found.withColumnsRenamed({"_id": "_id2", "_text_hash": "_text_hash2"})
    # texts that can't have spans are passed on where they are read
    shared = bitmap(each, "_text_hash")
    touched = filtered(own, "_text_hash", shared).join(found, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_text_hash") == F.col("_text_hash2")), "left")
    zero = F.lit(0).cast("long")
    untouched = filtered(own, "_text_hash", shared, False).select(
        "_id", F.octet_length("_text").cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans"), F.col("_text").cast("binary").alias("kept")
    )
    kind = own.schema["_id"].dataType.simpleString()

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(whole, "_text", PART):
                buf, offsets = flat(batch.column("_text"))
                lists = batch.column("spans")
                edge = np.zeros(len(buf) + 1, np.int32)
                counts = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
                packed = lists.flatten().to_numpy()
                base = np.repeat(offsets[:-1], counts)
                np.add.at(edge, base + (packed >> 32), 1)
                np.add.at(edge, base + (packed & 0xFFFFFFFF), -1)
                gone = np.cumsum(edge[:-1]) > 0
                removed = np.append(0, np.cumsum(gone))
                begins = gone & ~np.append(False, gone[:-1])
                begins[offsets[:-1][offsets[:-1] < len(buf)]] = gone[offsets[:-1][offsets[:-1] < len(buf)]]
                runs = np.append(0, np.cumsum(begins))
                kept = buf[~gone].tobytes()
                cuts = offsets - removed[offsets]
                pieces = [kept[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("_id"), pa.array(np.diff(offsets)), pa.array(np.diff(removed[offsets])), pa.array(np.diff(runs[offsets])), pa.array(pieces, pa.binary())],
                    ["_id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    out = touched.select("_id", "_text", "spans").mapInArrow(remove, f"_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary")
    return out.unionByName(untouched).withColumnRenamed("_id", id_col)
