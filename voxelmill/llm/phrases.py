"""Phrase collocation mining.

Frequent words become numbers of fixed width, anything else breaks a piece of text; runs of numbers are keys of
fixed width, counted within parts of text, range-partitioned, sorted (Spark sorts the leading bytes by radix)
and summed run by run. Two passes suffice: pairs first, then longer phrases where all pairs are frequent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxelmill.llm.hashes import BitTable, bit_table
from voxelmill.llm.storage import materialise
from voxelmill.llm.text import U, by_size, flat, mix, prefix_hash, signed, span_hash, word_spans

#: Least count of a phrase, most words of one, and how many are returned for each language.
LEAST, WORDS, FIRST = 100, 5, 2000
#: While so many words are frequent (a dictionary of 32 MB) they are numbered by 4 bytes; beyond, by 8 bytes of their hash.
NUMBERED = 1 << 22
PART = 2 << 20
#: Counted pairs that a task holds before it sends them (32 MB).
HELD = 1 << 21

#: Bytes that end a piece, and bytes between words besides (fixed).
ENDS, GAPS = b".,;:!?\n\x0b\x0c\r", b" \t"
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_ENDS = np.isin(_LOW, np.frombuffer(ENDS, np.uint8))
_WORD = ~(_ENDS | np.isin(_LOW, np.frombuffer(GAPS, np.uint8)))


@dataclass
class Words:
    """Words of a part of texts in order: their hashes (by language), the pieces they stand in, and where to find them."""

    h: np.ndarray
    piece: np.ndarray
    row: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray


def words(part: pa.RecordBatch) -> Words:
    data, offsets = flat(part.column("text"))
    data = _LOW[data]
    start, end, row = word_spans(data, offsets, _WORD)
    names, at = flat(part.column("lang"))
    lang = span_hash(prefix_hash(names, 7), at[:-1], at[1:])
    h = mix(span_hash(prefix_hash(data), start, end) ^ lang[row])
    ends = np.concatenate(([0], np.cumsum(_ENDS[data])))
    return Words(h, ends[start] + row, row, start, end, data)


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from by_size(batch, "text", PART)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in _parts(batches):
        w = words(part)
        h, at, n = np.unique(w.h, return_index=True, return_counts=True)
        raw = w.data.tobytes()
        texts = pa.array([raw[a:b] for a, b in zip(w.start[at].tolist(), w.end[at].tolist(), strict=True)], pa.binary()).cast(pa.string())
        lang = part.column("lang").take(pa.array(w.row[at]))
        for k in range(0, len(h), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(signed(h)[k : k + (1 << 16)]), lang[k : k + (1 << 16)], texts[k : k + (1 << 16)], pa.array(n[k : k + (1 << 16)])], ["h", "lang", "word", "n"])


@dataclass(frozen=True)
class Codes:
    """Numbers of frequent words: places in a sorted table, counted from 1, or hashes that a bit table may hold."""

    table: Broadcast[np.ndarray] | None
    bits: BitTable | None

    @property
    def width(self) -> int:
        return 4 if self.bits is None else 8

    def of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each word has a number, and the number."""
        if self.bits is not None:
            return self.bits.may_hold(h) & (h != 0), h
        table = self.table.value
        at = np.minimum(np.searchsorted(table, h), max(0, len(table) - 1))
        return (table[at] == h) if len(table) else np.zeros(len(h), bool), (at + 1).astype(U)

    def keys(self, code: np.ndarray, start: np.ndarray, size: np.ndarray, most: int) -> pa.Array:
        """Phrases of ``size`` words from ``start`` on as bytes that sort like their numbers, zeros behind shorter ones."""
        out = np.zeros((len(start), most), f">u{self.width}")
        for k in range(most):
            has = size > k
            out[has, k] = code[start[has] + k]
        return _binary(out.view(np.uint8).reshape(len(start), most * self.width))


def _binary(raw: np.ndarray) -> pa.Array:
    n, width = raw.shape
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((np.arange(n + 1) * width).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(raw))])


def coded(frequent: DataFrame) -> tuple[Codes, DataFrame]:
    """Codes of the words in a written table (h, ...), and the table with each word's ``key``, its code as bytes."""
    spark, count = frequent.sparkSession, frequent.count()
    if count <= NUMBERED:
        table = np.sort(frequent.select("h").toArrow()["h"].to_numpy().astype(np.int64).view(U))
        codes = Codes(spark.sparkContext.broadcast(table), None)
    else:
        codes = Codes(None, bit_table(frequent, "h"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = codes.of(batch.column("h").to_numpy().view(U))[1]
            yield batch.append_column("key", codes.keys(code, np.arange(len(code)), np.ones(len(code), np.int64), 1))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in frequent.schema)
    return codes, materialise(frequent.mapInArrow(number, f"{kinds}, key binary"))


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a) * U(31) + b)


def _runs(codes: Codes, pairs: BitTable | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counted keys of each part: of pairs of frequent words or, given those that may be frequent, of longer phrases made of them. Pairs of
    numbered words are counted over several parts before they are sent."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def merged() -> Iterator[pa.RecordBatch]:
        if held:
            pair, n = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            pair, at = np.unique(pair, return_inverse=True)
            n = np.bincount(at, n).astype(np.int64)
            for k in range(0, len(pair), 1 << 17):
                some = pair[k : k + (1 << 17)].astype(">u8")
                yield pa.RecordBatch.from_arrays([_binary(some.view(np.uint8).reshape(-1, 8)), pa.array(n[k : k + (1 << 17)])], ["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            w = words(part)
            ok, code = codes.of(w.h)
            follows = np.zeros(len(code), bool)
            follows[:-1] = ok[:-1] & ok[1:] & (w.piece[:-1] == w.piece[1:])
            if pairs is None and codes.width == 4:
                at = np.flatnonzero(follows)
                held.append(np.unique(code[at] << U(32) | code[at + 1], return_counts=True))
                if sum(len(x) for x, _ in held) > HELD:
                    yield from merged()
                continue
            if pairs is not None:
                at = np.flatnonzero(follows)
                follows[at] = pairs.may_hold(_pair_hash(code[at], code[at + 1]))
            own = np.unique(code, return_inverse=True)[1].astype(U)
            start, rank, starts, sizes, counts = np.flatnonzero(follows), own, [], [], []
            for size in range(2, (2 if pairs is None else WORDS) + 1):
                if size > 2:  # all pairs within must follow one another
                    start = start[(start + size - 2 < len(follows))]
                    start = start[follows[start + size - 2]]
                _, first, inverse, n = np.unique((rank[start] << U(32)) | own[start + size - 1], return_index=True, return_inverse=True, return_counts=True)
                if pairs is None or size > 2:
                    starts.append(start[first])
                    sizes.append(np.full(len(first), size))
                    counts.append(n)
                rank = np.zeros(len(code), U)
                rank[start] = inverse
            start, size, n = (np.concatenate(x) for x in (starts, sizes, counts))
            keys = codes.keys(code, start, size, 2 if pairs is None else WORDS)
            for k in range(0, len(n), 1 << 17):
                yield pa.RecordBatch.from_arrays([keys[k : k + (1 << 17)], pa.array(n[k : k + (1 << 17)])], ["key", "n"])
        yield from merged()

    return run


def _sum_runs(width: int, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums of equal keys in sorted rows, without the zeros behind them, where ``least`` is reached."""

    def out(keys: list[bytes], sums: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sums, pa.int64())], ["key", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = b"", 0
        trim = lambda key: key[: width * int((np.frombuffer(key, f">u{width}") != 0).sum())]
        for batch in batches:
            if not batch.num_rows:
                continue
            col, n = batch.column("key"), batch.column("n").to_numpy()
            each = len(col[0].as_py())
            at = np.frombuffer(col.buffers()[1], np.int32)[col.offset]
            raw = np.frombuffer(col.buffers()[2], np.uint8)[at : at + each * len(col)].reshape(-1, each)
            first = np.flatnonzero(np.append(True, (raw[1:] != raw[:-1]).any(axis=1)))
            sums = np.add.reduceat(n, first).astype(np.int64)
            if raw[0].tobytes() == last:
                sums[0] += total
            elif total >= least:
                yield out([trim(last)], [total])
            last, total = raw[first[-1]].tobytes(), int(sums[-1])
            full = np.flatnonzero(sums[:-1] >= least)
            if len(full):
                yield out([trim(raw[i].tobytes()) for i in first[full]], sums[full].tolist())
        if total >= least:
            yield out([trim(last)], [total])

    return run


def _counted(texts: DataFrame, codes: Codes, pairs: BitTable | None, least: int) -> DataFrame:
    """(key, f) of the keys of all parts: parts are written, so that ranges are drawn without reading texts twice."""
    parts = materialise(texts.mapInArrow(_runs(codes, pairs), "key binary, n long"))
    return materialise(parts.repartitionByRange("key").sortWithinPartitions("key").mapInArrow(_sum_runs(codes.width, least), "key binary, f long"))


def phrases(docs: DataFrame, least: int = LEAST, first: int = FIRST, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``first`` phrases of each language by score, then count, then phrase.

    ``a`` counts a phrase of 2 to 5 words, ``l`` and ``r`` the two parts at its weakest cut, ``n`` all words of the language,
    null being ``und``; score is floor(1000 a n / (l r)), exactly. Phrases within a longer one that is as frequent are left out.
    Null texts are empty; repeated rows count as often as they stand there; other columns are not read; no texts give
    no rows. All counts are of all texts; a phrase that ties with others of a language in all of score and count stands in the order of its bytes."""
    texts = docs.select(F.col(text).alias("text"), F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"))
    counts = materialise(texts.mapInArrow(_count_words, "h long, lang string, word string, n long").groupBy("h", "lang", "word").agg(F.sum("n").alias("f")))
    totals = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    codes, single = coded(materialise(counts.where(F.col("f") >= least)))
    width = codes.width
    two = _counted(texts, codes, None, least)

    def pair_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = np.frombuffer(b"".join(batch.column("key").to_pylist()), f">u{width}").astype(U).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(signed(_pair_hash(code[:, 0], code[:, 1])))], ["h"])

    pairs = bit_table(materialise(two.mapInArrow(pair_hashes, "h long")), "h")
    all_ = two.unionByName(_counted(texts, codes, pairs, least))
    scored = _scored(all_, single, totals, width)
    return _best(_maximal(all_, scored, width), single, first, width)


def _size(width: int) -> Column:
    return (F.octet_length("key") / width).cast("int")


def _part(start: Column, size: Column, width: int) -> Column:
    return F.substring(F.col("key"), F.lit(1) + start * width, size * width)


def _scored(found: DataFrame, single: DataFrame, totals: DataFrame, width: int) -> DataFrame:
    known = found.unionByName(single.select("key", "f"))
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), _size(width) - 1)))
    cuts = cuts.withColumns({"left": _part(F.lit(0), F.col("k"), width), "right": _part(F.col("k"), _size(width) - F.col("k"), width), "word": _part(F.lit(0), F.lit(1), width)})
    cuts = cuts.join(known.select(F.col("key").alias("left"), F.col("f").alias("l")), "left").join(known.select(F.col("key").alias("right"), F.col("f").alias("r")), "right")
    cuts = cuts.join(single.select(F.col("key").alias("word"), "lang"), "word").join(totals, "lang")
    wide = lambda c: f"cast({c} as decimal(38, 0))"
    cuts = cuts.withColumn("score", F.expr(f"({wide(1000)} * f * n) div ({wide('l')} * r)"))
    return cuts.groupBy("key", "lang").agg(F.min(F.struct("score", "k", "l", "r", F.col("f").alias("a"), "n")).alias("x")).select("key", "lang", "x.score", "x.a", "x.l", "x.r", "x.n")


def _maximal(found: DataFrame, scored: DataFrame, width: int) -> DataFrame:
    """Without phrases that stand in a longer one which is as frequent."""
    size = _size(width)
    inner = found.where(size > 2).withColumn("m", F.explode(F.sequence(F.lit(2), size - 1))).withColumn("s", F.explode(F.sequence(F.lit(0), size - F.col("m"))))
    inner = inner.select(_part(F.col("s"), F.col("m"), width).alias("key"), "f").groupBy("key").agg(F.max("f").alias("within"))
    return scored.join(inner, "key", "left").where(F.col("within").isNull() | (F.col("within") * 100 < F.col("a") * 100)).drop("within")


def _best(scored: DataFrame, single: DataFrame, first: int, width: int) -> DataFrame:
    """The first of each part of a language, ties included, are spelled out; the first of these are the result."""
    order = [F.desc("score"), F.desc("a")]
    near = scored.withColumn("_part", F.pmod(F.xxhash64("key"), F.lit(64)))
    near = near.withColumn("_no", F.rank().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_no") <= first)
    near = materialise(near.drop("_part", "_no"))
    each = near.select("key", F.posexplode(F.transform(F.sequence(F.lit(0), _size(width) - 1), lambda i: _part(i, F.lit(1), width))).alias("at", "word_key"))
    spelled = each.join(single.select(F.col("key").alias("word_key"), "word"), "word_key").groupBy("key").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    spelled = spelled.select("key", F.array_join(F.col("w.word"), " ").alias("phrase"))
    out = near.join(spelled, "key").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")))
    return out.where(F.col("rank") <= first).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
