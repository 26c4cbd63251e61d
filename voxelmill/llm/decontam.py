"""Benchmark questions in documents, re-parameterised ones included.

Texts are canonicalised into templates: numbers, names and units become typed placeholders and all else
is lower-cased words. Windows of five template words are joined by hash, the benchmark's against every
document's; hits that keep their order relative to a question are aligned with it. A question counts as
found where at least 0.8 of its windows, or a stretch of 25 words, stand in one place of the document
and the placeholders' values there can be mapped one to one onto the question's: the same number in the
question is always the same number in the document. Where the mapping fails, only windows without
placeholders count. A question of fewer than five words that aren't placeholders says too little by its
template: it must stand there with its own values.

Names are told by capitals within a sentence, which upper-cased documents lack; so every text is
canonicalised twice, with names and without, and either may match. The benchmark's hash table is sent to
all tasks, in blocks made of at most ``BLOCK_BYTES`` of questions; more blocks mean more passes over the
documents, never a larger broadcast.

Null, empty and wordless texts and questions match nothing; texts and questions are read whole, however
long. Repeated questions are found together; an item without an id counts, as a null that stands last in
``items``. Questions that tie are all returned. An empty benchmark finds nothing, an empty table gives no
rows. Only the id, the text and the item columns are read.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from voxelmill.llm.storage import materialise
from voxelmill.llm.text import U, by_size, flat, lowered, mix, prefix_hash, span_hash, word_spans

WINDOW, SHARE, STRETCH, DRIFT = 5, 0.8, 25, 4
BLOCK_BYTES = 8 << 20

#: Words that are units after a number, and number words.
UNITS = "mm cm m km in ft yd mi mile miles inch inches feet foot yards meter meters metre metres g kg mg lb lbs oz gram grams pound pounds ton tons s sec second seconds min minute minutes h hour hours day days week weeks month months year years l ml liter liters litre litres gallon gallons usd eur dollar dollars cent cents euro euros percent mph kmh degrees celsius fahrenheit k w kw watt watts volt volts".split()
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million".split()

WORD_, NUM, NAME, UNIT = range(4)
_WITHIN = np.zeros(256, bool)
_WITHIN[[ord(c) for c in ",;)(\"'"]] = True
_SIGN = mix(np.arange(1, 5, dtype=U) * U(0xC2B2AE3D27D4EB4F))


def _hashes(words: list[str]) -> np.ndarray:
    buf, offsets = flat(pa.array(words, pa.large_string()))
    return np.sort(span_hash(prefix_hash(buf), offsets[:-1], offsets[1:]))


_UNIT_HASHES, _NUMBER_HASHES = _hashes(UNITS), _hashes(NUMBERS)


def _among(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    return table[np.minimum(np.searchsorted(table, h), len(table) - 1)] == h


@dataclass
class Template:
    """Of all texts of a column, behind one another: the hash of each word's value, its kind, its text."""

    value: np.ndarray
    kind: np.ndarray
    doc: np.ndarray

    def words(self, names: bool) -> np.ndarray:
        slot = (self.kind != WORD_) & (names | (self.kind != NAME))
        return np.where(slot, _SIGN[self.kind], self.value)

    def slots(self, names: bool) -> np.ndarray:
        return (self.kind != WORD_) & (names | (self.kind != NAME))


def canonical(column: pa.Array) -> Template:
    buf, offsets = flat(column)
    low, low_offsets = flat(lowered(column))
    start, end, doc = word_spans(buf, offsets)
    low_start, low_end, low_doc = word_spans(low, low_offsets)
    value = span_hash(prefix_hash(low), low_start, low_end)
    if len(low_start) != len(start) or not (low_doc == doc).all():  # a letter whose lower case has other bytes of a word
        return Template(value, np.zeros(len(value), np.int8), low_doc)
    kind = np.zeros(len(start), np.int8)
    if not len(start):
        return Template(value, kind, doc)
    digit = (buf >= 48) & (buf < 58)
    many = np.concatenate(([0], np.cumsum(digit)))
    number = (many[end] - many[start] == end - start) | _among(value, _NUMBER_HASHES)
    kind[number] = NUM
    before, gap = np.append(False, doc[1:] == doc[:-1]), np.append(0, start[1:] - end[:-1])
    kind[np.append(False, number[:-1]) & before & _among(value, _UNIT_HASHES)] = UNIT
    first, second = buf[start], buf[np.minimum(start + 1, end - 1)]
    latin = (first == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
    after = np.where(latin, buf[np.minimum(start + 2, end - 1)], second)
    capital = (((first >= 65) & (first < 91)) | latin) & ((after >= 97) & (after < 123) | (after >= 128)) & (end - start > 2)
    # one space, or a sign that doesn't end a sentence and a space
    inside = before & (buf[np.maximum(start - 1, 0)] == 32) & ((gap == 1) | (gap == 2) & _WITHIN[buf[np.maximum(start - 2, 0)]])
    kind[capital & inside & (kind == WORD_)] = NAME
    # digits joined by a point or comma are one number
    joined = before & (gap == 1) & np.isin(buf[np.maximum(start - 1, 0)], (44, 46)) & (kind == NUM) & np.append(False, kind[:-1] == NUM)
    if joined.any():
        whole = np.cumsum(~joined) - 1
        value = mix(np.bincount(whole, minlength=whole[-1] + 1).astype(U) * U(3) + np.add.reduceat(value, np.flatnonzero(~joined)))
        kind, doc = kind[~joined], doc[~joined]
        single = np.bincount(whole) == 1
        value[single] = span_hash(prefix_hash(low), low_start[~joined][single], low_end[~joined][single])
    return Template(value, kind, doc)


def windows(words: np.ndarray, doc: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every window within a text."""
    at = np.arange(max(0, len(words) - size + 1))
    at = at[doc[at] == doc[at + size - 1]]
    h = np.zeros(len(at), U)
    for k in range(size):
        h = mix(h * U(31) + words[at + k])
    return h, at


@dataclass
class Block:
    """The hash table of a block of questions, in flat arrays. Questions with equal templates and values
    share a number; ``ids`` has their item ids. Of question k, ``values``, ``slots`` and ``windows`` begin at
    ``start[k]``; ``windows`` has the place of each window in ``hashes``. What stands at place i of ``hashes``
    are the windows ``question[cut[i]:cut[i + 1]]``, ``at[...]``. ``short`` has the questions without a whole
    window: by length, hashes of all their words in order, and the questions. Of those marked ``literal``, only
    windows with equal values count."""

    ids: list[list]
    start: np.ndarray
    size: np.ndarray
    values: np.ndarray
    slots: np.ndarray
    windows: np.ndarray
    hashes: np.ndarray
    cut: np.ndarray
    question: np.ndarray
    at: np.ndarray
    quick: np.ndarray
    literal: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    def need(self, share: float) -> np.ndarray:
        """So many windows of each question have to be met, for a share of it or a long stretch."""
        return np.minimum(np.ceil(share * (self.size - WINDOW + 1) - 1e-9), STRETCH - WINDOW + 1)


def block(items: list[tuple], names: bool) -> Block:
    t = canonical(pa.array([text or "" for _, text in items], pa.large_string()))
    words, number, ids = t.words(names), {}, []
    cuts = np.searchsorted(t.doc, np.arange(len(items) + 1))
    of, start, size = np.full(len(items) + 1, -1), [], []
    for n, ((item, _), a, b) in enumerate(zip(items, cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
        if a == b:
            continue
        k = number.setdefault(hashlib.blake2b(words[a:b].tobytes() + t.value[a:b].tobytes(), digest_size=16).digest(), len(ids))
        if k < len(ids):
            ids[k].append(item)
            continue
        ids.append([item])
        start.append(a)
        size.append(b - a)
        of[n] = k
    first, length = np.array(start, np.int64), np.array(size, np.int64)
    h, at = windows(words, t.doc)
    own = of[t.doc[at]] >= 0
    h, at = h[own], at[own]
    question = of[t.doc[at]]
    order = np.argsort(h, kind="stable")
    hashes, place, counts = np.unique(h, return_inverse=True, return_counts=True)
    index = np.full(len(words), -1, np.int32)
    index[at] = place
    quick = np.zeros(1 << 20, bool)
    quick[(hashes >> U(44)).astype(np.int64)] = True
    short = {}
    for n in range(1, WINDOW):
        g, x = windows(t.value, t.doc, n)
        k = of[t.doc[x]]
        some = np.flatnonzero((k >= 0) & (length[k] == n)) if len(k) else np.zeros(0, np.int64)
        if len(some):
            some = some[np.argsort(g[some], kind="stable")]
            short[n] = (g[some], k[some])
    slots = t.slots(names)
    plain = np.append(0, np.cumsum(~slots))
    literal = plain[first + length] - plain[first] < WINDOW
    return Block(
        ids, first, length, t.value, slots, index, hashes, np.append(0, np.cumsum(counts)), question[order].astype(np.int32),
        (at - first[question])[order].astype(np.int32) if len(at) else at.astype(np.int32), quick, literal, short,
    )


def consistent(ours: np.ndarray, theirs: np.ndarray) -> bool:
    """Whether values map one to one."""
    pairs = len({*zip(ours.tolist(), theirs.tolist(), strict=True)})
    return pairs == len({*ours.tolist()}) == len({*theirs.tolist()})


_STEPS = np.arange(WINDOW)


def judge(b: Block, k: int, d: np.ndarray, q: np.ndarray, values: np.ndarray, share: float = SHARE) -> float:
    """The share of question k found at one place of a text, 1.0 for a long stretch; d, q: places of equal
    windows in the text and in the question. Below ``share``, any lesser number may be returned.

    Windows are laid on the lines d - q. A line whose own values don't map one to one is known after a few
    of its words, so a text of nothing but numbers costs little more than its hits."""
    n = int(b.size[k]) - WINDOW + 1
    base = int(b.start[k])
    ours, slot = b.values[base : base + n + WINDOW - 1], b.slots[base : base + n + WINDOW - 1]
    plain = ~np.lib.stride_tricks.sliding_window_view(slot, WINDOW).any(1)
    if b.literal[k]:
        for j in range(WINDOW):
            same = values[d + j] == ours[q + j]
            d, q = d[same], q[same]
        if not len(d):
            return 0.0
    order = np.lexsort((q, d - q))
    d, q = d[order], q[order]
    begin = np.flatnonzero(np.append(True, np.diff(d - q) != 0))
    lines, stop = (d - q)[begin], np.append(begin[1:], len(d))
    low, high = np.searchsorted(lines, lines - DRIFT), np.searchsorted(lines, lines + DRIFT, "right") - 1
    near = stop[high] - begin[low]
    count = stop - begin
    best = 0.0
    some = np.flatnonzero((near >= share * n - 1e-9) | (count + WINDOW - 1 >= STRETCH))
    for i in some[np.argsort(-count[some], kind="stable")].tolist():
        if best >= 1.0:
            break
        a, z = int(begin[i]), int(stop[i])
        if best and near[i] / n <= best and z - a + WINDOW - 1 < STRETCH:
            continue
        if mapped(ours, slot, q[a : min(z, a + 8)], d[a : min(z, a + 8)], values) and mapped(ours, slot, q[a:z], d[a:z], values):
            x, y = int(begin[low[i]]), int(stop[high[i]])
            own = agreeing(ours, slot, plain, int(lines[i]), d[x:y], q[x:y], values)
        else:
            own = slice(int(begin[low[i]]), int(stop[high[i]]))
            own = [(u, v) for u, v in zip(d[own].tolist(), q[own].tolist(), strict=True) if plain[v]] if plain.any() else []
        found = len({v for _, v in own}) / n
        straight = sorted(v for u, v in own if u - v == lines[i])
        run = longest = 0
        for j, v in enumerate(straight):
            run = run + 1 if j and v == straight[j - 1] + 1 else 1
            longest = max(longest, run)
        best = max(best, 1.0 if longest and longest + WINDOW - 1 >= STRETCH else found)
    return best


def mapped(ours: np.ndarray, slot: np.ndarray, q: np.ndarray, d: np.ndarray, values: np.ndarray) -> bool:
    """Whether the values under the windows map one to one."""
    sides = np.unique(((q[:, None] + _STEPS) << 40 | d[:, None] + _STEPS).ravel())
    i, j = sides >> 40, sides & (1 << 40) - 1
    some = slot[i]
    return consistent(ours[i[some]], values[j[some]])


def agreeing(ours: np.ndarray, slot: np.ndarray, plain: np.ndarray, line: int, d: np.ndarray, q: np.ndarray, values: np.ndarray) -> list[tuple[int, int]]:
    """The hits on and near a line, whose own values map one to one, that agree with it; without such a
    mapping, those without slots.

    A template that repeats with a short period equals itself on several lines. So the line itself decides
    first; of the others, hits that take a word of either side for another one than before are left out
    unless their values are mapped so already."""
    own = list(zip(d.tolist(), q.tolist(), strict=True))
    if mapped(ours, slot, q, d, values):
        return own
    by_line: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for u, v in own:
        by_line[u - v].append((u, v))
    there, back, to, fro, out = {}, {}, {}, {}, []
    for x in sorted(by_line, key=lambda x: (x != line, -len(by_line[x]), abs(x - line))):
        for u, v in by_line[x]:
            places = [(v + j, u + j) for j in range(WINDOW) if slot[v + j]]
            pairs = [(int(ours[i]), int(values[j])) for i, j in places]
            if any(to.get(v1, w) != w or fro.get(w, v1) != v1 for v1, w in pairs) or len({*pairs}) > min(len({v1 for v1, _ in pairs}), len({w for _, w in pairs})):
                if not any(there.get(i, j) != j or back.get(j, i) != i for i, j in places):
                    return [(u1, v1) for u1, v1 in own if plain[v1]]  # no other line explains these words
                continue
            if any(there.get(i, j) != j or back.get(j, i) != i for i, j in places) and any(v1 not in to for v1, _ in pairs):
                continue
            out.append((u, v))
            for (i, j), (v1, w) in zip(places, pairs, strict=True):
                there.setdefault(i, j), back.setdefault(j, i)
                to[v1], fro[w] = w, v1
    return out


#: So many hits are laid out at once; a text with more is judged one question at a time.
HITS = 1 << 22


def matches(b: Block, t: Template, names: bool, texts: int, share: float) -> list[dict[int, float]]:
    """Per text: the found questions' numbers and shares."""
    out: list[dict[int, float]] = [{} for _ in range(texts)]
    h, at = windows(t.words(names), t.doc)
    some = np.flatnonzero(b.quick[(h >> U(44)).astype(np.int64)]) if len(b.hashes) else np.zeros(0, np.int64)
    h, at = h[some], at[some]
    i = np.minimum(np.searchsorted(b.hashes, h), len(b.hashes) - 1)
    ok = b.hashes[i] == h if len(h) else np.zeros(0, bool)
    i, at, need = i[ok], at[ok], b.need(share)
    many = (b.cut[i + 1] - b.cut[i]).astype(np.int64)
    total = np.append(0, np.cumsum(many))
    begin = 0
    while begin < len(at):
        # as many whole texts as fit
        end = max(int(np.searchsorted(total, total[begin] + HITS, "right")) - 1, begin + 1)
        last = t.doc[at[end - 1]]
        if end < len(at) and t.doc[at[end]] == last:
            cut = int(np.searchsorted(t.doc[at], last))
            end = cut if cut > begin else int(np.searchsorted(t.doc[at], last, "right"))
        part = slice(begin, end)
        if total[end] - total[begin] <= HITS:
            d = np.repeat(at[part], many[part])
            x = np.arange(len(d)) - np.repeat(total[begin:end] - total[begin], many[part]) + np.repeat(b.cut[i[part]], many[part])
            k, q, doc = b.question[x].astype(np.int64), b.at[x].astype(np.int64), t.doc[d]
            key = doc * len(b.ids) + k
            order = np.argsort(key, kind="stable")
            cuts = np.flatnonzero(np.append(True, np.diff(key[order]) != 0))
            stops = np.append(cuts[1:], len(order))
            for a, z in zip(cuts.tolist(), stops.tolist(), strict=True):
                own = order[a:z]
                one = int(k[own[0]])
                if z - a >= need[one]:
                    s = judge(b, one, d[own], q[own], t.value, share)
                    if s >= share:
                        out[int(doc[own[0]])][one] = s
        else:  # one text: for each question, the places of its windows
            order = np.argsort(i[part], kind="stable")
            found, where = i[part][order], at[part][order]
            for one in np.flatnonzero(b.size >= WINDOW).tolist():
                own = b.windows[b.start[one] : b.start[one] + b.size[one] - WINDOW + 1].astype(np.int64)
                a, z = np.searchsorted(found, own), np.searchsorted(found, own, "right")
                if (z - a).sum() >= need[one]:
                    q = np.repeat(np.arange(len(own)), z - a)
                    d = where[np.arange(len(q)) - np.repeat(np.cumsum(z - a) - (z - a), z - a) + np.repeat(a, z - a)]
                    s = judge(b, one, d, q, t.value, share)
                    if s >= share:
                        out[int(t.doc[d[0]])][one] = s
        begin = end
    for size, (wanted, questions) in b.short.items():
        h, at = windows(t.value, t.doc, size)
        for j in np.flatnonzero(_among(h, wanted)).tolist() if len(h) else []:
            for k in questions[np.searchsorted(wanted, h[j]) : np.searchsorted(wanted, h[j], "right")].tolist():
                out[int(t.doc[at[j]])][k] = 1.0
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", share: float = SHARE) -> DataFrame:
    """One row per row of docs: the id column, contaminated, items (sorted), share (the largest)."""
    questions = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).alias("text"))
    total = questions.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = int(-(-total // BLOCK_BYTES)) or 1
    kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType
    lists = pa.list_(to_arrow_type(item_kind))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    if blocks > 1:
        rows = materialise(rows)  # rows must have the same number in every pass
    found = []
    for no in range(blocks):
        items = [(r[0], r[1]) for r in questions.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == no).collect()]
        tables = docs.sparkSession.sparkContext.broadcast([(names, block(items, names)) for names in (False, True)])

        def scan(batches: Iterator[pa.RecordBatch], tables=tables) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in by_size(whole, "text"):
                    t = canonical(batch.column("text"))
                    ids: list[dict] = [{} for _ in range(len(batch))]
                    for names, b in tables.value:
                        for own, got in zip(ids, matches(b, t, names, len(batch), share), strict=True):
                            for k, s in got.items():
                                for item in b.ids[k]:
                                    own[item] = max(s, own.get(item, 0.0))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id"), batch.column("row"), pa.array([sorted(x, key=lambda i: (i is None, i)) for x in ids], lists), pa.array([max(x.values(), default=0.0) for x in ids], pa.float64())],
                        ["id", "row", "items", "share"],
                    )

        part = rows.mapInArrow(scan, f"id {kind}, row long, items array<{item_kind.simpleString()}>, share double")
        if blocks > 1:  # one block at a time is in memory
            part = materialise(part.where(F.size("items") > 0))
            tables.destroy()
        found.append(part)
    out = found[0]
    if blocks > 1:
        hits = reduce(DataFrame.unionByName, found).groupBy("row").agg(F.array_sort(F.flatten(F.collect_list("items"))).alias("items"), F.max("share").alias("share"))
        none = F.array().cast(f"array<{item_kind.simpleString()}>")
        out = rows.select("id", "row").join(hits, "row", "left").select("id", F.coalesce("items", none).alias("items"), F.coalesce("share", F.lit(0.0)).alias("share"))
    return out.select(F.col("id").alias(id_col), (F.size("items") > 0).alias("contaminated"), "items", "share")
