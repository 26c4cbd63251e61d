"""Toxicity behind a noisy channel: disguised words are restored before a text is scored.

A character trigram model counts all texts of the corpus. Tokens that look disguised (digits or signs
for letters, letters drawn out, letters set apart) span a lattice of what each character may stand for;
Viterbi picks the likeliest reading under the trigram model. A text's features are its words and their
beginnings, as written and as restored, each seen at least once, twice or four times; a logistic
regression over the features that tell the classes apart best is fitted on labelled rows. Labels, language, source and id never enter a score.

The classifier learns from at most ``SAMPLE`` labelled rows, those of least id hash; all else covers every
row and whole texts, very long ones in parts of their own. Null or empty texts score as a text without
features, equal texts alike. A label given several times counts once, as toxic if any says so; of rows that
repeat a labelled id, the one whose text has the least hash is learnt from. Without labelled rows every score is 0; with labels of one class only, the
smoothed share of that class decides. An empty table gives no rows. A column of the score's name is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from voxelmill.llm.storage import materialise
from voxelmill.llm.text import U, by_size, flat, lowered, mix, prefix_hash, signed, span_hash, word_spans

SAMPLE, VOCABULARY, LEAST_ROWS = 20_000, 4096, 5
LEVELS = (1, 2, 4)
BEGINNINGS = (4, 5, 6, 7, 8)
LETTERS = 28  # a to z, any other letter, no letter

#: What a character may stand for, besides itself.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "il", "|": "il", "€": "e", "+": "t"}
APART = " ._*-"
#: Signs at a token's end that are punctuation rather than letters, and what it costs to drop another sign.
ENDING, DROPPED = "!|+.,;:?#%&*\"')]}", 5.0
#: Longer tokens are several words, or codes.
LONGEST = 40

_CODE = np.full(256, 27, np.int64)
_CODE[97:123] = np.arange(26)
_CODE[128:] = 26
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = True
_SIGN = np.zeros(256, bool)
_SIGN[[ord(c) for c in LEET if ord(c) < 128]] = True
_ENDING = np.zeros(256, bool)
_ENDING[[ord(c) for c in ENDING]] = True
_APART = np.zeros(256, bool)
_APART[[ord(c) for c in APART]] = True
#: What a long token is cut into; hex numbers, which have digits that stand for no letter; letters set apart.
_PIECE = re.compile(rb"[a-z0-9@$!|+\x80-\xff]+")
_HEX = re.compile(rb"(?=.*[269])[0-9a-f]+")
_SET_APART = re.compile(f"(?:[^{APART}][{APART}])+[^{APART}]")


# ---------------------------------------------------------------- the character model


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts over all texts, LETTERS**3 of them; every partition sends its own counts once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS**3, np.int64)
        for whole in batches:
            for batch in by_size(whole, text_col):
                buf, _ = flat(lowered(batch.column(0)))
                c = _CODE[buf]
                c = c[(c != 26) | np.append(True, c[:-1] != 26)] if len(c) else c
                if len(c) > 2:
                    total += np.bincount((c[:-2] * LETTERS + c[1:-1]) * LETTERS + c[2:], minlength=LETTERS**3)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    rows = docs.select(text_col).mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(LETTERS**3)
    for gram, n in rows:
        out[gram] = n
    return out


def language_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b), interpolated with P(c | b) and P(c)."""
    c3 = counts.reshape(LETTERS, LETTERS, LETTERS)
    c2, c1 = c3.sum(0), c3.sum((0, 1))
    p1 = (c1 + 1) / (c1.sum() + LETTERS)
    p2 = (c2 + 4 * p1) / (c2.sum(1, keepdims=True) + 4)
    return np.log((c3 + 4 * p2) / (c3.sum(2, keepdims=True) + 4))


# ---------------------------------------------------------------- decoding


def readings(token: str) -> list[tuple[tuple[str, float], ...]]:
    """The lattice of a token: for each run of one character, the strings it may stand for and their cost."""
    out, i = [], 0
    token = token.rstrip(ENDING)
    while i < len(token):
        c, j = token[i], i + 1
        while j < len(token) and token[j] == c:
            j += 1
        n, i = j - i, j
        letters = [(c, 0.0)] if c.isalpha() else []
        stands = LEET.get(c, "")
        letters += [(x, 0.7 + 0.1 * k) for k, x in enumerate(stands)]
        if not letters:
            if c not in APART:
                out.append(((" ", 0.0),))
            continue
        options = []
        for x, cost in letters:
            options.append((x, cost + (1.0 if n == 2 else 0.0)))
            if n > 1:
                options.append((x * 2, cost + (0.0 if n == 2 else 1.0)))
        if not c.isalpha():
            options.append(("", DROPPED * n))
        out.append(tuple(options))
    return out


def _number(c: str) -> int:
    return ord(c) - 97 if "a" <= c <= "z" else 26 if c.isalpha() else 27


def restore(token: str, model: np.ndarray) -> str:
    """The likeliest reading of a token."""
    return likeliest(readings(token), model)


def parted(text: str, model: np.ndarray) -> str:
    """A text without spaces, with the likeliest ones; letters set apart do not show where words end."""
    return likeliest([x for c in text for x in (((c, 0.0),), (("", 0.0), (" ", 0.0)))][:-1], model)


def likeliest(lattice: list[tuple[tuple[str, float], ...]], model: np.ndarray) -> str:
    """Viterbi over a lattice; states are the last two letters, and texts are chains of pieces."""
    best: dict[tuple[int, int], tuple[float, tuple]] = {(27, 27): (0.0, ())}
    for options in lattice:
        new: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (score, text) in best.items():
            for piece, cost in options:
                x, y, s = a, b, score - cost
                for c in piece:
                    z = _number(c)
                    s += model[x, y, z]
                    x, y = y, z
                if (x, y) not in new or new[x, y][0] < s:
                    new[x, y] = (s, (text, piece) if piece else text)
        best = new
    return max(((s + model[a, b, 27], _text(t)) for (a, b), (s, t) in best.items()), default=(0.0, ""))[1]


def _text(chain: tuple) -> str:
    out = []
    while chain:
        chain, piece = chain
        out.append(piece)
    return "".join(reversed(out))


def suspects(buf: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int]]:
    """(text, start, end) of tokens that may be disguised, in lower-cased bytes.

    A sign or digit next to a letter (punctuation after one does not count), a letter three times, or single
    characters set apart by one sign each: four, or three if the sign is not always a space. Of tokens
    longer than ``LONGEST`` the pieces between other signs are judged; hex numbers of that length, told by
    digits that stand for no letter, are codes rather than words."""
    n = len(buf)
    if n < 3:
        return []
    letter, sign = _LETTER[buf], _SIGN[buf]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    joint = ~edge[1:-1]
    mark = np.zeros(n, bool)
    mark[:-1] |= sign[:-1] & letter[1:] & joint
    mark[1:] |= (sign & ~_ENDING[buf])[1:] & letter[:-1] & joint
    mark[:-2] |= letter[:-2] & (buf[:-2] == buf[1:-1]) & (buf[1:-1] == buf[2:]) & joint[:-1] & joint[1:]
    euro = np.flatnonzero((buf[:-2] == 0xE2) & (buf[1:-1] == 0x82) & (buf[2:] == 0xAC))
    if len(euro):
        near = lambda at, side: letter[np.clip(at, 0, n - 1)] & ~edge[side]
        mark[euro[near(euro - 1, euro) | near(euro + 3, euro + 3)]] = True
    start, end, doc = word_spans(buf, offsets, np.arange(256) > 32)
    out = []
    for k in np.unique(np.searchsorted(start, np.flatnonzero(mark), "right") - 1).tolist():
        d, a, b = int(doc[k]), int(start[k]), int(end[k])
        if b - a <= LONGEST:
            out.append((d, a, b))
            continue
        for piece in _PIECE.finditer(buf[a:b].tobytes()):
            x, y = a + piece.start(), a + piece.end()
            if mark[x:y].any() and not (y - x > LONGEST and _HEX.fullmatch(piece[0])):
                out.append((d, x, y))
    solid = letter | sign | (buf >= 128)
    alone = solid & ~(np.append(False, solid[:-1]) & ~edge[:-1]) & ~(np.append(solid[1:], False) & ~edge[1:])
    gap = _APART[buf]
    at = np.flatnonzero(alone[:-2] & gap[1:-1] & alone[2:] & joint[:-1] & joint[1:])
    for group in np.split(at, np.flatnonzero(np.diff(at) != 2) + 1) if len(at) else []:
        a, b = int(group[0]), int(group[-1]) + 3
        if len(group) > 2 or len(group) == 2 and letter[a:b].any() and (buf[group + 1] != 32).any():
            out.append((int(np.searchsorted(offsets, a, "right") - 1), a, b))
    return out


# ---------------------------------------------------------------- features


def _features(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start, end, doc = word_spans(buf, offsets)
    c = prefix_hash(buf, 4)
    out, owner = [span_hash(c, start, end)], [doc]
    for k in BEGINNINGS:
        some = np.flatnonzero(end - start > k)
        out.append(mix(span_hash(c, start[some], start[some] + k) + U(k)))
        owner.append(doc[some])
    return np.concatenate(out), np.concatenate(owner)


def features(column: pa.Array, model: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Feature hashes and text numbers: as written, then as restored."""
    buf, offsets = flat(lowered(column))
    yield _features(buf, offsets)
    known: dict[str, str] = {}
    words: list[tuple[int, str]] = []
    for d, a, b in suspects(buf, offsets):
        token = buf[a:b].tobytes().decode("utf-8", "ignore")
        if token not in known:
            known[token] = restore(token, model)
            if _SET_APART.fullmatch(token):
                words_of = parted(known[token], model)
                known[token] += f" {words_of}" if " " in words_of else ""
        if known[token] != token:
            words.append((d, known[token]))
    if words:
        col = pa.array([w for _, w in words], pa.large_string())
        h, owner = _features(*flat(col))
        yield h, np.array([d for d, _ in words], np.int64)[owner]


# ---------------------------------------------------------------- the classifier


@dataclass
class Classifier:
    """``vocabulary``: sorted hashes; ``weights``: hash times level; ``quick``: which top bits of a hash
    can be in the vocabulary at all."""

    language: np.ndarray
    vocabulary: np.ndarray
    weights: np.ndarray
    bias: float
    quick: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.quick = np.zeros(1 << 18, bool)
        self.quick[(self.vocabulary >> U(46)).astype(np.int64)] = True

    def present(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash times level) once each, for the vocabulary's hashes seen that often."""
        n, found = len(self.vocabulary), [np.zeros(0, np.int64)]
        for h, owner in features(column, self.language):
            some = np.flatnonzero(self.quick[(h >> U(46)).astype(np.int64)])
            h, owner = h[some], owner[some]
            at = np.minimum(np.searchsorted(self.vocabulary, h), max(n - 1, 0))
            ok = self.vocabulary[at] == h if n else np.zeros(len(h), bool)
            found.append(owner[ok] * max(n, 1) + at[ok])
        pairs, times = np.unique(np.concatenate(found), return_counts=True)
        doc, at = pairs // max(n, 1), pairs % max(n, 1)
        doc, at = (np.concatenate([x[times >= level] for level in LEVELS]) for x in (doc, at * len(LEVELS)))
        at += np.repeat(np.arange(len(LEVELS)), [(times >= level).sum() for level in LEVELS])
        order = np.argsort(doc, kind="stable")
        return doc[order], at[order]

    def scores(self, column: pa.Array) -> np.ndarray:
        doc, feature = self.present(column)
        z = self.bias + np.bincount(doc, self.weights[feature] if len(feature) else None, minlength=len(column))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label: str, sample: int) -> DataFrame:
    """text, toxic of at most ``sample`` labelled rows outside the held-out fold: one row of each of so many ids."""
    some = (
        labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & ~held_out(id_col))
        .groupBy(id_col).agg(F.max(label).cast("int").alias("_toxic"))
        .orderBy(F.xxhash64(id_col), id_col).limit(sample)
    )
    rows = docs.select(id_col, F.col(text_col).alias("_text")).join(F.broadcast(some), id_col)
    return rows.groupBy(id_col, "_toxic").agg(F.min_by("_text", F.xxhash64("_text")).alias("_text")).select("_text", "_toxic")


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Classifier:
    language = language_model(trigram_counts(docs, text_col))
    rows = materialise(labelled(docs, labels, id_col, text_col, label, sample))
    share = {r["_toxic"]: r["n"] for r in rows.groupBy("_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, total = share.get(1, 0), sum(share.values())
    none = Classifier(language, np.zeros(0, U), np.zeros(0), -30.0 if not total else float(np.log((bad + 0.5) / (total - bad + 0.5))))
    if not bad or bad == total:
        return none

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(whole, "_text"):
                toxic = batch.column("_toxic").to_numpy()
                got = list(features(batch.column("_text"), language))
                h, owner = np.concatenate([g[0] for g in got]), np.concatenate([g[1] for g in got])
                order = np.lexsort((owner, h))
                h, owner = h[order], owner[order]
                once = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (owner[1:] != owner[:-1]))) if len(h) else np.zeros(0, np.int64)
                times = np.diff(np.append(once, len(h)))
                h, mark = h[once], toxic[owner[once]]
                for level in LEVELS:
                    k, m = h[times >= level], mark[times >= level].astype(np.int64)
                    first = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
                    n = np.diff(np.append(first, len(k)))
                    t = np.add.reduceat(m, first) if len(k) else n
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(signed(k[first])), pa.array(np.full(len(n), level, np.int32)), pa.array(n.astype(np.int64)), pa.array(t.astype(np.int64))], ["h", "level", "n", "t"]
                    )

    counted = rows.mapInArrow(count, "h long, level int, n long, t long").groupBy("h", "level").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    told = _gain(F.col("t"), F.col("n"), bad, total)
    chosen = counted.where(F.col("n") >= LEAST_ROWS).withColumn("gain", told).orderBy(F.desc("gain"), "h", "level").limit(VOCABULARY).select("h", "level").collect()
    vocabulary = np.unique(np.array([r[0] for r in chosen], np.int64).view(U))
    model = Classifier(language, vocabulary, np.zeros(len(vocabulary) * len(LEVELS)), 0.0)
    if not len(vocabulary):
        return none

    used = np.zeros(len(model.weights), bool)
    used[np.searchsorted(vocabulary, np.array([r[0] for r in chosen], np.int64).view(U)) * len(LEVELS) + [LEVELS.index(r[1]) for r in chosen]] = True
    number = (np.cumsum(used) - 1).astype(np.uint16)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(whole, "_text"):
                doc, feature = model.present(batch.column("_text"))
                doc, feature = doc[used[feature]], number[feature[used[feature]]]
                cuts = np.searchsorted(doc, np.arange(len(batch) + 1)) * feature.itemsize
                lists = pa.BinaryArray.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(feature.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column("_toxic"), lists], ["toxic", "found"])

    # two bytes for each chosen feature that a row has, of ``sample`` rows and ``VOCABULARY`` features at most
    got = rows.mapInArrow(find, "toxic int, found binary").toArrow()
    lists = got.column("found")
    owner = np.repeat(np.arange(len(lists), dtype=np.int32), pc.binary_length(lists).to_numpy() // 2)
    feature = np.frombuffer(b"".join(x.as_py() for x in lists), np.uint16).astype(np.int32)
    weights, model.bias = regression(owner, feature, got.column("toxic").to_numpy().astype(float), int(used.sum()))
    model.weights[used] = weights
    return model


def _gain(t: Column, n: Column, bad: int, total: int) -> Column:
    """How much a feature tells of the class: the G statistic of its two-by-two table."""
    cell = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
    good, p = total - bad, F.lit(bad / total)
    return cell(t, n * p) + cell(n - t, n * (1 - p)) + cell(bad - t, (total - n) * p) + cell(good - (n - t), (total - n) * (1 - p))


def regression(owner: np.ndarray, feature: np.ndarray, y: np.ndarray, n: int, decay: float = 2.0, epochs: int = 300, rate: float = 0.3) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge, by AdaGrad over all rows at once: row ``owner[i]`` of ``y`` has
    ``feature[i]``."""
    w, bias = np.zeros(n), float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)))
    sums, sum_b = np.full(n, 1e-8), 1e-8
    for _ in range(epochs):
        z = bias + np.bincount(owner, w[feature], minlength=len(y))
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / len(y)
        g = np.bincount(feature, err[owner], minlength=n) + decay * w / len(y)
        sums += g * g
        w -= rate * g / np.sqrt(sums)
        gb = err.sum()
        sum_b += gb * gb
        bias -= rate * gb / np.sqrt(sum_b)
    return w, bias


def score(docs: DataFrame, model: Classifier, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a column ``out``; one that has this name already is replaced."""
    docs = docs.drop(out)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in by_size(whole, text_col):
                s = model.scores(batch.column(text_col))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], [*batch.schema.names, out])

    return docs.mapInArrow(judge, StructType([*docs.schema.fields, StructField(out, DoubleType())]))
