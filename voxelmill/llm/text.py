"""Whole batches of text as numpy byte arrays: slicing by size, words, rolling and window hashes.

Texts stay in the Arrow buffer they came in; words are found with byte tables and hashed by prefix
sums of a polynomial modulo 2**64, so the cost per byte is a few array passes and no Python loop."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

#: Bytes of a word: ASCII letters, digits, the underscore and every byte of a non-ASCII character.
WORD = np.zeros(256, bool)
for _a, _b in ((48, 58), (65, 91), (95, 96), (97, 123), (128, 256)):
    WORD[_a:_b] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


@lru_cache(2)
def _byte_codes(seed: int) -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(0xD6E8FEB86659FD93) + U(seed))


@lru_cache(4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    p, q = np.full(n, _BASE, U), np.full(n, _BASE_INV, U)
    p[0] = q[0] = 1
    return np.multiply.accumulate(p), np.multiply.accumulate(q)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    p, q = _powers(1 << max(18, int(n - 1).bit_length()))
    return p[:n], q[:n]


def prefix_hash(buf: np.ndarray, seed: int = 0) -> np.ndarray:
    """c with c[i] = hash of buf[:i]; ``span_hash`` takes differences of it."""
    out = np.zeros(len(buf) + 1, U)
    np.cumsum(_byte_codes(seed)[buf] * powers(len(buf) + 1)[0][: len(buf)], out=out[1:])
    return out


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte strings [start, end); equal strings have equal hashes wherever they stand."""
    return mix((c[end] - c[start]) * powers(len(c))[1][start] + (end - start).astype(U) * U(0xA24BAED4963EE407))


def by_size(batch: pa.RecordBatch, column: str, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text; a longer single text makes a part of its own."""
    col = batch.column(column)
    ends = np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + most, "right")))
        yield batch.slice(at, to - at)
        at = to
    pa.default_memory_pool().release_unused()


def flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts behind one another, and n + 1 offsets; null counts as empty."""
    col = pc.fill_null(col.cast(pa.large_string()), "")
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]] if len(col) else np.zeros(0, np.uint8)
    return data, offsets - (offsets[0] if len(offsets) else 0)


def lowered(col: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(col.cast(pa.large_string()), ""))


def word_spans(buf: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of the text of every maximal run of ``inside`` bytes; no run crosses texts."""
    w = inside[buf]
    first = np.zeros(len(buf) + 1, bool)
    first[offsets] = True
    start = np.flatnonzero(w & (first[:-1] | ~np.concatenate(([False], w[:-1])))) if len(buf) else np.zeros(0, np.int64)
    end = np.flatnonzero(w & (first[1:] | ~np.concatenate((w[1:], [False])))) + 1 if len(buf) else start
    return start, end, np.searchsorted(offsets, start, "right") - 1


def shingles(h: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``size`` words and its text's number. A text with fewer words has one
    shingle, of all its words; a text without words has none."""
    n = len(h)
    if not n:
        return np.zeros(0, U), np.zeros(0, np.int64)
    last = np.append(doc[1:] != doc[:-1], True)
    first = np.append(True, doc[1:] != doc[:-1])
    begin, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    full = np.arange(max(0, n - size + 1))
    full = full[doc[full] == doc[full + size - 1]]
    acc = np.zeros(len(full), U)
    for k in range(size):
        acc = mix(acc * U(31) + h[full + k])
    short = np.flatnonzero(stop - begin < size)
    extra = []
    for b, e in zip(begin[short], stop[short], strict=True):
        x = np.zeros(1, U)
        for k in range(b, e):
            x = mix(x * U(31) + h[k : k + 1])
        extra.append(mix(x + U(e - b))[0])
    out, owner = np.append(acc, np.array(extra, U)), np.append(doc[full], doc[begin[short]])
    order = np.argsort(owner, kind="stable")
    return out[order], owner[order]
