"""Suffix arrays by two-stage sorting.

A suffix smaller than its successor (type S) is sorted directly; the others (type L) are induced: when
buckets of first symbols are scanned in order, the L predecessors of the suffixes met come in their own
order. Scans take whole arrays at a time, bucket by bucket."""

from __future__ import annotations

import numpy as np


def types(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than its successor; the last symbol must be the least."""
    up = np.append(t[1:].astype(np.int32) - t[:-1], 1)
    last = np.flatnonzero(up)
    return up[last[np.searchsorted(last, np.arange(len(t)))]] > 0


def two_stage(texts: list[bytes], starts: list[int], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort the suffixes at the first ``starts[k]`` places of each text by their first ``depth`` bytes.

    Returns their order, as places in the concatenation of the texts each followed by one end mark, and
    the place of each text. Of each text, suffixes as far as the first S at or after its last start take
    part, for those induce all the others. A text ends before any byte."""
    sizes = np.array([len(x) + 1 for x in texts])
    base = np.cumsum(sizes) - sizes
    joined = b"\0".join(texts) + b"\0"
    t = np.frombuffer(joined, np.uint8).astype(np.int16) + 1
    t[base + sizes - 1] = 0
    small = types(t)
    s_at = np.flatnonzero(small)
    stop = s_at[np.searchsorted(s_at, base + np.array(starts) - 1)]
    edge = np.zeros(len(t) + 1, np.int32)
    np.add.at(edge, base, 1)
    np.add.at(edge, stop + 1, -1)
    active = np.cumsum(edge[:-1]) > 0
    direct = np.flatnonzero(active & small)
    # an end mark sorts before a zero byte: both have an empty key or none, so symbols decide first
    direct = direct[np.argsort(t[direct], kind="stable")]
    cuts = np.searchsorted(t[direct], np.arange(258))
    ends = np.minimum((base + sizes - 1)[np.searchsorted(base, direct, "right") - 1], direct + depth)
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        # keys of one bucket at a time
        keys = [joined[x:y] for x, y in zip(direct[a:b].tolist(), ends[a:b].tolist(), strict=True)]
        direct[a:b] = direct[a:b][np.array(sorted(range(b - a), key=keys.__getitem__), np.int64)]
    large = active & ~small
    waiting: list[list[np.ndarray]] = [[] for _ in range(258)]
    order: list[np.ndarray] = []

    def induce(met: np.ndarray, own: int) -> np.ndarray:
        """Deal out the L predecessors of ``met``; those of the same bucket are returned."""
        before = met[met > 0] - 1
        before = before[large[before]]
        symbol = t[before]
        same = before[symbol == own]
        later = np.flatnonzero(symbol > own)
        later = later[np.argsort(symbol[later], kind="stable")]
        if len(later):
            symbols = symbol[later]
            parts = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))
            for a, b in zip(parts, np.append(parts[1:], len(later)), strict=True):
                waiting[symbols[a]].append(before[later[a:b]])
        return same

    for c in range(257):
        met = np.concatenate(waiting[c]) if waiting[c] else np.zeros(0, np.int64)
        waiting[c] = []
        while len(met):
            order.append(met)
            met = induce(met, c)
        met = direct[cuts[c] : cuts[c + 1]]
        if len(met):
            order.append(met)
            induce(met, c)
    sa = np.concatenate(order) if order else np.zeros(0, np.int64)
    text = np.searchsorted(base, sa, "right") - 1
    return sa[sa - base[text] < np.array(starts)[text]], base


def common_prefixes(texts: list[bytes], sa: np.ndarray, depth: int) -> np.ndarray:
    """For each suffix but the first, the prefix it has in common with the one before, in whole words of
    eight bytes and at most ``depth`` bytes (a multiple of eight). Suffixes must be that long."""
    joined = b"\0".join(texts) + b"\0" * 9
    words = np.ndarray((max(len(joined) - 8, 0),), np.uint64, joined, strides=(1,))
    out = np.zeros(max(len(sa) - 1, 0), np.int32)
    alive = np.arange(len(out))
    for k in range(depth // 8):
        alive = alive[words[sa[alive] + 8 * k] == words[sa[alive + 1] + 8 * k]]
        out[alive] += 8
    return out


def repeated(texts: list[bytes], starts: list[int], depth: int) -> list[np.ndarray]:
    """Per text, which of its first ``starts[k]`` places begin a string of ``depth`` bytes that also
    begins at such a place elsewhere. ``len(texts[k]) >= starts[k] + depth - 1``."""
    sa, base = two_stage(texts, starts, depth)
    equal = common_prefixes(texts, sa, depth) >= depth
    found = sa[np.append(equal, False) | np.append(False, equal)] if len(sa) else sa
    text = np.searchsorted(base, found, "right") - 1
    out = [np.zeros(n, bool) for n in starts]
    for k in np.unique(text).tolist():
        out[k][found[text == k] - base[k]] = True
    return out
