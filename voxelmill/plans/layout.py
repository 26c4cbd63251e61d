"""Chunk and shard sizes of arrays with axes (t, c, z, y, x) or fewer."""

from __future__ import annotations

import math
from collections.abc import Sequence

from voxelmill.plans.config import ArrayOptions

#: Largest shard on disk, and how much smaller compression is taken to make data.
SHARD_BYTES, RATIO = 2 << 30, 2


def leading(shape: Sequence[int], o: ArrayOptions) -> tuple[list[int], list[int]]:
    """Chunk and shard sizes of the axes before z."""
    if len(shape) == 5:
        chunk = [1 if o.chunk_time else shape[0], 1 if o.chunk_channels else shape[1]]
        return chunk, [chunk[0] if o.shard_time else shape[0], chunk[1] if o.shard_channels else shape[1]]
    if len(shape) == 4:
        split, shared = (o.chunk_channels, o.shard_channels) if o.no_time else (o.chunk_time, o.shard_time)
        chunk = [1 if split else shape[0]]
        return chunk, [chunk[0] if shared else shape[0]]
    if len(shape) in (2, 3):
        return [], []
    raise ValueError(f"arrays have 2 to 5 axes, not {len(shape)}")


def _filled(given: Sequence[int], lead: Sequence[int], ndim: int) -> list[int]:
    if len(given) > ndim:
        raise ValueError(f"{len(given)} sizes for {ndim} axes")
    if len(given) == ndim:
        return list(given)
    spatial = ndim - len(lead)
    if len(given) > spatial:
        return [*lead[: ndim - len(given)], *given]
    return [*lead, *given, *[given[-1]] * (spatial - len(given))]


def auto_multiples(shape: Sequence[int], chunk: Sequence[int], budget: float) -> list[int]:
    """How many chunks a shard has along each axis: as near a cube as the budget (in chunks) allows, and
    no more than cover the axis."""
    edge = int(budget ** (1 / 3) + 1e-9)
    need = [-(-s // c) for s, c in zip(shape, chunk, strict=True)]
    out = [min(n, max(edge, 1)) for n in need]
    grown = True
    while grown:
        grown = False
        for k in range(len(out)):
            more = [m + (i == k) for i, m in enumerate(out)]
            if out[k] < need[k] and math.prod(more) <= budget:
                out, grown = more, True
    return out


def layout(shape: Sequence[int], itemsize: int, o: ArrayOptions) -> tuple[list[int], list[int] | None]:
    """Chunk and shard shapes; no shard if none is asked for. Chunks aren't larger than the array."""
    lead, shard_lead = leading(shape, o)
    chunk = [min(c, s) if len(o.chunk) < len(shape) and k < len(lead) else c for k, (c, s) in enumerate(zip(_filled(o.chunk, lead, len(shape)), shape, strict=True))]
    if o.shard is None:
        return chunk, None
    if o.shard != "auto":
        return reconciled(shape, chunk, _filled(o.shard, shard_lead, len(shape)))
    spatial, spatial_chunk = list(shape[len(lead) :]), chunk[len(lead) :]
    budget = SHARD_BYTES * RATIO / (math.prod(shard_lead) * math.prod(spatial_chunk) * itemsize)
    many = auto_multiples(spatial, spatial_chunk, budget)
    return chunk, [*shard_lead, *(m * c for m, c in zip(many, spatial_chunk, strict=True))]


def doubled_shard(shape: Sequence[int], itemsize: int, limit: int = SHARD_BYTES << 10) -> list[int]:
    """A shard that doubles axis by axis while it is within the limit, rounded up to powers of two."""
    most, out = limit * RATIO / itemsize, [1] * len(shape)
    while True:
        more = [min(2 * n, s) for n, s in zip(out, shape, strict=True)]
        if more == out or math.prod(more) > most:
            return [1 << (n - 1).bit_length() for n in out]
        out = more


def reconciled(shape: Sequence[int], chunk: Sequence[int], shard: Sequence[int]) -> tuple[list[int], list[int]]:
    """A chunk as large as its axis grows to the shard; a shard is a whole number of chunks."""
    chunk = [d if c == s != d else c for s, c, d in zip(shape, chunk, shard, strict=True)]
    return chunk, [-(-d // c) * c for c, d in zip(chunk, shard, strict=True)]
