"""Options of conversions, and how flat keyword arguments find their option group."""

from __future__ import annotations

import functools
import inspect
import os
from collections.abc import Callable
from dataclasses import dataclass, field, fields, is_dataclass, replace
from typing import Any, Literal

AXIS = {"x": 2, "y": 1, "z": 0}
#: Who writes arrays. All names mean the tasks of this engine, so options of other writers stay valid.
DRIVERS = ("spark", "zarr-python", "tensorstore")


class UnsupportedDriverError(ValueError):
    pass


@dataclass(frozen=True)
class ArrayOptions:
    """How arrays are stored. ``driver`` names who writes them, of which there is one.
    A ``fill_value`` other than 0 stands for voxels that are absent: levels and projections leave them out. It should be
    the least or greatest value of the type, so that no mean comes to it.

    Names and defaults are fixed values: commands and callers rely on them."""

    zarr_version: Literal[2, 3] = 3
    chunk: tuple[int, ...] = (128,)
    chunk_channels: bool = False
    chunk_time: bool = True
    shard: tuple[int, ...] | Literal["auto"] | None = None
    shard_channels: bool = False
    shard_time: bool = False
    dimension_separator: Literal[".", "/"] = "/"
    order: Literal["C", "F"] = "C"
    compressor: Literal["blosc", "zstd", "gzip", "zlib", "none"] = "zstd"
    compressor_opt: dict[str, float | str] = field(default_factory=dict)
    no_time: bool = False
    no_pyramid_axis: Literal["x", "y", "z"] | None = None
    levels: int = -1
    ome_version: Literal["0.4", "0.5"] = "0.4"
    overwrite: bool = False
    driver: str = "spark"
    fill_value: int = 0

    def __post_init__(self) -> None:
        if self.driver not in DRIVERS:
            raise UnsupportedDriverError(f"no such driver: {self.driver}; there are {', '.join(DRIVERS)}")
        if self.order not in ("C", "F"):
            raise ValueError("order is C or F")
        if self.zarr_version not in (2, 3):
            raise ValueError("zarr_version is 2 or 3")
        if self.zarr_version == 2 and (self.shard or self.shard_channels or self.shard_time):
            raise ValueError("shards need zarr_version 3")


@dataclass(frozen=True)
class GeneralOptions:
    """``max_load`` bounds the voxels per axis that a reader loads at once. ``verbose`` logs at level debug,
    whatever ``log_level`` says. Names and defaults are fixed values."""

    out: str | None = None
    max_load: int = 1024
    log_level: str = "info"
    verbose: bool = False

    def __post_init__(self) -> None:
        if self.max_load <= 0:
            raise ValueError("max_load is above 0")


@dataclass(frozen=True)
class HeaderOptions:
    nii: bool = True
    orientation: str = "RAS"
    center: bool = True
    nifti_header: str | None = None


def default_output(source: str, options: HeaderOptions) -> str:
    """Beside the source, under its name without the extension."""
    base = os.path.basename(source.rstrip("/"))
    return os.path.splitext(base)[0] + (".nii.zarr" if options.nii else ".ome.zarr")


def autoconfig(function: Callable[..., Any]) -> Callable[..., Any]:
    """Let options be given flat: ``convert(path, chunk=(64,))`` puts ``chunk`` into the parameter whose
    options have that field. Parameters that aren't given are made from their defaults."""
    signature = inspect.signature(function, eval_str=True)
    groups = {n: p.annotation for n, p in signature.parameters.items() if is_dataclass(p.annotation)}
    owner: dict[str, str] = {}
    for name, kind in groups.items():
        for f in fields(kind):
            if f.name in owner or f.name in signature.parameters:
                raise ValueError(f"two options are called {f.name}")
            owner[f.name] = name

    @functools.wraps(function)
    def wrapper(*args: Any, **kwargs: Any) -> Any:
        flat: dict[str, dict[str, Any]] = {}
        for k in [k for k in kwargs if k not in signature.parameters]:
            if k not in owner:
                raise TypeError(f"{function.__name__}() has no option {k!r}")
            flat.setdefault(owner[k], {})[k] = kwargs.pop(k)
        bound = signature.bind_partial(*args, **kwargs)
        for name, kind in groups.items():
            given = bound.arguments.get(name) or kind()
            bound.arguments[name] = replace(given, **flat.get(name, {}))
        return function(*bound.args, **bound.kwargs)

    wrapper.option_groups = groups  # type: ignore[attr-defined]
    return wrapper
