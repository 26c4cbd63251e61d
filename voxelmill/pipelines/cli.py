"""Command line: ``python -m voxelmill.pipelines.cli lsm spool FOLDER --overlap 192 --chunk 64``."""

from __future__ import annotations

import argparse
import inspect
import logging
from collections.abc import Callable, Sequence
from dataclasses import fields
from typing import Any, get_args, get_origin

from pyspark.sql import SparkSession

from voxelmill.pipelines import df, lsm, psoct, wk

COMMANDS: dict[str, dict[str, Callable[..., Any]]] = {
    "psoct": {"single_volume": psoct.single_volume, "multi_slice": psoct.multi_slice},
    "df": {"singleslice": df.single_slice, "multislice": df.multi_slice},
    "lsm": {"single_volume": lsm.single_volume, "mosaic": lsm.mosaic, "multi_slice": lsm.multi_slice, "spool": lsm.spool, "strip": lsm.strip},
    "wk": {"webknossos": wk.webknossos},
}


def _value(text: str) -> Any:
    """Numbers, flags and words as they look."""
    for kind in (int, float):
        try:
            return kind(text)
        except ValueError:
            pass
    return {"true": True, "false": False, "none": None}.get(text.lower(), text)


def _add(p: argparse.ArgumentParser, name: str, annotation: Any, default: Any) -> None:
    flag, text = "--" + name.replace("_", "-"), str(annotation)
    if annotation is bool or text == "bool":
        p.add_argument(flag, action=argparse.BooleanOptionalAction, default=default)
    elif get_origin(annotation) is tuple or "tuple" in text:
        p.add_argument(flag, nargs="+", type=_value, default=default)
    elif "dict" in text:
        p.add_argument(flag, nargs="+", default=default, metavar="KEY=VALUE")
    else:
        p.add_argument(flag, type=_value, default=default)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="voxelmill")
    modes = out.add_subparsers(dest="mode", required=True)
    for mode, commands in COMMANDS.items():
        group = modes.add_parser(mode).add_subparsers(dest="command", required=True)
        for name, function in commands.items():
            p = group.add_parser(name, help=(function.__doc__ or "").split("\n")[0])
            groups = function.option_groups  # type: ignore[attr-defined]
            for k, par in inspect.signature(function, eval_str=True).parameters.items():
                if k == "spark" or k in groups:
                    continue
                if par.kind is par.POSITIONAL_OR_KEYWORD:
                    many = get_origin(par.annotation) is not None and str in get_args(par.annotation) and "Sequence" in str(par.annotation)
                    p.add_argument(k, nargs="+" if many else "?" if par.default is not par.empty else None, default=None if par.default is par.empty else par.default)
                else:
                    _add(p, k, par.annotation, par.default)
            for kind in groups.values():
                for f in fields(kind):
                    _add(p, f.name, f.type, argparse.SUPPRESS)
    return out


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> Any:
    given = vars(parser().parse_args(argv))
    function = COMMANDS[given.pop("mode")][given.pop("command")]
    for k, v in given.items():
        if isinstance(v, list) and k in ("chunk", "shard", "voxel_size"):
            given[k] = "auto" if v == ["auto"] else tuple(v)
        if k == "compressor_opt" and isinstance(v, list):
            given[k] = {a: _value(b) for a, _, b in (x.partition("=") for x in v)}
    logging.basicConfig()
    logging.getLogger().setLevel("DEBUG" if given.get("verbose") else str(given.get("log_level", "info")).upper())
    logging.captureWarnings(True)
    return function(spark or SparkSession.builder.getOrCreate(), **given)


if __name__ == "__main__":
    main()
