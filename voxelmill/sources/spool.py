"""Folders of raw camera frames, written file by file while a camera runs."""

from __future__ import annotations

import configparser
import math
import re

import numpy as np

from voxelmill.sources import files
from voxelmill.sources.blocks import BlockSource, Format, Info, Part
from voxelmill.sources.mat import read_mat

#: The marker of the format, its settings file, and its pixel encodings.
MARKER, SETTINGS = "Spooled files.sifx", "acquisitionmetadata.ini"
ENCODINGS = {"Mono16": "uint16", "Mono8": "uint8"}


def file_index(name: str) -> int | None:
    """Ten digits written backwards before ``spool.dat``."""
    m = re.fullmatch(r"(\d{10})spool\.dat", name)
    return int(m[1][::-1]) if m else None


def file_name(index: int) -> str:
    return f"{index:010d}"[::-1] + "spool.dat"


def kept_files(info_path: str) -> int:
    """Files that hold more than background, by the acquisition's info file."""
    info = read_mat(info_path)
    found: dict[str, float] = {}

    def look(x: object) -> None:
        if isinstance(x, dict):
            for k, v in x.items():
                if k in ("kineticSeriesLength", "backgroundFramesNum", "ImagesPerFile", "imagesPerFile"):
                    found[k.lower()] = float(np.asarray(v).ravel()[0])
                look(v)

    look(info)
    return math.ceil((found["kineticserieslength"] - found["backgroundframesnum"]) / found["imagesperfile"])


class SpoolFormat(Format):
    """Axes: frame, row, column, as stored (``raw``), or else row, column, frame without the padding rows.

    Options: ``raw``; ``info``, a file that says how many files hold more than background."""

    def info(self) -> Info:
        if not files.exists(f"{self.path}/{MARKER}"):
            raise ValueError(f"no spool folder: {self.path}")
        ini = configparser.ConfigParser()
        ini.read_string(files.read(f"{self.path}/{SETTINGS}").decode("utf-8-sig"))
        data, height = ini["data"], int(ini["data"]["AOIHeight"])
        encoding = data["PixelEncoding"].strip()
        if encoding not in ENCODINGS:
            raise ValueError(f"unknown pixel encoding: {encoding}")
        dtype = ENCODINGS[encoding]
        per_file, columns = int(ini["multiimage"]["ImagesPerFile"]), int(data["AOIStride"]) // np.dtype(dtype).itemsize
        rows = _rows(height)
        found = sorted(i for n in files.names(self.path) if (i := file_index(n)) is not None)
        if self.options.get("info"):
            found = found[: kept_files(self.options["info"])]
        frames = len(found) * per_file
        raw = self.options.get("raw", "").lower() == "true"
        shape = (frames, rows, columns) if raw else (height, columns, frames)
        return Info(shape, dtype, {"files": found, "per_file": per_file, "rows": rows, "columns": columns, "height": height, "raw": raw})

    def parts(self, info: Info) -> list[Part]:
        x = info.extra
        out = []
        for k, index in enumerate(x["files"]):
            first = k * x["per_file"]
            if x["raw"]:
                out.append(Part((first, 0, 0), (x["per_file"], x["rows"], x["columns"]), file=file_name(index)))
            else:
                out.append(Part((0, 0, first), (x["height"], x["columns"], x["per_file"]), file=file_name(index)))
        return out

    def load(self, info: Info, part: Part) -> np.ndarray:
        x = info.extra
        a = np.frombuffer(files.read(f"{self.path}/{part.what['file']}"), info.dtype)
        a = a.reshape(x["per_file"], x["rows"], x["columns"])
        return a if x["raw"] else a[:, : x["height"]].transpose(1, 2, 0)


class SpoolSource(BlockSource):
    kind, short = SpoolFormat, "spool"


def write_spool(path: str, volume: np.ndarray, per_file: int) -> None:
    """The inverse of the reader: a volume (row, column, frame) as a spool folder. Frames must fill files."""
    if volume.shape[2] % per_file:
        raise ValueError("frames don't fill whole files")
    write_settings(path, volume.shape[:2], volume.dtype, per_file)
    for k in range(0, volume.shape[2], per_file):
        write_frames(path, k // per_file, volume[:, :, k : k + per_file])


def write_settings(path: str, shape: tuple[int, int], dtype: np.dtype, per_file: int) -> None:
    """What a folder of frames (row, column) says of itself."""
    encoding = next(k for k, v in ENCODINGS.items() if v == dtype.name)
    height, columns = shape
    files.write(f"{path}/{MARKER}", b"")
    text = f"[data]\nAOIHeight = {height}\nAOIWidth = {columns}\nAOIStride = {columns * dtype.itemsize}\nPixelEncoding = {encoding}\nImageSizeBytes = {_rows(height) * columns * dtype.itemsize}\n[multiimage]\nImagesPerFile = {per_file}\n"
    files.write(f"{path}/{SETTINGS}", text.encode("utf-8-sig"))


def write_frames(path: str, no: int, volume: np.ndarray) -> None:
    """One file of frames, from (row, column, frame)."""
    height, columns, frames = volume.shape
    padded = np.zeros((frames, _rows(height), columns), volume.dtype)
    padded[:, :height] = volume.transpose(2, 0, 1)
    files.write(f"{path}/{file_name(no)}", padded.tobytes())


def _rows(height: int) -> int:
    """With padding."""
    return height + 1 if height % 2 else height + 2
