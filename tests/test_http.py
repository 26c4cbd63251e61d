"""Arrays behind a web server, read by ranges."""

import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import numpy as np
import pytest

from tests.test_regions import CUBE, make
from voxelmill.operators import grid
from voxelmill.pipelines import lsm
from voxelmill.sources import blocks, files, hdf5, http, tiff, zarr


@pytest.fixture
def server(tmp_path):
    """Serves a folder; every third request fails at first, every seventh loses its connection."""
    seen = Counter()

    class Handler(BaseHTTPRequestHandler):
        def log_message(self, *_):
            pass

        def do_HEAD(self):
            self.answer(False)

        def do_GET(self):
            self.answer(True)

        def answer(self, body):
            seen["all"] += 1
            if seen["all"] % 7 == 3:
                self.connection.close()
                return
            path = tmp_path / self.path.lstrip("/")
            if seen["all"] % 3 == 1 or not path.is_file():
                self.send_response(404 if seen["all"] % 3 != 1 else 503)
                self.end_headers()
                return
            data, given = path.read_bytes(), self.headers.get("Range")
            part = data
            if given and "plain" not in self.path:
                a, b = given.removeprefix("bytes=").split("-")
                part = data[int(a) : int(b) + 1 if b else None]
                seen["ranges"] += 1
            self.send_response(206 if part is not data else 200)
            self.send_header("Content-Length", str(len(part)))
            self.end_headers()
            if body:
                seen["bytes"] += len(part)
                self.wfile.write(part)

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    http.forget()
    yield f"http://127.0.0.1:{s.server_port}", seen
    s.shutdown()


def test_ranges_and_failures(server, tmp_path, monkeypatch):
    monkeypatch.setattr(http, "PAUSE", 0.01)
    url, seen = server
    data = np.random.default_rng(0).bytes(10_000)
    for name in ("a.bin", "plain.bin"):
        (tmp_path / name).write_bytes(data)
        assert files.length(f"{url}/{name}") == 10_000 and files.exists(f"{url}/{name}") and not files.exists(f"{url}/none")
        assert files.read(f"{url}/{name}") == data and files.read(f"{url}/{name}", 9_990) == data[9_990:]
        assert files.read(f"{url}/{name}", 5, 10) == data[5:15] and files.read(f"{url}/{name}", 9_995, 100) == data[9_995:]
    before = seen["all"]
    assert files.read(f"{url}/a.bin", 5, 10) == data[5:15] and seen["all"] == before  # kept
    with pytest.raises(FileNotFoundError):
        files.read(f"{url}/none")
    with pytest.raises(ValueError, match="neither listed nor written"):
        files.write(f"{url}/b", b"")


def test_what_is_kept_is_bounded(server, tmp_path, monkeypatch):
    monkeypatch.setattr(http, "PAUSE", 0.01)
    monkeypatch.setattr(http, "KEPT", 3_000)
    url, _ = server
    (tmp_path / "a.bin").write_bytes(bytes(50_000))
    for k in range(30):
        files.read(f"{url}/a.bin", k * 1_000, 1_000)
    assert http._size <= 3_000 and len(http._kept) == 3


def test_shards_by_range(spark, server, tmp_path):
    url, seen = server
    make(spark, str(tmp_path / "a"), CUBE, (4, 10, 10), (24, 20, 40), compressor="none")
    got = grid.unpack(blocks.opened(spark, "zarr", f"{url}/a", region="8:12,0:10,:")[0], "int32").toPandas()
    assert len(got) == 1600 and (CUBE[got.z, got.y, got.x] == got.v).all()
    # four chunks of 48, and the index, in a quarter of the bytes at most
    assert seen["ranges"] >= 5 and seen["bytes"] < CUBE.nbytes / 4
    assert blocks.voxels(spark, "zarr", f"{url}/a").where("z = 3 and y = 4 and x = 5").collect()[0]["v"] == CUBE[3, 4, 5]


def test_other_formats(spark, server, tmp_path):
    url, _ = server
    tiff.write_tiff(str(tmp_path / "a.tiff"), CUBE)
    hdf5.write_hdf5(str(tmp_path / "a.mat"), {"v": CUBE}, (4, 5, 8))
    for name, path in (("tiff", "a.tiff"), ("mat", "a.mat")):
        assert sorted(r["v"] for r in blocks.voxels(spark, name, f"{url}/{path}").where("z = 7").collect()) == sorted(CUBE[7].ravel().tolist())
    w = lsm.single_volume(spark, f"{url}/a.tiff", out=str(tmp_path / "o.zarr"), chunk=(16,), levels=1)
    assert (zarr.opened(f"{w.path}/0").read([(0, n) for n in CUBE.shape]) == CUBE).all()
