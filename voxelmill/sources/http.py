"""Byte ranges of files on web servers: tried again where servers fail for a while, and kept for the next reader in the same process."""

from __future__ import annotations

import http.client
import threading
import time
import urllib.error
import urllib.request
from collections import OrderedDict

#: Attempts, the first pause in seconds (doubled each time), and how long a server may be silent.
ATTEMPTS, PAUSE, TIMEOUT = 5, 0.2, 60.0
#: Bytes kept for each process, the largest piece that is, and for how many seconds.
KEPT, PIECE, AGE = 64 << 20, 4 << 20, 300.0

_kept: OrderedDict[tuple, tuple[float, bytes | int | None]] = OrderedDict()
_size = 0
_lock = threading.Lock()


def is_url(path: str) -> bool:
    return path.startswith(("http://", "https://"))


def _known(key: tuple) -> tuple[bool, bytes | int | None]:
    with _lock:
        if key in _kept and time.monotonic() - _kept[key][0] < AGE:
            _kept.move_to_end(key)
            return True, _kept[key][1]
    return False, None


def _keep(key: tuple, value: bytes | int | None) -> None:
    global _size
    weigh = lambda x: len(x) if isinstance(x, bytes) else 64
    if weigh(value) > PIECE:
        return
    with _lock:
        if key in _kept:
            _size -= weigh(_kept.pop(key)[1])
        _kept[key] = time.monotonic(), value
        _size += weigh(value)
        while _size > KEPT:
            _size -= weigh(_kept.popitem(last=False)[1][1])


def forget() -> None:
    """Drop what is kept."""
    global _size
    with _lock:
        _kept.clear()
        _size = 0


def _asked(url: str, method: str, headers: dict[str, str]) -> tuple[int, bytes, http.client.HTTPMessage] | None:
    """Status, body and headers; None if there is no such file. Busy servers, lost connections and short bodies are tried again."""
    pause = PAUSE
    for attempt in range(ATTEMPTS):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, method=method, headers=headers), timeout=TIMEOUT) as r:
                return r.status, b"" if method == "HEAD" else r.read(), r.headers
        except urllib.error.HTTPError as e:
            if e.code in (404, 410):
                return None
            if e.code not in (408, 429) and e.code < 500 or attempt == ATTEMPTS - 1:
                raise OSError(f"{url}: {e}") from e
        except (OSError, http.client.HTTPException) as e:
            if attempt == ATTEMPTS - 1:
                raise OSError(f"{url}: {e}") from e
        time.sleep(pause)
        pause *= 2
    raise AssertionError


def length(url: str) -> int | None:
    """Bytes of a file; None if it isn't there."""
    known, n = _known((url, "length"))
    if not known:
        got = _asked(url, "HEAD", {})
        n = None if got is None else int(got[2].get("Content-Length", 0))
        _keep((url, "length"), n)
    return n


def read(url: str, offset: int = 0, size: int | None = None) -> bytes:
    """``size`` bytes from ``offset`` on, or all that follow; fewer at the end of the file."""
    key = (url, offset, size)
    known, data = _known(key)
    if known:
        return data
    if size == 0:
        return b""
    whole = offset == 0 and size is None
    got = _asked(url, "GET", {} if whole else {"Range": f"bytes={offset}-{'' if size is None else offset + size - 1}"})
    if got is None:
        raise FileNotFoundError(url)
    status, data, _ = got
    if not whole and status != 206:  # a server without ranges sends the whole file
        data = data[offset:] if size is None else data[offset : offset + size]
    _keep(key, data)
    return data
