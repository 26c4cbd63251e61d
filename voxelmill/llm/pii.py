"""Personal data in text: four strict patterns, and a conditional random field for freer spellings.

The patterns decide what they can (e-mail, IPv4, card and phone numbers); the field is trained on a
small labelled table of sentences and sees word shapes, not words. It adds spans such as numbers
without a country code or addresses spelled with "at" and "dot"; an added span mustn't touch one of
the patterns' and must hold as many digits, a valid check digit or parts as its kind has.

The field reads a stretch of text around every digit, "@" and spelled-out address; elsewhere it has
nothing to tag. Every search takes time in proportion to the text, however long a run of one kind of
character, and a stretch of any length is described and decoded piece by piece.

Null texts count as empty; offsets are code points with exclusive ends. Every row has a result of its own,
equal rows equal ones; of spans that begin together, the kinds' order decides. An empty table gives no
rows. Only the id and the text are read, whatever other columns are named.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from voxelmill.llm.crf import Crf
from voxelmill.llm.text import by_size, flat

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LEFT = re.compile(r"[A-Za-z0-9._%+-]+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_PART = re.compile(r"[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")

Span = tuple[int, int]


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[Span]:
    """One look to the left and one to the right of every "@"."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        left = at
        while left > free and text[left - 1] in _LOCAL:
            left -= 1
        m = _DOMAIN.match(text, at + 1) if left < at else None
        if m:
            out.append((left, m.end()))
        # what stands before this "@" can't be the local part of a later one
        free = m.end() if m else at + 1
        at = text.find("@", free)
    return out


def addresses(text: str) -> list[Span]:
    """Within a chain of dotted numbers, matches are fours from its start."""
    out = []
    for m in _DOTTED.finditer(text):
        if "." in m[0]:
            parts = [(p.start(), p.end()) for p in _PART.finditer(text, m.start(), m.end())]
            for k in range(0, len(parts) - 3, 4):
                four = parts[k : k + 4]
                if all(int(text[max(a, b - 5) : b]) <= 255 and not text[a : max(a, b - 5)].strip("0") for a, b in four):
                    out.append((four[0][0], four[3][1]))
    return out


def cards(text: str) -> list[Span]:
    return [m.span() for m in _CARD.finditer(text) if 13 <= len(d := digits(m[0])) <= 19 and luhn(d)]


def phones(text: str) -> list[Span]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end), by kind and start."""
    found = emails(text) if "@" in text else []
    out = [(0, *s) for s in found]
    for k, f in ((1, addresses), (2, cards), (3, phones)):
        out += [(k, *s) for s in f(text)]
    return out


# ---------------------------------------------------------------- the field

_TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|[^\w\s]|[_\d]")
_KNOWN = frozenset("at dot com org net edu mail email phone tel call fax mobile card visa ip host version page chapter on in for total items euro".split())
FEATURES = 11
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))


def tokens(text: str, begin: int = 0, end: int | None = None) -> np.ndarray:
    """(n, 2) starts and ends."""
    found = (x for m in _TOKEN.finditer(text, begin, len(text) if end is None else end) for x in m.span())
    return np.fromiter(found, np.int32).reshape(-1, 2)


def shape(word: str) -> str:
    if "0" <= word[0] <= "9":
        return f"d{min(len(word), 7)}"
    if not word[0].isalpha():
        return word[0] if word[0].isascii() else "?"
    low = word.lower()
    return low if low in _KNOWN else ("X" if word[0].isupper() else "x") + str(min(len(word) // 4, 3))


def described(text: str, spans: list[Span]) -> list[list[str]]:
    """Of each token: its shape, those of four neighbours, pairs and triples, and whether space goes before."""
    s = ["^", "^", *(shape(text[a:b]) for a, b in spans), "$", "$"]
    joined = [*(k > 0 and spans[k - 1][1] == a for k, (a, _) in enumerate(spans)), False]
    return [
        [
            f"0{s[k + 2]}", f"-1{s[k + 1]}", f"+1{s[k + 3]}", f"-2{s[k]}", f"+2{s[k + 4]}", f"a{s[k + 1]}|{s[k + 2]}", f"b{s[k + 2]}|{s[k + 3]}",
            f"c{s[k + 1]}|{s[k + 2]}|{s[k + 3]}", f"d{s[k + 2]}|{s[k + 3]}|{s[k + 4]}", f"e{s[k]}|{s[k + 1]}|{s[k + 2]}", f"j{joined[k]}{joined[k + 1]}{s[k + 2]}",
        ]
        for k in range(len(spans))
    ]


def numbers(text: str, spans: list[Span] | np.ndarray, index: dict[str, int], piece: int = 4096) -> np.ndarray:
    """Feature numbers of all tokens, -1 for features not seen in training; tokens are described some at a time,
    with their neighbours."""
    out = np.full((len(spans), FEATURES), -1, np.int32)
    for p in range(0, len(spans), piece):
        low = max(0, p - 2)
        rows = described(text, [(int(a), int(b)) for a, b in spans[low : p + piece + 2]])[p - low : p - low + piece]
        for k, row in enumerate(rows, p):
            out[k] = [index.get(f, -1) for f in row]
    return out


def labelled_table(rows: int = 900, seed: int = 11) -> list[tuple[int, int, str, str]]:
    """(sentence, start, token, tag): sentences with personal data in many spellings, and others with
    dates, versions, prices, counts and references that are none."""
    r = random.Random(seed)
    n = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    word = lambda: "".join(r.choice(("an", "er", "th", "on", "le", "ung", "que", "os", "mi", "ta", "st", "re")) for _ in range(r.randint(1, 4)))

    def card() -> str:
        head = n(15)
        return next(head + c for c in "0123456789" if luhn(head + c))

    def four(sep: str) -> str:
        c = card()
        return sep.join(c[k : k + 4] for k in range(0, 16, 4))

    yes = (
        ("email", lambda: f"{word()}.{n(2)}@{word()}.example.com"), ("email", lambda: f"{word()}@{word()}.org"),
        ("email", lambda: f"{word()} [at] {word()} [dot] com"), ("email", lambda: f"{word()} (at) {word()} (dot) org"),
        ("email", lambda: f"{word()} at {word()} dot com"), ("email", lambda: f"{word()} at {word()} dot net"), ("email", lambda: f"{word()} @ {word()} . com"),
        ("ip", lambda: ".".join(str(r.randint(0, 255)) for _ in range(4))), ("card", lambda: four(" ")), ("card", lambda: four("-")), ("card", lambda: four(".")), ("card", card),
        ("phone", lambda: f"+{r.randint(1, 9)} ({n(3)}) {n(3)}-{n(4)}"), ("phone", lambda: f"({n(3)}) {n(3)}-{n(4)}"), ("phone", lambda: f"{n(3)}-{n(3)}-{n(4)}"),
        ("phone", lambda: f"{n(3)}.{n(3)}.{n(4)}"),
    )
    no = (
        lambda: f"{r.randint(1900, 2030)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}", lambda: f"{r.randint(1, 28)}.{r.randint(1, 12)}.{r.randint(1990, 2030)}", lambda: f"{r.randint(0, 23)}:{n(2)}",
        lambda: f"version {r.randint(0, 9)}.{r.randint(0, 20)}", lambda: f"{r.randint(0, 9)}.{r.randint(0, 9)}.{r.randint(0, 9)}", lambda: f"${n(2)}.{n(2)}", lambda: f"{n(3)} items", lambda: n(r.randint(1, 12)), lambda: n(16),
        lambda: f"page {n(2)}", lambda: f"{n(2)}-{n(2)}", lambda: f"({n(4)})", lambda: f"{n(3)} {n(3)}", lambda: f"at {word()} dot", lambda: f"{word()} at {word()}", lambda: f"@{word()}", lambda: f"{n(1)} + {n(1)}", lambda: f"{n(3)}-{n(1)}-{n(2)}-{n(6)}-{n(1)}",
        lambda: f"{word()}{n(2)}{word()}{n(3)}{word()}",
    )
    out = []
    for sid in range(rows):
        text, marks = " ".join(word() for _ in range(r.randint(1, 6))).capitalize(), []
        for _ in range(r.randint(1, 2)):
            if r.random() < 0.55:
                kind, make = r.choice(yes)
                piece = make()
                marks.append((kind, len(text) + 1, len(text) + 1 + len(piece)))
            else:
                piece = r.choice(no)()
            text += f" {piece}{r.choice(('', '.', ',', '!!', '###'))} " + " ".join(word() for _ in range(r.randint(1, 5)))
        for a, b in tokens(text).tolist():
            kind = next(((k, s) for k, s, e in marks if s <= a < e), None)
            out.append((sid, a, text[a:b], "O" if kind is None else f"{'B' if kind[1] == a else 'I'}-{kind[0]}"))
    return out


@lru_cache(1)
def _trained() -> tuple[dict[str, int], Crf]:
    return train(labelled_table())


def train(table: list[tuple[int, int, str, str]]) -> tuple[dict[str, int], Crf]:
    """Feature numbers and field from a labelled table."""
    index: dict[str, int] = {}
    seqs, tags = [], []
    sentences: dict[int, list[tuple[int, str, str]]] = {}
    for sid, a, token, tag in table:
        sentences.setdefault(sid, []).append((a, token, tag))
    for rows in sentences.values():
        rows.sort()
        text = ""
        for a, token, _ in rows:
            text += " " * (a - len(text)) + token
        feats = described(text, [(a, a + len(token)) for a, token, _ in rows])
        seqs.append(np.array([[index.setdefault(f, len(index)) for f in row] for row in feats], np.int32))
        tags.append(np.array([TAGS.index(tag) for *_, tag in rows]))
    return index, Crf.fit(seqs, tags, len(index), len(TAGS))


_TRIGGER = re.compile(r"[0-9@]+")
_SPELLED = re.compile(r"\bat\b[^\n]{1,60}?\bdot\b", re.I)
REACH = 60


def stretches(text: str) -> list[Span]:
    """Text around every trigger, joined where they meet, within a line and at word ends."""
    marks = [m.span() for m in _TRIGGER.finditer(text)]
    if "dot" in text.lower():
        marks = sorted(marks + [m.span() for m in _SPELLED.finditer(text)])
    out: list[list[int]] = []
    for a, b in marks:
        a, b = max(text.rfind("\n", max(0, a - REACH), a) + 1, a - REACH, 0), min(x if (x := text.find("\n", b, b + REACH)) >= 0 else len(text), b + REACH)
        if out and a <= out[-1][1]:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def valid(kind: str, s: str) -> bool:
    d = digits(s)
    if kind == "card":
        return 13 <= len(d) <= 19 and luhn(d)
    if kind == "phone":
        return 9 <= len(d) <= 15
    if kind == "ip":
        return len(parts := re.findall("[0-9]+", s)) == 4 and all(int(p[-5:]) <= 255 for p in parts)
    return bool(re.search(r"@|\bat\b", s, re.I) and re.search(r"\.|\bdot\b", s, re.I))


def by_start(spans: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Starts in order, and the largest end so far."""
    both = np.array(sorted((a, b) for _, a, b in spans), np.int64).reshape(-1, 2)
    return both[:, 0], np.maximum.accumulate(both[:, 1]) if len(both) else both[:, 1]


def added_spans(texts: list[str], base: list[list[tuple[int, int, int]]], model: tuple[dict[str, int], Crf]) -> list[list[tuple[int, int, int]]]:
    index, field = model
    where, seqs = [], []
    for k, text in enumerate(texts):
        for a, b in stretches(text):
            spans = tokens(text, a, b)
            if len(spans):
                where.append((k, spans))
                seqs.append(numbers(text, spans, index))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (k, spans), path in zip(where, field.decode(seqs), strict=True):
        if not path.any():
            continue
        # a tag B is followed by its own I; base spans are looked up by their starts
        starts, last = by_start(base[k])
        for i in np.flatnonzero(path % 2 == 1).tolist():
            j = i + 1
            while j < len(path) and path[j] == path[i] + 1:
                j += 1
            kind, a, b = int(path[i]) // 2, int(spans[i][0]), int(spans[j - 1][1])
            before = int(np.searchsorted(starts, b))
            if valid(KINDS[kind], texts[k][a:b]) and not (before and last[before - 1] > a):
                out[k].append((kind, a, b))
    return out


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: tuple[dict[str, int], Crf] | None = None) -> DataFrame:
    """id, base, spans: arrays of (kind, start, end) by kind and start; spans holds base, too."""
    model = model or _trained()
    rows = docs.select(id_col, text_col)
    span = "array<struct<kind:int,start:int,end:int>>"
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    as_rows = lambda many: pa.array([[dict(zip(("kind", "start", "end"), s, strict=True)) for s in x] for x in many], kind)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trigger = np.zeros(256, bool)
        trigger[[*range(48, 58), 64]] = True
        for whole in batches:
            for batch in by_size(whole, text_col):
                column = batch.column(text_col)
                buf, offsets = flat(column)
                hit = set(np.unique(np.searchsorted(offsets, np.flatnonzero(trigger[buf]), "right") - 1).tolist())
                texts = [t or "" for t in column.to_pylist()]
                hit |= set(np.flatnonzero(pc.fill_null(pc.match_substring(column, "dot", ignore_case=True), False).to_numpy(zero_copy_only=False)).tolist())
                some = sorted(hit)
                base = [base_spans(texts[k]) for k in some]
                more = added_spans([texts[k] for k in some], base, model)
                all_base: list = [[] for _ in texts]
                both: list = [[] for _ in texts]
                for k, b, m in zip(some, base, more, strict=True):
                    all_base[k], both[k] = b, sorted(b + m)
                yield pa.RecordBatch.from_arrays([batch.column(id_col), as_rows(all_base), as_rows(both)], ["id", "base", "spans"])

    return rows.mapInArrow(scan, f"id {docs.schema[id_col].dataType.simpleString()}, base {span}, spans {span}").withColumnRenamed("id", id_col)
