"""Secrets in text, with built-in expressions only.

Three patterns find assigned, access-key and hexadecimal secrets. Other long tokens are judged by two
character Markov models, one of random strings and one of ordinary identifiers, trained from labelled
samples: a token whose log-likelihood ratio per transition is above a threshold is a secret too.

Positions come from the pieces between matches, summed in blocks, so a text with very many matches
costs little more than its length; so does telling which tokens lie apart from the patterns' spans. Nothing is shuffled. Null texts count as empty, offsets are code
points with exclusive ends, and ``spans`` is "" where nothing is found. Equal rows have equal results; of
spans that begin together, the kinds' order decides. An empty table gives no rows. Columns named base and
found are replaced, all others are kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Kind, pattern, group whose length counts, its least length. Leftmost matches that don't overlap.
BASE = (
    ("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
)
#: What tells quickly that a kind may occur.
QUICK = {"assign": BASE[0][1], "access": "AKIA[A-Z0-9]", "hex": "[0-9a-f]{32}"}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
TOKEN, TOKEN_LENGTH = "[A-Za-z0-9+/_=-]", 20
#: Least log-likelihood ratio of a secret, in nats per transition.
THRESHOLD = 0.9
BLOCK = 256
WORDS = (
    "account action active address after agent alert amount answer array attach author balance before begin block board branch bridge "
    "buffer button cache caller cancel center change channel chapter client column command config connect content context control counter "
    "create current customer daemon database default delete detail device direct display document driver element enable engine error event "
    "example export factory feature field filter finish format function gateway global handler header history identifier image import index "
    "information input instance interface internal iterator kernel language layout library listener location manager mapping master member "
    "message method model module monitor network number object observer operation option order output package parameter parent parser pattern "
    "payment permission pipeline platform plugin position prefix process product profile project property provider query record reference "
    "register remote repository request resource response result return router schedule schema screen search section segment select server "
    "service session setting shadow signal simple socket source standard status storage stream string subject support switch system table "
    "target template thread timeout transaction transfer transform trigger update upload validate value vector version virtual window worker writer "
    "achtung arbeit beispiel bericht einheit erfahrung gesellschaft gleichung kenntnis leistung moeglichkeit rechnung sicherheit verbindung "
    "verwaltung zeichnung avantage bonjour chapitre document ensemble entreprise gouvernement maintenant mouvement nombre question toujours "
    "ciudad corazon desarrollo empresa gobierno informacion mientras nosotros palabra pregunta siempre trabajo"
).split()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def labelled_samples(spark: SparkSession, rows: int = 6000) -> DataFrame:
    """sample, random: half are slices of digests in base 64 or hexadecimal, half identifiers made of
    words in snake, kebab, camel and path style, some with a number."""
    d = spark.range(rows)
    bits = F.unhex(F.sha2(F.concat(F.lit("sample"), F.col("id").cast("string")), 256))
    digest = F.when(F.col("id") % 4 == 0, F.lower(F.hex(bits))).otherwise(F.base64(bits))
    random = d.where("id % 2 = 0").select(F.substring(digest, 1, 40).alias("sample"), F.lit(True).alias("random"))
    words = F.array(*map(F.lit, WORDS))
    word = lambda k: F.element_at(words, (F.pmod(F.xxhash64(F.col("id"), F.lit(k)), F.lit(len(WORDS))) + 1).cast("int"))
    style = F.pmod(F.xxhash64("id"), F.lit(6))
    name = (
        F.when(style == 0, F.concat_ws("_", word(1), word(2), word(3)))
        .when(style == 1, F.concat_ws("-", word(1), word(2), word(3), (F.col("id") % 100).cast("string")))
        .when(style == 2, F.concat(word(1), F.initcap(word(2)), F.initcap(word(3))))
        .when(style == 3, F.concat_ws("/", F.initcap(word(1)), word(2), word(3)))
        .when(style == 4, F.concat(word(1), word(2), word(3)))
        .otherwise(F.upper(F.concat_ws("_", word(1), word(2), word(3))))
    )
    return random.unionByName(d.where("id % 2 = 1").select(name.alias("sample"), F.lit(False).alias("random")))


def train(samples: DataFrame, smoothing: float = 0.5) -> list[float]:
    """Log-likelihood ratio of every transition between two characters of the alphabet, row by row.
    One count per transition and label comes to the driver."""
    pairs = samples.select("random", F.explode(F.expr("transform(sequence(1, greatest(length(sample) - 1, 1)), i -> substr(sample, i, 2))")).alias("pair"))
    n, at = len(ALPHABET), {c: k for k, c in enumerate(ALPHABET)}
    seen = {True: [[smoothing] * n for _ in range(n)], False: [[smoothing] * n for _ in range(n)]}
    for label, pair, count in pairs.where("length(pair) = 2").groupBy("random", "pair").count().collect():
        if label is not None and pair[0] in at and pair[1] in at:
            seen[label][at[pair[0]]][at[pair[1]]] += count
    share = {label: [[x / sum(row) for x in row] for row in table] for label, table in seen.items()}
    return [math.log(a / b) for rs, rr in zip(share[True], share[False], strict=True) for a, b in zip(rs, rr, strict=True)]


def sums_before(lengths: Column) -> Column:
    """For each element, the sum of all before it: block sums, then sums within the block."""
    total = lambda a: F.aggregate(a, F.lit(0), lambda x, y: x + y)
    blocks = lambda ls: F.transform(F.sequence(F.lit(0), F.floor((F.size(ls) - 1) / BLOCK).cast("int")), lambda b: total(F.slice(ls, b * BLOCK + 1, BLOCK)))
    return let(lengths, lambda ls: let(blocks(ls), lambda bs: let(
        F.transform(bs, lambda _, b: total(F.slice(bs, F.lit(1), b))),
        lambda heads: F.transform(ls, lambda _, i: heads[F.floor(i / BLOCK).cast("int")] + total(F.slice(ls, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK))),
    )))


EMPTY = "array<struct<start:int,rank:int,end:int,kind:string>>"


def matches(text: Column, kind: str, rank: int, pattern: str, keep: Callable[[Column], Column], group: int = 0) -> Column:
    """Spans of the matches for which ``keep`` of the group's text holds."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)

    def spans(m: Column) -> Column:
        steps = F.zip_with(gaps, m, lambda g, x: F.length(g) + F.coalesce(F.length(x), F.lit(0)))
        return let(steps, lambda st: let(sums_before(st), lambda before: F.filter(
            F.zip_with(F.arrays_zip(m.alias("m"), judged.alias("g")), F.zip_with(before, st, lambda b, s: b + s), lambda x, end: F.when(
                x["m"].isNotNull() & keep(x["g"]),
                F.struct((end - F.length(x["m"])).cast("int").alias("start"), F.lit(rank).alias("rank"), end.cast("int").alias("end"), F.lit(kind).alias("kind")),
            )),
            lambda s: s.isNotNull(),
        )))

    return let(found, spans)


def score(token: Column, table: Column) -> Column:
    """Mean log-likelihood ratio of a token's transitions, a random string against an identifier."""
    n = len(ALPHABET)
    codes = F.transform(F.split(token, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def mean(cs: Column) -> Column:
        total = F.aggregate(F.sequence(F.lit(1), F.size(cs) - 1), F.lit(0.0), lambda a, i: a + F.get(table, cs[i - 1] * n + cs[i]))
        return total / (F.size(cs) - 1)

    return let(codes, mean)


def covered(spans: Column) -> Column:
    """A byte for each code point as far as sorted spans that don't overlap reach: 1 inside of them."""
    gap = lambda s, i: F.repeat(F.lit("0"), s["start"] - F.when(i > 0, F.get(spans, i - 1)["end"]).otherwise(0))
    return F.array_join(F.transform(spans, lambda s, i: F.concat(gap(s, i), F.repeat(F.lit("1"), s["end"] - s["start"]))), "").cast("binary")


def apart(spans: Column, base: Column) -> Column:
    """Those of the spans that share no character with ``base``. What each kind of base covers is laid out once and
    looked up by place, so the work grows with the text and not with the product of both."""
    of = lambda rank: let(F.filter(base, lambda b: b["rank"] == rank), covered)
    masks = F.array(*map(of, range(len(BASE))))
    met = lambda m, s: F.contains(F.substring(m, s["start"] + 1, s["end"] - s["start"]), F.lit(b"1"))
    return let(masks, lambda ms: F.filter(spans, lambda s: ~F.exists(ms, lambda m: met(m, s))))


def scan(docs: DataFrame, table: list[float], text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with ``base`` and ``found``: arrays of start, rank, end, kind; found holds base, too."""
    raw = F.coalesce(F.col(text_col), F.lit(""))
    none = F.expr(f"cast(array() as {EMPTY})")
    ratios = F.lit(table)
    base = [
        F.when(raw.rlike(QUICK[kind]), matches(raw, kind, k, pattern, lambda g, least=least: F.length(g) >= least, group)).otherwise(none)
        for k, (kind, pattern, group, least) in enumerate(BASE)
    ]
    out = docs.withColumn("base", F.array_sort(F.concat(*base)))
    judged = matches(raw, "random", len(BASE), f"{TOKEN}{{{TOKEN_LENGTH},}}", lambda g: score(g, ratios) > threshold)
    more = F.when(raw.rlike(f"{TOKEN}{{{TOKEN_LENGTH}}}"), F.when(F.size("base") == 0, judged).otherwise(apart(judged, F.col("base")))).otherwise(none)
    return out.withColumn("found", F.array_sort(F.concat(F.col("base"), more)))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")
