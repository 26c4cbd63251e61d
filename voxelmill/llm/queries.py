"""One query per operator over its whole table, and DuckDB SQL where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelmill.llm import decontam, exact, lines, minhash, packing, passages, phrases, pii, ranking, secret_scan, sharding, toxicity, vectors
from voxelmill.llm.storage import scratch, table

SHARDS = 16


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    ratios = secret_scan.train(secret_scan.labelled_samples(spark))
    found = secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), ratios)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *(count(kind) for kind, *_ in secret_scan.BASE),
        F.sha2(secret_scan.as_text(F.col("base")), 256).alias("base_sha256"), secret_scan.as_text(F.col("found")).alias("spans"),
    )


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.classes(table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.remove_boilerplate(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    names = F.array(*map(F.lit, pii.KINDS))
    count = lambda k, kind: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{kind}")
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])), ",")
    return found.select("doc_id", *(count(k, kind) for k, kind in enumerate(pii.KINDS)), F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op6_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = sharding.slotted(table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.xxhash64(text).alias("text_hash"),
    ), ["doc_id", "text_hash", "text_crc32"])
    maps = scratch(spark)
    sharding.SlotMap.plan(sharding.slot_bytes(rows), SHARDS).store(spark, maps)
    mapping = sharding.SlotMap.load(spark, maps)
    out = sharding.shard(rows, mapping, ["doc_id", "text_crc32", "size"])
    return out.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot", F.lit(mapping.version).alias("map_version")
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.deduplicate(*exact.halves(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op9_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = passages.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.phrases(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_secret_scan, op2_near_dedup, op3_line_dedup, op4_toxicity, op5_personal_data, op6_virtual_slots, op7_decontamination, op8_exact_dedup, op9_length_buckets, op10_repeated_passages, op11_near_vectors, op12_ranked_search, op13_phrases)}


def oracle_sql() -> dict[str, str]:
    return {"op2_near_dedup": NEAR, "op3_line_dedup": LINES, "op8_exact_dedup": EXACT, "op10_repeated_passages": PASSAGES, "op11_near_vectors": VECTORS, "op12_ranked_search": RANKED, "op13_phrases": PHRASES}


NEAR = f"""
with recursive words as (select doc_id, regexp_extract_all(lower(coalesce(text, '')), '[0-9a-z_\\x{{80}}-\\x{{10FFFF}}]+') as w from documents),
shingles as (
  select doc_id, unnest([array_to_string(w[i:i + {minhash.WORDS - 1}], ' ') for i in range(1, greatest(len(w) - {minhash.WORDS - 2}, 2))]) as s
  from words where len(w) > 0
),
sets as (select doc_id, s, count(*) as c from shingles group by all),
sizes as (select doc_id, sum(c) as n from sets group by 1),
common as (select a.doc_id as a, b.doc_id as b, sum(least(a.c, b.c)) as c from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b where c >= {minhash.SIMILAR} * (x.n + y.n - c) - 1e-9),
reach(a, b) as (
  select doc_id, doc_id from documents
  union select r.a, l.b from reach r join (select a, b from links union all select b, a from links) l on r.b = l.a
),
class as (select a as doc_id, min(b) as class_id, count(*) as class_size from reach group by 1)
select doc_id, class_id, class_size, doc_id = class_id as kept, coalesce(n, 0)::bigint as n_shingles from class left join sizes using (doc_id)
"""

PASSAGES = f"""
with raw as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
sizes as (select doc_id, x, length(x) // 2 as n from raw),
blocks as (select doc_id, n, unnest(range(0, n - {passages.DEPTH - 1}, 500)) as p, x from sizes where n >= {passages.DEPTH}),
pieces as (select doc_id, p, substr(x, 2 * p + 1, 2 * {passages.DEPTH + 499}) as x, least(500, n - {passages.DEPTH - 1} - p) as k from blocks),
starts as (select doc_id, p, x, unnest(range(0, k)) as i from pieces),
strings as (select doc_id, p + i as pos, md5(substr(x, 2 * i + 1, 2 * {passages.DEPTH})) as h from starts),
twice as (select h from strings group by 1 having count(*) > 1),
hits as (select doc_id, pos from strings join twice using (h)),
marked as (select doc_id, pos, case when pos <= lag(pos) over (partition by doc_id order by pos) + {passages.DEPTH} then 0 else 1 end as new from hits),
runs as (select doc_id, pos, sum(new) over (partition by doc_id order by pos) as run from marked),
gone as (select doc_id, run, min(pos) as a, max(pos) + {passages.DEPTH} as b from runs group by all),
cuts as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as after, lead(a) over (partition by doc_id order by a) is null as last from gone),
kept as (
  select doc_id, sum(b - a) as n_removed, count(*) as n_spans, string_agg(substr(x, 2 * after + 1, 2 * (a - after)) || case when last then substr(x, 2 * b + 1) else '' end, '' order by a) as x
  from cuts join sizes using (doc_id) group by doc_id
)
select doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(k.x, s.x))) as kept_sha256 from sizes s left join kept k using (doc_id)
"""


LINES = f"""
with split as (select doc_id, source, string_split(coalesce(text, ''), chr(10)) as parts from documents),
each as (select doc_id, source, unnest(parts) as line, unnest(range(len(parts))) as no from split),
common as (
  select trim(line, ' ') as line from each where trim(line, ' ') <> ''
  group by 1 having count(distinct coalesce(source, chr(1))) >= {lines.MIN_SITES}
),
kept as (
  select doc_id, count(*) as n_lines, count(c.line) as n_removed,
    coalesce(string_agg(e.line, chr(10) order by no) filter (c.line is null), '') as text
  from each e left join common c on trim(e.line, ' ') = c.line group by doc_id
)
select doc_id, n_lines, n_removed, sha256(text) as kept_sha256 from kept
"""

EXACT = """
with n as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
),
g as (select t, max(doc_id) as keep_id, count(*) as group_size from n group by t)
select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(t) as text_sha256 from n join g using (t)
"""

VECTORS = """
with recursive usable as (
  select row_number() over () as no, vec_id, label, embedding::double[] as v,
    label is not null and coalesce(len(embedding) > 0 and list_bool_and([x is not null and isfinite(x) for x in embedding]) and list_bool_or([x <> 0 for x in embedding]), false) as ok
  from embeddings
),
links as (
  select a.no as a, b.no as b from usable a join usable b on a.label = b.label and len(a.v) = len(b.v) and a.no <> b.no and a.ok and b.ok
  where list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98
),
reach(a, b) as (select no, no from usable union select r.a, l.b from reach r join (select a, b from links) l on r.b = l.a),
least as (select r.a as no, min(u.vec_id) as component_id from reach r join usable u on u.no = r.b group by 1),
degree as (select a as no, count(*) as n from links group by 1)
select vec_id, coalesce(n, 0)::bigint as n_links, component_id, coalesce(vec_id = component_id, false) as kept from usable join least using (no) left join degree using (no)
"""

RANKED = """
with d as (select row_number() over () as no, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+') as w from documents),
i as (select row_number() over () as item, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9A-Za-z\\x{80}-\\x{10FFFF}]+')) as term from benchmark),
q as (select item, item_id, term, count(*) as q from i group by all),
s as (select count(*) as docs, sum(len(w))::bigint as total from d where len(w) > 0),
each as (select no, doc_id, len(w) as n, unnest(w) as term from d),
p as (select no, doc_id, n, term, count(*) as tf from each where term in (select term from q) group by all),
df as (select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w from p, s group by term, docs),
scores as (
  select item, item_id, no, doc_id, sum(q * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::bigint as score
  from p join df using (term) join q using (term), s group by item, item_id, no, doc_id
),
ranked as (select *, row_number() over (partition by item order by score desc, doc_id, no) as rank from scores where score > 0)
select item_id, rank::int as rank, doc_id, score from ranked where rank <= 20
"""

PHRASES = f"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) as piece from documents
),
w as (select lang, regexp_extract_all(piece, '[^\\x20\\x09]+') as w from pieces),
totals as (select lang, sum(len(w))::hugeint as n from w group by 1),
grams as (select lang, k, unnest([w[i:i + k - 1] for i in range(1, len(w) - k + 2)]) as p from w, (select unnest(range(1, {phrases.WORDS + 1})) as k) where len(w) >= k),
f as (select lang, k, p, count(*) as a from grams group by all having count(*) >= {phrases.LEAST}),
cuts as (
  select c.lang, c.p, c.a, c.k, x.k as cut, x.a as l, y.a as r, n, (1000 * c.a::hugeint * n) // (x.a::hugeint * y.a) as score
  from f c join f x on x.lang = c.lang and x.k < c.k and x.p = c.p[1:x.k] join f y on y.lang = c.lang and y.p = c.p[x.k + 1:] join totals t on t.lang = c.lang
),
scored as (select *, row_number() over (partition by lang, p order by score, cut) as no from cuts),
inner_ as (select lang, p[s:s + m - 1] as p, max(a) as within from (select lang, p, a, k, m, unnest(range(1, k - m + 2)) as s from (select *, unnest(range(2, k)) as m from f where k > 2)) group by all),
kept as (select s.*, array_to_string(s.p, ' ') as phrase from scored s left join inner_ i on i.lang = s.lang and i.p = s.p where no = 1 and (within is null or 100 * within < 100 * s.a)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from kept)
select lang, rank, phrase, a, l, r, n::bigint as n, score::bigint as score from ranked where rank <= {phrases.FIRST}
"""
