"""Boilerplate lines: those that stand on many distinct sites.

Every non-empty line (spaces at its ends removed) is hashed; HyperLogLog sketches of the sites are
built per line hash on the map side and merged by the aggregation. Lines clearly above or below the
threshold are decided by the estimate; lines near it get an exact distinct count.

Hot lines are pre-aggregated in every count, and the joins from rows to lines have one row per line on
the small side, so adaptive execution can split them. Defined results: a null text has one empty line, a
null site is a site of its own, empty lines always stay, a line repeated in one text goes each time. Texts, not
ids, tell which lines a row loses (by 128 bits of hash), so ids may be null or repeat however often; equal texts lose the same lines.
A very long text is one row as any other, and takes time in proportion to its lines. An empty table gives no rows; columns
n_lines and n_removed are replaced, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxelmill.llm.storage import materialise

MIN_SITES, LG_K, BAND = 5, 12, 0.15


def keys(line: Column) -> list[Column]:
    """Two 64-bit hashes of a trimmed line."""
    return [F.xxhash64(F.trim(line)), F.xxhash64(F.lit("line"), F.trim(line))]


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def text_keys(text: Column) -> list[Column]:
    """Two 64-bit hashes of a whole text."""
    return [F.xxhash64(text), F.xxhash64(F.lit("text"), text)]


def line_rows(docs: DataFrame, text_col: str, site_col: str) -> DataFrame:
    """A row for each line that isn't empty: its text, its place there, its site, and its hashes."""
    t1, t2 = text_keys(F.col(text_col))
    site = F.xxhash64(F.coalesce(F.col(site_col).cast("string"), F.lit("\0"))).alias("_site")
    # a text is hashed once, before its lines become rows
    texts = docs.select(t1.alias("_t1"), t2.alias("_t2"), site, split_lines(F.col(text_col)).alias("_lines"))
    lines = texts.select("_t1", "_t2", "_site", F.posexplode("_lines").alias("_pos", "_line")).where(F.trim("_line") != "")
    h1, h2 = keys(F.col("_line"))
    return lines.select("_t1", "_t2", "_pos", "_site", h1.alias("_h1"), h2.alias("_h2"))


def spread(rows: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K, band: float = BAND) -> DataFrame:
    """_h1, _h2 of the lines on at least ``min_sites`` distinct sites."""
    key = ["_h1", "_h2"]
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(lg_k))).alias("sites")
    sketched = materialise(rows.groupBy(*key).agg(sketch).where(F.col("sites") >= min_sites * (1 - band)))
    near = sketched.where(F.col("sites") <= min_sites * (1 + band)).select(*key)
    # one row per line and site before the join, so a hot line has as many rows as sites
    each = rows.groupBy(*key, "_site").agg(F.lit(1).alias("one"))
    exact = each.join(near, key, "left_semi").groupBy(*key).agg(F.count("one").alias("sites"))
    sure = sketched.where(F.col("sites") > min_sites * (1 + band))
    return sure.select(*key).unionByName(exact.where(F.col("sites") >= min_sites).select(*key))


def remove_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the text cleaned and columns n_lines (of all lines) and n_removed, which replace
    columns of these names."""
    docs = docs.drop("n_lines", "n_removed")
    rows = materialise(line_rows(docs, text_col, site_col))
    common = materialise(spread(rows, min_sites))
    own = ["_t1", "_t2"]
    # the places of a text's common lines, once however many rows have the text
    found = rows.join(common, ["_h1", "_h2"]).groupBy(*own, "_pos").agg(F.lit(1).alias("_one")).groupBy(*own).agg(F.collect_list("_pos").alias("gone"))
    # a user's columns stand in a struct, so no name of theirs meets one of these
    t1, t2 = text_keys(F.col(text_col))
    joined = docs.select(F.struct("*").alias("row"), t1.alias("_t1"), t2.alias("_t2")).join(found, own, "left")
    out = joined.withColumn("lines", split_lines(F.col(f"row.`{text_col}`")))
    places = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone"))
    kept = F.transform(places, lambda i: F.get(F.col("lines"), i))
    out = out.withColumn("kept", F.when(F.size("gone") > 0, kept).otherwise(F.col("lines")))
    return out.select(
        *(F.col(f"row.`{c}`") for c in docs.columns if c != text_col), F.array_join("kept", "\n").alias(text_col),
        F.size("lines").cast("long").alias("n_lines"), (F.size("lines") - F.size("kept")).cast("long").alias("n_removed"),
    )
