"""What stands beside the voxels: layouts, codecs, headers, attributes, projections, options."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelmill.functions import orientation
from voxelmill.operators import grid
from voxelmill.plans import layout, levels
from voxelmill.plans.config import ArrayOptions, HeaderOptions, autoconfig, default_output
from voxelmill.queries import query
from voxelmill.queries.conversions import BASE
from voxelmill.queries.metadata import ORIENTED, oriented
from voxelmill.queries.views import SIDE, VOLUME, WIDTH, depth, read, shape, volume
from voxelmill.sinks import extras
from voxelmill.sinks import zarr as sink
from voxelmill.sources import nifti, optional
from voxelmill.sources.shared import scratch
from voxelmill.sources.zarr import attributes

ARROW = {"long": pa.int64(), "double": pa.float64(), "string": pa.string()}


def each(rows: DataFrame, make: Callable[[dict], tuple], **kinds: str) -> DataFrame:
    """A plain function of every row, by Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(zip(*map(make, batch.to_pylist()), strict=True)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, ARROW[k]) for c, k in zip(made, kinds.values(), strict=True)], list(kinds))

    return rows.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in kinds.items()))


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("id"), F.col("p_size").cast("long").alias("size"))


PARTS = "p as (select cast(p_partkey as bigint) as id, cast(p_size as bigint) as size from part)"


@query(f"""with {PARTS}, r as (select id, size * 16 as s0, 64 as s1, case when id % 4 = 0 then size * 16 else 1 + id % 40 end as c0, case when id % 3 = 0 then 64 else 16 end as c1,
  1 + id * 7 % 200 as d0, 1 + id % 130 as d1 from p),
k as (select *, case when c0 = s0 and s0 <> d0 then d0 else c0 end as k0, case when c1 = s1 and s1 <> d1 then d1 else c1 end as k1 from r)
select id, cast(k0 as bigint) as chunk0, cast(k1 as bigint) as chunk1, cast((d0 + k0 - 1) // k0 * k0 as bigint) as shard0, cast((d1 + k1 - 1) // k1 * k1 as bigint) as shard1 from k""")
def shard_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make(r: dict) -> tuple:
        k, size = r["id"], r["size"] * 16
        chunk, shard = layout.reconciled((size, 64), (size if k % 4 == 0 else 1 + k % 40, 64 if k % 3 == 0 else 16), (1 + k * 7 % 200, 1 + k % 130))
        return k, *chunk, *shard

    return each(parts(spark, sf_dir), make, id="long", chunk0="long", chunk1="long", shard0="long", shard1="long")


@query(f"""with {PARTS}, r as (select id, 1 + id % 6 as ndim, 1 + id % 4 as t, 1 + id % 3 as c, id % 2 = 0 as cc, id % 5 <> 0 as ct, id % 7 = 0 as nt, id % 3 = 0 as sc, id % 2 = 1 as st from p),
l as (select id, ndim, case ndim when 5 then (case when ct then 1 else t end) || ',' || (case when cc then 1 else c end) || ',' when 4 then (case when (nt and cc) or (not nt and ct) then 1 else c end) || ',' else '' end as a,
  case ndim when 5 then (case when ct and st then 1 else t end) || ',' || (case when cc and sc then 1 else c end) || ',' when 4 then (case when (nt and cc and sc) or (not nt and ct and st) then 1 else c end) || ',' else '' end as b from r)
select id, case when ndim in (1, 6) then null when ndim = 2 then '64,64' else a || '64,64,64' end as chunk, case when ndim in (1, 6) then null when ndim = 2 then '128,128' else b || '128,128,128' end as shard from l""")
def chunk_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layouts of arrays of one to six axes; what has no layout is null."""

    def make(r: dict) -> tuple:
        k = r["id"]
        o = ArrayOptions(chunk=(64,), shard=(128,), chunk_channels=k % 2 == 0, chunk_time=k % 5 != 0, no_time=k % 7 == 0, shard_channels=k % 3 == 0, shard_time=k % 2 == 1)
        try:
            chunk, shard = layout.layout((2, 1 + k % 4, 1 + k % 3, r["size"], 300, 700)[5 - k % 6 :], 2, o)
        except ValueError:
            return k, None, None
        return k, ",".join(map(str, chunk)), ",".join(map(str, shard or ()))

    return each(parts(spark, sf_dir), make, id="long", chunk="string", shard="string")


@query(f"""with recursive {PARTS}, n as (select id, (size * 100 + 127) // 128 as na, (1000 + id % 50 * 60 + 127) // 128 as nb, 32 as nc from p),
grow as (
  select id, na, nb, nc, least(na, 10) as a, least(nb, 10) as b, least(nc, 10) as c, true as go from n
  union all select id, na, nb, nc, a2, b2, c2, a2 <> a or b2 <> b or c2 <> c from (
    select *, case when c < nc and a2 * b2 * (c + 1) <= 1024 then c + 1 else c end as c2 from (
      select *, case when b < nb and a2 * (b + 1) * c <= 1024 then b + 1 else b end as b2 from (
        select *, case when a < na and (a + 1) * b * c <= 1024 then a + 1 else a end as a2 from grow where go)))
)
select id, cast(a * 128 as bigint) as z, cast(b * 128 as bigint) as y, cast(c * 128 as bigint) as x from grow where not go""")
def shard_automatic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of 128-voxel chunks of 2 bytes, of 4 GiB at most before compression."""

    def make(r: dict) -> tuple:
        return r["id"], *(layout.layout((r["size"] * 100, 1000 + r["id"] % 50 * 60, 4000), 2, ArrayOptions(shard="auto"))[1] or ())

    return each(parts(spark, sf_dir), make, id="long", z="long", y="long", x="long")


@query(f"""with {PARTS}, s as (select id, size * 100 as z, 30000 + id as y, 64000 as x from p),
k as (select id, z, y, x, max(k) as k from s, (select unnest(range(41)) as k) where least(1::hugeint << k, z) * least(1::hugeint << k, y) * least(1::hugeint << k, x) <= 1::hugeint << 41 group by all)
select id, cast(pow(2, ceil(log2(least(1::bigint << k, z)))) as bigint) as z, cast(pow(2, ceil(log2(least(1::bigint << k, y)))) as bigint) as y, cast(pow(2, ceil(log2(least(1::bigint << k, x)))) as bigint) as x from k""")
def shard_doubled(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make(r: dict) -> tuple:
        return r["id"], *layout.doubled_shard((r["size"] * 100, 30000 + r["id"], 64000), 2)

    return each(parts(spark, sf_dir), make, id="long", z="long", y="long", x="long")


_COMPRESSORS = ("blosc", "zstd", "gzip", "zlib", "none")


@query(f"""with {PARTS}, known(version, given, codec, level) as (values (2, 'blosc', 'blosc', 5), (2, 'zstd', 'zstd', 5), (2, 'gzip', 'zlib', 5), (2, 'zlib', 'zlib', 5), (2, 'none', null, null),
  (3, 'blosc', 'blosc', 5), (3, 'zstd', 'zstd', 5), (3, 'gzip', 'gzip', 5), (3, 'zlib', 'gzip', 5), (3, 'none', null, null))
select id, cast(version as bigint) as version, given, codec, cast(level as bigint) as level from p join known on version = 2 + id % 2 and given = {list(_COMPRESSORS)!r}[id % 5 + 1]""")
def compressor_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The codec that an array's metadata name for each compressor option, in both versions."""

    def make(r: dict) -> tuple:
        version, given = 2 + r["id"] % 2, _COMPRESSORS[r["id"] % 5]
        doc = sink.array_document([4], [4], None, "int16", ArrayOptions(zarr_version=version, compressor=given))
        if version == 2:
            codec = doc["compressor"] or {}
            name, options = codec.get("id"), codec
        else:
            name, options = next(((c["name"], c["configuration"]) for c in doc["codecs"] if c["name"] != "bytes"), (None, {}))
        return r["id"], version, given, name, options.get("level", options.get("clevel"))

    return each(parts(spark, sf_dir), make, id="long", version="long", given="string", codec="string", level="long")


@query(f"""select cast(a as bigint) as axis, cast(case a when 0 then {WIDTH} when 1 then {SIDE} else max(vec_id) // {SIDE} + 1 end as bigint) as size, case a when 0 then 0.5 when 1 then 2.0 else 3.0 end::double as zoom,
  case a when 0 then -0.5 when 1 then 2.0 else 3.0 end::double as diagonal, 'int32' as dtype, 'micron' as unit from embeddings, (select unnest([0, 1, 2]) as a) group by a""")
def header_beside_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header written into a group of each version and read back; both must agree."""
    zooms = (0.5, 2.0, 3.0)
    h = nifti.image_header(list(shape(spark, sf_dir).values()), "int32", orientation.affine("LAS", zooms), zooms, "micron")
    got = []
    for version in (2, 3):
        path, o = scratch(spark), ArrayOptions(zarr_version=version)
        sink.create_group(path, o)
        extras.write_header(path, h, o)
        got.append(nifti.load_header(path))
    if got[0] != got[1]:
        raise ValueError("the versions' headers differ")
    rows = [(k, got[0].shape[k], got[0].zooms[k], got[0].affine[k][k], got[0].dtype, got[0].space_unit) for k in range(3)]
    return spark.createDataFrame(rows, "axis long, size long, zoom double, diagonal double, dtype string, unit string")


@query(f"""with n as (select max(vec_id) // {SIDE} + 1 as d from embeddings), top as (select greatest(cast(ceil(log2((d + 7) // 8)) as bigint), 2) as top from n),
l as (select unnest(range(top + 1)) as level from top)
select version, level, axis, 'space' as kind, 'millimeter' as unit, size * (1 << level) as scale, size * ((1 << level) - 1) / 2 as moved
from l, (values ('z', 3.0::double), ('y', 2.0::double), ('x', 0.5::double)) a(axis, size), (values ('0.4'), ('0.5')) v(version)""")
def multiscale_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-scale metadata of an image, copied to another group beside what stands there, read from there."""
    top = levels.default_levels(list(shape(spark, sf_dir).values()), (8, 8, 16))
    rows = []
    for version, key in (("0.4", "multiscales"), ("0.5", "ome")):
        image, mask = scratch(spark), scratch(spark)
        for path in (image, mask):
            sink.create_group(path, ArrayOptions(ome_version=version))
        sink.update_attributes(image, levels.multiscales("zyx", top, (3.0, 2.0, 0.5), "millimeter", version=version))
        sink.update_attributes(mask, {"own": 1})
        sink.update_attributes(mask, {key: attributes(image)[key]})
        found = attributes(mask)
        if found["own"] != 1:
            raise ValueError("an attribute is lost")
        body = (found["multiscales"] if version == "0.4" else found["ome"]["multiscales"])[0]
        for d in body["datasets"]:
            scale, moved = (d["coordinateTransformations"][k][n] for k, n in enumerate(("scale", "translation")))
            rows += [(version, int(d["path"]), a["name"], a["type"], a["unit"], float(s), float(m)) for a, s, m in zip(body["axes"], scale, moved, strict=True)]
    return spark.createDataFrame(rows, "version string, level long, axis string, kind string, unit string, scale double, moved double")


@query(f"with {VOLUME} select y, x, cast(max(v) + {BASE} as bigint) as v from vol group by y, x")
def mip_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The projection's PNG, made and decoded strip by strip: 16-bit rows, each behind a zero byte."""
    size, path = list(shape(spark, sf_dir).values()), scratch(spark) + ".png"
    raised = volume(spark, sf_dir).withColumn("v", F.col("v") + BASE)
    extras.write_projection(path, grid.pack(raised, size, [8, 8, 16], "uint16"), size, "uint16", rows=3)
    return extras.read_image(spark, path)


@query(f"""with {PARTS} select id, case when id % 5 in (1, 2) then 1.0 else size / 4 end::double as width, case when id % 5 in (1, 2) then 1.0 else id / 8 end::double as height from p""")
def xmp_pixel_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes in XMP packets: as attributes, as elements, one missing, broken, none."""

    def make(r: dict) -> tuple:
        w, h = f"{r['size'] / 4}", f"{r['id'] / 8}"
        text = (f"<a PixelWidth='{w}' PixelHeight='{h}'/>", f"<a PixelWidth='{w}'/>", f"<a PixelWidth='{w}' PixelHeight=", f"<a xmlns:t='u'><t:PixelWidth>{w}</t:PixelWidth><t:PixelHeight>{h}</t:PixelHeight></a>", f"<a><b PixelHeight='{h}' PixelWidth='{w}'/></a>")
        return r["id"], *optional.pixel_size(text[r["id"] % 5].encode())

    return each(parts(spark, sf_dir), make, id="long", width="double", height="double")


@query(f"""with {PARTS}, l as (select id, id % 6 as level, 100 + size * 37 as h, 90 + id % 1000 as w from p), s as (select *, (h + (1 << level) - 1) >> level as lh, (w + (1 << level) - 1) >> level as lw from l)
select id, level, cast(lh as bigint) as height, cast(lw as bigint) as width, cast(least((lh // 3) << level, h) as bigint) as top, cast(least(lh << level, h) as bigint) as bottom,
  cast(least((lw // 2) << level, w) as bigint) as "left", cast(least(lw << level, w) as bigint) as "right" from s""")
def wavelet_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of an image at a wavelet level, and the part of the image that a level's box stands for."""

    def make(r: dict) -> tuple:
        level, full = r["id"] % 6, (100 + r["size"] * 37, 90 + r["id"] % 1000)
        h, w = optional.level_shape(full, level)
        top, left, bottom, right = optional.level_area((h // 3, h), (w // 2, w), level, full)
        return r["id"], level, h, w, top, bottom, left, right

    return each(parts(spark, sf_dir), make, **dict.fromkeys(("id", "level", "height", "width", "top", "bottom", "left", "right"), "long"))


_WRITERS = ("spark", "zarr-python", "tensorstore", "none")


@query(f"""with {PARTS} select id, case when id % 11 = 0 then 'TypeError' when id % 4 = 3 then 'UnsupportedDriverError' when id % 3 = 0 and id % 2 = 0 then 'ValueError'
  else 'scan' || id || case when id % 5 = 0 then '.ome.zarr ' else '.nii.zarr ' end || size || ' ' || (case when id % 3 = 0 then '64' else 'no' end) || ' RAS' end as outcome from p""")
def options_given_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Options given flat find their groups; unknown ones, unknown writers and shards in version 2 are errors."""

    @autoconfig
    def convert(path: str, *, array: ArrayOptions, header: HeaderOptions) -> str:
        return f"{default_output(path, header)} {array.levels} {array.shard[0] if array.shard else 'no'} {header.orientation}"

    def make(r: dict) -> tuple:
        k = r["id"]
        given = {"zarr_version": 2 + k % 2, "driver": _WRITERS[k % 4], "levels": r["size"], "nii": k % 5 != 0}
        given |= ({"shard": (64,)} if k % 3 == 0 else {}) | ({"nothing": 1} if k % 11 == 0 else {})
        try:
            return k, convert(f"/data/scan{k}.mat", **given)
        except (TypeError, ValueError) as error:
            return k, type(error).__name__

    return each(parts(spark, sf_dir), make, id="long", outcome="string")


@query(f"""with {ORIENTED}, asked as (select id, code, case when id % 3 > 0 and code = 'RAS' and id % 2 = 0 then true else false end as stands, id % 2 = 1 as center from o join full_code using (given)),
e as (select id, r, sum(e) as total, sum(e * (shape[a] - 1)) as far from m group by id, r)
select id, sum(case when stands then 7.0 * r else total end) as turned, sum(case when stands then 5.0 * r when center then -0.5 * far else 0.0 end) as moved from e join asked using (id) group by id""")
def affine_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header's matrix stands unless there is none, another orientation or centring is asked for. Sums of
    the matrix's two parts tell which was taken."""
    held = F.array(*(F.array(F.lit(7.0 * r), F.lit(0.0), F.lit(0.0), F.lit(5.0 * r)) for r in (1, 2, 3)), F.array(*map(F.lit, (0.0, 0.0, 0.0, 1.0))))
    m = oriented(spark, sf_dir)
    m = m.withColumn("m", orientation.chosen_col(F.when(F.col("id") % 3 > 0, held), F.col("code"), F.col("vx"), F.col("shape"), F.col("id") % 2 == 1))
    rows = [F.col("m")[r] for r in range(3)]
    return m.select("id", sum((r[k] for r in rows for k in range(3)), F.lit(0.0)).alias("turned"), sum((r[3] for r in rows), F.lit(0.0)).alias("moved"))
