"""Units, orientation, metadata texts and documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelmill.functions import metadata_text, naming, orientation, units
from voxelmill.queries import query
from voxelmill.queries.views import NOTES, notes, read


_N = metadata_text.NUMBER
_THREE, _ONE = f"^({'x'.join([_N] * 3)})(\\w*)\\.?$", f"^({_N})(\\w*)\\.?$"
_LINE = "trim(regexp_extract(note, '(?:^|\\n){}: *([^\\n]*)', 1))"


@query(f"""with {NOTES}, l as (select id, {_LINE.format('Voxel size')} as t from notes)
select id, t as "text", cast(string_split(regexp_extract(t, '{_THREE}', 1), 'x')[1] as double) as a, cast(string_split(regexp_extract(t, '{_THREE}', 1), 'x')[2] as double) as b,
  cast(string_split(regexp_extract(t, '{_THREE}', 1), 'x')[3] as double) as c, regexp_extract(t, '{_THREE}', 2) as unit from l""")
def value_unit_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = notes(spark, sf_dir).select("id", metadata_text.line_col(F.col("note"), "Voxel size").alias("text"))
    value = metadata_text.value_col(F.col("text"), 3)
    return lines.select("id", "text", value[0].alias("a"), value[1].alias("b"), value[2].alias("c"), metadata_text.unit_col(F.col("text"), 3).alias("unit"))


@query(f"""with {NOTES}, l as (select id, {_LINE.format('Image medium')} as medium, {_LINE.format('Center Wavelength')} as wave, {_LINE.format('Slice thickness')} as thick,
  {_LINE.format('Number of slices')} as slices, {_LINE.format('Number of focuses')} as focuses, nullif({_LINE.format('Modality')}, '') as modality from notes)
select id, 'BRAIN' as body_part, replace(medium, 'TDE', '{metadata_text.TDE.replace("'", "''")}') as medium, cast(regexp_extract(wave, '{_ONE}', 1) as double) as wavelength, regexp_extract(wave, '{_ONE}', 2) as wavelength_unit,
  round(cast(regexp_extract(thick, '{_ONE}', 1) as double) * case regexp_extract(thick, '{_ONE}', 2) when 'mm' then 1000 else 1 end, 6) as thickness,
  cast(slices as bigint) as slices, cast(focuses as bigint) as focuses, modality from l""")
def meta_text_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The document of each text, written as JSON and read back as columns."""
    written = notes(spark, sf_dir).select("id", F.to_json(metadata_text.document_col(F.col("note"))).alias("json"))
    d = F.from_json("json", "BodyPart string, SampleMedium string, Wavelength double, WavelengthUnit string, SliceThickness double, SliceCount long, FocusCount long, OCTModality string")
    return written.select("id", d.alias("d")).select(
        "id", F.col("d.BodyPart").alias("body_part"), F.col("d.SampleMedium").alias("medium"), F.col("d.Wavelength").alias("wavelength"), F.col("d.WavelengthUnit").alias("wavelength_unit"),
        F.round("d.SliceThickness", 6).alias("thickness"), F.col("d.SliceCount").alias("slices"), F.col("d.FocusCount").alias("focuses"), F.col("d.OCTModality").alias("modality"),
    )


_UNITS = ["um", "mm", "cm", "m", "km", "nm", "in", "ft", "micron", "millimeter", "s", "ms", "h", "day"]


def _measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, _UNITS))
    pick = lambda k: F.get(names, F.pmod(k, F.lit(len(_UNITS))).cast("int"))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").cast("double").alias("value"), pick(F.col("p_partkey")).alias("a"), pick(F.col("p_partkey") + F.col("p_size")).alias("b"))


_MEASURED = f"""u as (select {_UNITS!r} as names), measured as (select p_partkey as id, cast(p_size as double) as value,
  names[p_partkey % {len(_UNITS)} + 1] as a, names[(p_partkey + p_size) % {len(_UNITS)} + 1] as b from part, u)"""


@query(f"""with {_MEASURED}, scale(name, s) as (values ('um', 1e-6), ('mm', 1e-3), ('cm', 1e-2), ('m', 1.0), ('km', 1e3), ('nm', 1e-9), ('in', 0.0254), ('ft', 0.3048),
  ('micron', 1e-6), ('millimeter', 1e-3), ('s', 1.0), ('ms', 1e-3), ('h', 3600.0), ('day', 86400.0))
select id, a as source, b as target, value * (x.s / y.s) as converted from measured join scale x on x.name = a join scale y on y.name = b""")
def unit_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _measured(spark, sf_dir)
    return m.select("id", F.col("a").alias("source"), F.col("b").alias("target"), units.convert_col(F.col("value"), F.col("a"), F.col("b")).alias("converted"))


#: Symbols and names of units, with what SQL takes them for: OME name, header name, scale. Written out
#: here, so that a wrong value in the library's own tables shows.
_NAMED = """('um', 'micrometer', 'micron', 1e-6), ('mm', 'millimeter', 'mm', 1e-3), ('m', 'meter', 'meter', 1.0), ('cm', 'centimeter', 'unknown', 1e-2), ('km', 'kilometer', 'unknown', 1e3),
('nm', 'nanometer', 'unknown', 1e-9), ('pm', 'picometer', 'unknown', 1e-12), ('fm', 'femtometer', 'unknown', 1e-15), ('am', 'attometer', 'unknown', 1e-18), ('Mm', 'megameter', 'unknown', 1e6),
('Gm', 'gigameter', 'unknown', 1e9), ('Tm', 'terameter', 'unknown', 1e12), ('Ym', 'yottameter', 'unknown', 1e24), ('ym', 'yoctometer', 'unknown', 1e-24), ('hm', 'hectometer', 'unknown', 1e2),
('dm', 'decimeter', 'unknown', 1e-1), ('μm', 'micrometer', 'micron', 1e-6), ('in', 'inch', 'unknown', 0.0254), ('ft', 'foot', 'unknown', 0.3048), ('yd', 'yard', 'unknown', 0.9144),
('mi', 'mile', 'unknown', 1609.344), ('Å', 'angstrom', 'unknown', 1e-10), ('pc', 'parsec', 'unknown', 3.0857e16), ('s', 'second', 'sec', 1.0), ('ms', 'millisecond', 'msec', 1e-3),
('us', 'microsecond', 'usec', 1e-6), ('ns', 'nanosecond', 'unknown', 1e-9), ('ks', 'kilosecond', 'unknown', 1e3), ('d', 'day', 'unknown', 86400.0), ('h', 'hour', 'unknown', 3600.0),
('meter', 'meter', 'meter', 1.0), ('micrometer', 'micrometer', 'micron', 1e-6), ('millimeter', 'millimeter', 'mm', 1e-3), ('second', 'second', 'sec', 1.0), ('minute', 'minute', 'unknown', 60.0),
('hour', 'hour', 'unknown', 3600.0), ('day', 'day', 'unknown', 86400.0), ('inch', 'inch', 'unknown', 0.0254), ('micron', null, null, 1e-6), ('year', null, null, 31557600.0), ('bogus', null, null, null)"""
_SYMBOLS = [x.split("'")[1] for x in _NAMED.replace("\n", "").split("(")[1:]]
_SYMBOL_SQL = f"known(unit, ome, nifti, scale) as (values {_NAMED}), asked as (select p_partkey as id, {_SYMBOLS!r}[p_partkey % {len(_SYMBOLS)} + 1] as unit from part)"


def _symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.array(*map(F.lit, _SYMBOLS))
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.get(names, F.pmod("p_partkey", F.lit(len(_SYMBOLS))).cast("int")).alias("unit"))


@query(f"with {_SYMBOL_SQL} select id, unit, ome from asked join known using (unit)")
def unit_to_ome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _symbols(spark, sf_dir).select("id", "unit", units.ome_col(F.col("unit"), strict=False).alias("ome"))


@query(f"with {_SYMBOL_SQL} select id, unit, nifti from asked join known using (unit)")
def unit_to_nifti(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _symbols(spark, sf_dir).select("id", "unit", units.nifti_col(F.col("unit"), strict=False).alias("nifti"))


@query(f"with {_SYMBOL_SQL} select id, unit, cast(scale as double) as scale from asked join known using (unit)")
def unit_to_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _symbols(spark, sf_dir).select("id", "unit", units.scale_col(F.col("unit"), strict=False).alias("scale"))


_CODES = ["RAS", "LPS", "PIR", "LI", "LP", "PI", "RA", "AS", "coronal", "axial", "sagittal", "SLA"]


def oriented(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = F.array(*map(F.lit, _CODES))
    return read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), F.get(codes, F.pmod("p_partkey", F.lit(len(_CODES))).cast("int")).alias("given"),
        F.array((F.col("p_size") / 2.0), F.lit(0.5), F.lit(3.0)).alias("vx"), F.array(F.col("p_size").cast("long") * 10, F.lit(64).cast("long"), F.lit(7).cast("long")).alias("shape"),
    ).withColumn("code", orientation.normalised_col(F.col("given")))


ORIENTED = f"""o as (select p_partkey as id, {_CODES!r}[p_partkey % {len(_CODES)} + 1] as given, [p_size / 2.0, 0.5, 3.0] as vx, [p_size * 10, 64, 7] as shape from part),
full_code(given, code) as (values ('RAS', 'RAS'), ('LPS', 'LPS'), ('PIR', 'PIR'), ('LI', 'LIA'), ('LP', 'LPS'), ('PI', 'PIR'), ('RA', 'RAS'), ('AS', 'ASR'),
  ('coronal', 'LIA'), ('axial', 'LPS'), ('sagittal', 'PIR'), ('SLA', 'SLA')),
m as (select id, o.given, code, vx, shape, r.r, a.a, case substr(code, a.a, 1) when ['R', 'A', 'S'][r.r] then 1.0 when ['L', 'P', 'I'][r.r] then -1.0 else 0.0 end * vx[a.a] as e
  from o join full_code using (given), (select unnest([1, 2, 3]) as r) r, (select unnest([1, 2, 3]) as a) a)"""


@query(f"""with {ORIENTED} select id, code, cast(sum(e) filter (r = 1 and a = 1) as double) as m00, cast(sum(e) filter (r = 1 and a = 2) as double) as m01, cast(sum(e) filter (r = 1 and a = 3) as double) as m02,
  cast(sum(e) filter (r = 2 and a = 1) as double) as m10, cast(sum(e) filter (r = 2 and a = 2) as double) as m11, cast(sum(e) filter (r = 2 and a = 3) as double) as m12,
  cast(sum(e) filter (r = 3 and a = 1) as double) as m20, cast(sum(e) filter (r = 3 and a = 2) as double) as m21, cast(sum(e) filter (r = 3 and a = 3) as double) as m22 from m group by id, code""")
def orientation_affine(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = oriented(spark, sf_dir).withColumn("m", orientation.affine_col(F.col("code"), F.col("vx")))
    return m.select("id", "code", *(F.col("m")[r][a].alias(f"m{r}{a}") for r in range(3) for a in range(3)))


_CENTRED = "t as (select id, r, cast(-0.5 * sum(e * (shape[a] - 1)) as double) as t from m group by id, r)"


@query(f"with {ORIENTED}, {_CENTRED} select id, sum(t) filter (r = 1) as tx, sum(t) filter (r = 2) as ty, sum(t) filter (r = 3) as tz from t group by id")
def affine_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = oriented(spark, sf_dir).withColumn("m", orientation.centred_col(orientation.affine_col(F.col("code"), F.col("vx")), F.col("shape")))
    return m.select("id", *(F.col("m")[r][3].alias(f"t{a}") for r, a in enumerate("xyz")))


@query(f"""with {ORIENTED}, {_CENTRED}, w as (select id, r, cast(sum(e * [id % 9, 3, 5][a]) as double) as s from m group by id, r)
select id, sum(s + t) filter (r = 1) as x, sum(s + t) filter (r = 2) as y, sum(s + t) filter (r = 3) as z from w join t using (id, r) group by id""")
def voxel_to_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = oriented(spark, sf_dir).withColumn("m", orientation.centred_col(orientation.affine_col(F.col("code"), F.col("vx")), F.col("shape")))
    p = orientation.world_col(F.col("m"), F.array(F.col("id") % 9, F.lit(3).cast("long"), F.lit(5).cast("long")))
    return m.select("id", p.alias("p")).select("id", *(F.col("p")[k].alias(a) for k, a in enumerate("xyz")))


@query("""select event_id, cast(json_extract_string(props, '$.' || json_keys(props)[1]) as varchar) as first_value, len(json_keys(props)) as n from events""")
def json_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribute documents as maps, whatever their fields."""
    m = F.from_json("props", "map<string,string>")
    return read(spark, sf_dir, "events").select("event_id", F.get(F.map_values(m), F.lit(0)).alias("first_value"), F.size(m).cast("long").alias("n"))


@query("""with k as (select p_partkey as id, p_size as s from part)
select id, cast((((id * 2 - 10) % 91 + 91) % 91) + 10 as bigint) as v from k""")
def intensity_variation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), naming.intensity_variation(F.col("p_partkey"), 1.0, 10, 100).alias("v"))


@query("""select p_partkey as id, case when p_partkey % 2 = 0 then 'Experiment_Fiji_' || p_size else 'Experiment_' || p_type end as fiji_or_last from part""")
def experiment_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read(spark, sf_dir, "part")
    keys = F.array(F.lit("data"), F.concat(F.lit("Experiment_Fiji_"), F.col("p_size").cast("string")), F.concat(F.lit("Experiment_"), F.col("p_type")))
    return p.select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 2 == 0, naming.experiment_key(keys, True)).otherwise(naming.experiment_key(keys)).alias("fiji_or_last"))
