"""Slices behind one another where names repeat, as they do beyond a thousand slices, and where some are missing."""

import duckdb
import pytest

import voxelmill.queries as q
from tests import oracle
from voxelmill.operators import stitch

VECTORS = {
    "repeated names": "select i * 13 as vec_id from range(3600) as r(i) where i % 5 <> 2",
    "three of most names": "select i * 20 + 19 as vec_id from range(3001) as r(i)",
    "a vector twice, one without an id": "select unnest([null, 0, 20, 20, 20000, 40000, 40001]) as vec_id",
    "none": "select 1 as vec_id where false",
}


@pytest.mark.parametrize("vectors", list(VECTORS))
def test_stack_slices_gives_rows_of_sql_where_names_repeat(spark, tmp_path, vectors):
    path = f"{tmp_path}/embeddings.parquet"
    duckdb.sql(f"copy (select cast(vec_id as bigint) as vec_id, [cast(vec_id as float) / 1024, null] as embedding, 1 as label from ({VECTORS[vectors]})) to '{path}' (format parquet)")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{path}'")
    oracle.same(q.queries()["stack_slices"](spark, str(tmp_path)), con, q.oracle_sql()["stack_slices"])


def test_slices_of_one_name_share_a_place(spark):
    rows = [("b", 1), ("b", 1), ("b", 7), ("a", 2), ("c", 3), (None, 4)]
    slices = spark.createDataFrame(rows, "path string, z int")
    places = lambda key: sorted((r["z"], r["s"]) for r in stitch.stacked(slices, "path", "s", key).collect())
    assert places("z") == [(1, 1), (1, 1), (2, 0), (3, 3), (7, 1)]
    assert places(None) == [(1, 1), (1, 1), (2, 0), (3, 2), (7, 1)]
