"""Every query of the library proper against its SQL on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pytest

from geohealth.queries import registry

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_sql(spark, duck, tmp_path, name):
    out = str(tmp_path / "out")
    registry.QUERIES[name](spark, SF).write.parquet(out)
    want, got = duck.sql(registry.ORACLES[name]), duck.sql(f"SELECT * FROM '{out}/*.parquet'")
    assert sorted(want.columns) == sorted(got.columns)
    columns = ", ".join(f'"{c}"' for c in sorted(want.columns))
    kinds = [{c: str(t) for c, t in zip(r.columns, r.types)} for r in (want, got)]
    key = lambda row: [(x is None, str(x)) for x in row]
    a = sorted(duck.sql(f"SELECT {columns} FROM ({registry.ORACLES[name]})").fetchall(), key=key)
    b = sorted(duck.sql(f"SELECT {columns} FROM '{out}/*.parquet'").fetchall(), key=key)
    assert a == b
    assert kinds[0] == kinds[1]


def test_all_queries_have_sql():
    assert set(registry.QUERIES) == set(registry.ORACLES)


def test_indicator_registry_holds_all_cases(spark):
    """i0 has its Julys here; both indicators are in the registry of p0."""
    found = registry.QUERIES["indicator_registry"](spark, SF)
    assert found.where("indicator = 'i0'").join(spark.read.parquet(f"{SF}/orders.parquet").where("month(o_orderdate) = 7"), "o_orderkey").count() > 0
    assert found.count() == spark.read.parquet(f"{SF}/orders.parquet").count()


def test_equalize_spreads_pixels_over_tasks(spark):
    """Tasks grow in number with the pixels, not in size; the values are those of few tasks."""
    from geohealth.operators import imagery
    from geohealth.queries import imagery as queries

    pixels = queries._pixels(spark, SF)
    known = pixels.where("dn <> -9999").count()
    few, many = imagery.equalize(pixels), imagery.equalize(pixels, task_pixels=known // 20)
    assert many.rdd.getNumPartitions() >= 20
    assert sorted(many.collect()) == sorted(few.collect()) and few.count() == known
