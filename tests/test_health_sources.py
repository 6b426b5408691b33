from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from geohealth.functions import geodesy, text
from geohealth.operators import classify, health, imagery
from geohealth.sources import readers, writers
from geohealth.streaming import streams


def test_missing_combination_raises(spark):
    df = spark.createDataFrame([("1", "municipality", "week"), (None, "state", "month")], "cod string, agg string, agg_time string")
    assert health.select_combinations(df, ["municipality"], ["week"]).count() == 1
    with pytest.raises(health.MissingCombination):
        health.select_combinations(df, ["municipality", "state"], ["week"])


def test_standard_dates(spark):
    epi = spark.createDataFrame([(2024, 9, date(2024, 2, 25))], "year int, week int, start_date date")
    df = spark.createDataFrame([("2024-09", "epiweek"), ("2024-02-25", "week"), ("2024-09", "month"), ("2024", "year"), ("bad", "month")], "date string, agg_time string")
    got = [(r.start_date, r.number) for r in health.standard_dates(df, epi).orderBy(F.monotonically_increasing_id()).collect()]
    assert sorted(got, key=str) == sorted([(date(2024, 2, 25), 9), (date(2024, 2, 25), 9), (date(2024, 9, 1), 9), (date(2024, 1, 1), 2024), (None, None)], key=str)


def test_enrichment_takes_a_code_once(spark):
    z = spark.createDataFrame([(1, "b", "u", None), (1, "a", "u", None)], "zone_id long, name string, uf string, rings array<array<struct<x:double,y:double>>>")
    df = spark.createDataFrame([(1,), (2,), (None,)], "code long")
    assert [(r.code, r.name) for r in health.enrich_zones(df, z).collect()] == [(1, "a")]


def test_colors(spark):
    p = [(0.0, "a"), (10.0, "b"), (20.0, "c")]
    df = spark.createDataFrame([(5.0,), (-3.0,), (99.0,), (10.0,), (None,)], "v double")
    got = df.select(classify.nearest_color(F.col("v"), p).alias("n"), classify.bin_color(F.col("v"), p).alias("b")).collect()
    assert [r.n for r in got] == ["a", "a", "c", "b", None]
    assert [r.b for r in got] == ["b", "a", "c", "b", "transparent"]


def test_class_of_empty_and_small_ranges(spark):
    empty = spark.createDataFrame([(None,)], "value double")
    assert [tuple(r) for r in classify.equal_interval_class(empty).collect()] == [(None, None, None)]
    few = spark.createDataFrame([(0.1,), (0.9,)], "value double")
    assert [r.label for r in classify.equal_interval_class(few).collect()] == ["Lower than 0.2600", "Greater than 0.7400"]


def test_wide_and_back(spark):
    long = spark.createDataFrame([(1, date(2024, 1, 7), 2.0), (1, date(2024, 1, 14), 3.0), (2, date(2024, 1, 7), 4.0), (2, date(2024, 1, 14), None)], "zone_id long, period_start date, value double")
    back = health.periods_to_long(health.periods_to_wide(long, "zone_id", ["20240107", "20240114"]), "zone_id")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, long.collect()), key=str)


def test_item_dates_and_items(spark):
    names = ["a_20240102T030405_20240203T040506", "a_20240102T030405", "a_20240102_20240203", "a_20240102", "a"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    s, e = text.item_dates(F.col("n"))
    assert [tuple(r) for r in df.select(s, e).collect()] == [
        ("2024-01-02T03:04:05", "2024-02-03T04:05:06"), ("2024-01-02T03:04:05",) * 2, ("2024-01-02T00:00:00", "2024-02-03T00:00:00"), ("2024-01-02T00:00:00",) * 2, (None, None)]
    paths = spark.createDataFrame([("/x/a_20240102.tif",), ("/y/a_20240102.png",), ("/y/none.png",)], "path string")
    items = imagery.build_items(paths).collect()
    assert len(items) == 1 and set(items[0].assets) == {"tif", "png"}


def test_mercator_round_trip(spark):
    df = spark.createDataFrame([(float(a),) for a in range(-80, 81, 10)], "lat double")
    x = df.select("lat", geodesy.inverse_lat(geodesy.mercator_y(F.col("lat"))).alias("b")).collect()
    assert all(abs(r.lat - r.b) < 1e-9 for r in x)
    y = spark.range(1).select(geodesy.mercator_y(F.lit(45.0)).alias("y"), geodesy.mercator_x(F.lit(180.0)).alias("x")).first()
    assert abs(y.y - 5591295.918553) < 1e-3 and abs(y.x - 20037508.342789) < 1e-3


def test_readers(spark, tmp_path):
    (tmp_path / "ind.csv").write_text("geo,dt,nm,sp,tm,val\n1,2024-01-07,i,municipality,week,3.5\n")
    roles = readers.ColumnRoles("geo", "dt", "nm", "sp", "tm", "val")
    got = readers.read_indicator(spark, str(tmp_path / "ind.csv"), roles)
    assert got.columns == ["cod", "date", "indicator", "agg", "agg_time", "value"] and {t for _, t in got.dtypes} == {"string"}
    with pytest.raises(ValueError):
        readers.read_indicator(spark, str(tmp_path / "ind.csv"), readers.ColumnRoles("geo", "dt", "nm", "sp", "tm", "other"))
    page = {"pagination": {"total_pages": 1}, "items": [{"data_iniSE": "2024-01-07", "municipio_geocodigo": 3304557, "casos": 5.0}, {"data_iniSE": "2024-01-14", "municipio_geocodigo": 33, "casos": None}, {"data_iniSE": "2024-01-14", "municipio_geocodigo": 33, "casos": None}]}
    (tmp_path / "p1.json").write_text(json.dumps(page))
    got = readers.read_case_pages(spark, str(tmp_path / "p1.json"), "casos", "dengue", start="2024-01-01").orderBy("date").collect()
    assert [(r.agg, r.cod, r.value) for r in got] == [("municipality", 3304557, 5.0), ("state", 33, 0.0)]
    (tmp_path / "cal.csv").write_text("Year,Week,StartDate,EndDate\n2024,1,2023-12-31,06/01/2024\n")
    assert [tuple(r) for r in readers.read_calendar(spark, str(tmp_path / "cal.csv")).collect()] == [(2024, 1, date(2023, 12, 31), date(2024, 1, 6))]
    (tmp_path / "st.csv").write_text("DC_NOME;SG_ESTADO;CD_SITUACAO;VL_LATITUDE;VL_LONGITUDE;VL_ALTITUDE;DT_INICIO_OPERACAO;CD_ESTACAO\nX;RJ;Op;-22,5;-43,1;10;;A1\n")
    assert [tuple(r) for r in readers.read_stations(spark, str(tmp_path / "st.csv")).collect()] == [("A1", "X", "RJ", -22.5, -43.1, 10.0)]
    (tmp_path / "nm.csv").write_text("Código;" + ";".join(["Janeiro", "Fevereiro", "Março", *readers.MONTHS[3:]]) + "\nA1;30,5;-" + ";1" * 10 + "\n")
    got = readers.read_normals(spark, str(tmp_path / "nm.csv")).orderBy("month").collect()
    assert [(r.month, r.value) for r in got][:2] == [(1, 30.5), (3, 1.0)]
    feature = lambda kind, c: {"type": "Feature", "properties": {"CD": "7", "NM": "n", "UF": "RJ"}, "geometry": {"type": kind, "coordinates": c}}
    ring = [[0, 0], [1, 0], [1, 1]]
    (tmp_path / "z.json").write_text(json.dumps({"type": "FeatureCollection", "features": [feature("Polygon", [ring]), feature("MultiPolygon", [[ring], [ring]])]}))
    got = readers.read_zones(spark, str(tmp_path / "z.json"), {"zone_id": "CD", "name": "NM", "uf": "UF"}).collect()
    assert [len(r.rings) for r in got] == [1, 2] and got[0].zone_id == 7


def test_cells_prune_partitions(spark, tmp_path):
    df = spark.createDataFrame([("t", date(2023, 12, 30), 0, 0, 1.0), ("t", date(2024, 1, 1), 0, 0, 2.0), ("t", date(2020, 1, 1), 0, 0, 3.0)], "variable string, day date, i int, j int, value double")
    df.withColumn("year", F.year("day")).withColumn("month", F.month("day")).write.partitionBy("variable", "year", "month").parquet(str(tmp_path / "c"))
    got = readers.read_cells(spark, str(tmp_path / "c"), "t", [2024], "epiweek")
    assert got.count() == 2 and "PartitionFilters: [isnotnull" in got._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        readers.read_cells(spark, str(tmp_path / "c"), "other", [2024], "month")


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("i", "municipality", "epiweek", date(2024, 1, 7), 1.0), ("i", "municipality", "epiweek", date(2024, 1, 14), 2.0)], "name_indicator string, spatial_agg string, time_agg string, period_start date, value double")
    writers.write_periods(df, str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).where("period_start = '2024-01-07'").count() == 1
    z = spark.createDataFrame([(1, [[{"x": 0.0, "y": 1.0}]])], "zone_id long, rings array<array<struct<x:double,y:double>>>")
    writers.write_geojson_lines(z, str(tmp_path / "g"))
    line = json.loads(spark.read.text(str(tmp_path / "g")).first()[0])
    assert line["geometry"] == {"type": "MultiPolygon", "coordinates": [[[[0.0, 1.0]]]]} and line["properties"] == {"zone_id": 1}


def test_stream_equals_batch(spark, tmp_path):
    schema = "event_id long, ts timestamp, zone_id long, value double"
    rows = [(k % 7, datetime(2024, 1, 1 + k % 20, 5), k % 3, float(k)) for k in range(60)]
    df = spark.createDataFrame(rows, schema)
    df.write.parquet(str(tmp_path / "in"))
    q = streams.stream_cases(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "sink"), str(tmp_path / "cp"), ["event_id"])
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "sink")).count() == 7
    weekly = streams.stream_epiweek(df)
    assert weekly.agg(F.sum("n")).first()[0] == 60 and weekly.where(F.dayofweek("period_start") != 1).count() == 0


def test_relational_load(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("DERBY_HOME", str(tmp_path))
    df = spark.createDataFrame([(1, 2, 3.14159), (None, 1, 1.0)], "code long, number int, value double")
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    writers.write_jdbc(health.to_db_rows(df, "climate"), url, "layer", "overwrite", driver=driver)
    writers.write_jdbc(health.to_db_rows(df, "climate"), url, "layer", "append", driver=driver)
    back = spark.read.format("jdbc").options(url=url, dbtable="layer", driver=driver).load().collect()
    assert [(r.code, str(r.value)) for r in back] == [(1, "3.1416")] * 2


def test_db_rows_flavours(spark):
    df = spark.createDataFrame([(1, None, None), (None, 3, 2.345)], "code long, number int, value double")
    assert [(r.number, str(r.value)) for r in health.to_db_rows(df, "health").collect()] == [(0, "0.00"), (3, "2.35")]
    assert health.to_db_rows(df, "climate").count() == 0
    with pytest.raises(ValueError):
        health.to_db_rows(df, "other")
