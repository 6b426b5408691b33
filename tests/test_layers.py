"""Layers side by side, shapes, aligned grids, pruned reads, runs and streams that stop halfway."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from geohealth.functions import shapes
from geohealth.operators import calendar, climate, health, zones
from geohealth.plans import pipelines
from geohealth.queries import registry, views
from geohealth.sources import ledger, readers, writers
from geohealth.streaming import streams

RINGS = "array<array<struct<x:double,y:double>>>"
SF = "/root/testdata/sf0.001"


def square(x, y, s):
    return [{"x": x, "y": y}, {"x": x + s, "y": y}, {"x": x + s, "y": y + s}, {"x": x, "y": y + s}]


def health_parts(spark):
    layer = spark.createDataFrame([(1, "n", "u", [square(0.0, 0.0, 10.0), square(2.0, 2.0, 5.0), square(3.0, 3.0, 1.0), square(20.0, 0.0, 1.0)])], f"zone_id long, name string, uf string, rings {RINGS}")
    registry_ = spark.createDataFrame([("p", "a", "A"), ("p", "b", "B"), ("q", "c", "C")], "provider string, id string, title string")
    rows = [("1", "2020-01-01", "a", 0.12345), ("1", "2020-03-01", "a", 0.5), ("1", "2020-01-01", "b", 1000.123), ("1", "2020-02-01", "b", 7.0), ("1", "2020-03-01", "b", None)]
    df = spark.createDataFrame([(c, d, i, "municipality", "month", v) for c, d, i, v in rows], "cod string, date string, indicator string, agg string, agg_time string, value double")
    epi = calendar.epi_calendar(spark, [2020])
    return df, layer, epi, registry_


def test_indicators_together_equal_each_alone(spark):
    df, layer, epi, known = health_parts(spark)
    run = lambda d, **k: sorted(map(str, pipelines.health_indicator(d, ["municipality"], ["month"], layer, epi, known, "p", **k).drop("geometry").collect()))
    both = run(df)
    assert both == sorted(run(df.where("indicator = 'a'")) + run(df.where("indicator = 'b'"))) and both == run(df, indicators=["a", "b"])
    assert run(df, indicators=["a"]) == run(df.where("indicator = 'a'"))
    got = {(r.name_indicator, r.start_date): (r.value, r.end_date) for r in pipelines.health_indicator(df, ["municipality"], ["month"], layer, epi, known, "p").collect()}
    assert got["A", date(2020, 1, 1)] == (0.1235, date(2020, 2, 29)) and got["B", date(2020, 1, 1)] == (1000.12, date(2020, 1, 31))
    with pytest.raises(health.UnknownIndicator):
        run(df.withColumn("indicator", F.lit("c")))
    with pytest.raises(health.UnknownIndicator):
        run(df, indicators=["a", "nothing"])


def test_the_large_table_is_read_once_by_the_result(spark):
    plan = registry.QUERIES["health_layer"](spark, SF)
    plan.collect()
    leaves = plan._jdf.queryExecution().executedPlan().toString()
    final = leaves.split("== Initial Plan ==")[0]
    assert final.count("orders.parquet") <= 1


def test_loading_a_layer_with_shapes(spark, tmp_path, monkeypatch):
    monkeypatch.setenv("DERBY_HOME", str(tmp_path))
    df, layer, epi, known = health_parts(spark)
    got = pipelines.health_indicator(df, ["municipality"], ["month"], layer, epi, known, "p")
    url = f"jdbc:derby:{tmp_path}/layers;create=true"
    monkeypatch.setattr(writers, "write_jdbc", lambda d, u, t, mode: d.write.format("jdbc").options(url=u, dbtable=t, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").mode(mode).save())
    pipelines.load_layer(got, "health", url, "layer", "overwrite")
    back = spark.read.format("jdbc").options(url=url, dbtable="layer", driver="org.apache.derby.iapi.jdbc.AutoloadedDriver").load()
    assert back.count() == 5 and {str(r.value) for r in back.collect()} == {"0.12", "0.50", "1000.12", "7.00", "0.00"}
    text = back.first()["geometry"]
    assert text == ("SRID=4326;MULTIPOLYGON(((0.0 0.0, 10.0 0.0, 10.0 10.0, 0.0 10.0, 0.0 0.0), (2.0 2.0, 7.0 2.0, 7.0 7.0, 2.0 7.0, 2.0 2.0)), ((3.0 3.0, 4.0 3.0, 4.0 4.0, 3.0 4.0, 3.0 3.0)), "
                    "((20.0 0.0, 21.0 0.0, 21.0 1.0, 20.0 1.0, 20.0 0.0)))")
    rings = back.select(shapes.rings_of_text(F.col("geometry")).alias("r")).first().r
    assert [len(r) for r in rings] == [5] * 4 and (rings[0][1].x, rings[0][1].y) == (10.0, 0.0)


def test_polygons_of_rings_in_any_order(spark):
    """Nested squares, shuffled: parts and holes as they were made."""
    rng = np.random.default_rng(4)
    made = [[[square(100.0 * k, 0.0, 90.0)] + [square(100.0 * k + 5 + 20 * h, 5.0, 15.0) for h in range(k % 4)], *[[square(100.0 * k + 8 + 20 * h, 8.0, 3.0)] for h in range(k % 4)]] for k in range(8)]
    rows = []
    for k, parts in enumerate(made):
        flat = [r for p in parts for r in p]
        rows.append((k, [flat[i] for i in rng.permutation(len(flat))]))
    rows += [(8, []), (9, None), (10, [[{"x": 1.0, "y": 1.0}]])]
    got = dict(spark.createDataFrame(rows, f"k int, rings {RINGS}").select("k", shapes.polygons(F.col("rings"))).collect())
    plain = lambda parts: {frozenset((tuple((p["x"], p["y"]) for p in part[0]), *sorted(tuple((p["x"], p["y"]) for p in h) for h in part[1:]))) for part in parts}
    for k, parts in enumerate(made):
        assert plain(got[k]) == plain(parts)
    assert got[8] == [] and got[9] is None and len(got[10]) == 1
    df = spark.createDataFrame(rows[:3] + rows[8:], f"k int, rings {RINGS}").select("k", shapes.multipolygon_text(F.col("rings")).alias("t"))
    assert [r.t for r in df.orderBy("k").collect()][3:] == ["MULTIPOLYGON EMPTY", None, "MULTIPOLYGON(((1.0 1.0)))"]


def test_geojson_lines_keep_parts_and_are_split(spark, tmp_path):
    z = spark.createDataFrame([(k, "a,b", "u", [square(0.0, 0.0, 9.0), square(1.0, 1.0, 2.0)] if k % 2 else [square(0.0, 0.0, 9.0)]) for k in range(200)], f"zone_id long, name string, uf string, rings {RINGS}")
    writers.write_geojson_lines(z, str(tmp_path / "g"))
    line = json.loads(spark.read.text(str(tmp_path / "g")).where("value LIKE '%\"zone_id\":1,%'").first()[0])
    assert [len(p) for p in line["geometry"]["coordinates"]] == [2]
    names = {"zone_id": "zone_id", "name": "name", "uf": "uf"}
    got = readers.read_zones(spark, str(tmp_path / "g"), names, lines=True)
    assert sorted(map(str, got.collect())) == sorted(map(str, z.collect()))
    features = [r[0] for r in spark.read.text(str(tmp_path / "g")).collect()]
    (tmp_path / "c.json").write_text('{"type":"FeatureCollection","features":[\n' + ",\n".join(features) + "\n]}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        split = readers.read_zones(spark, str(tmp_path / "c.json"), names, lines=True)
        assert split.rdd.getNumPartitions() > 4 and sorted(map(str, split.collect())) == sorted(map(str, z.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(map(str, readers.read_zones(spark, str(tmp_path / "c.json"), names).collect())) == sorted(map(str, z.collect()))


def test_periods_stand_beside_each_other(spark, tmp_path):
    schema = "name_indicator string, spatial_agg string, time_agg string, period_start date, value double"
    row = lambda i, m, v: (i, "municipality", "month", date(2024, m, 1), v)
    path = str(tmp_path / "o")
    writers.write_periods(spark.createDataFrame([row("i1", 1, 1.0), row("i1", 2, 2.0)], schema), path)
    writers.write_periods(spark.createDataFrame([row("i2", 1, 3.0)], schema), path)
    writers.write_periods(spark.createDataFrame([row("i1", 2, 4.0)], schema), path)
    read = lambda: sorted((r.name_indicator, r.period_start.month, r.value) for r in spark.read.parquet(path).collect())
    assert read() == [("i1", 1, 1.0), ("i1", 2, 4.0), ("i2", 1, 3.0)]
    bad = spark.createDataFrame([row("i1", 1, 9.0), row("i1", 2, 9.0)], schema).withColumn("value", F.when(F.col("period_start") == "2024-02-01", F.raise_error(F.lit("stop"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="stop"):
        writers.write_periods(bad, path)
    assert read() == [("i1", 1, 1.0), ("i1", 2, 4.0), ("i2", 1, 3.0)]


@pytest.mark.parametrize("seed", range(4))
def test_aligned_grids_against_brute_force(spark, seed):
    rng = np.random.default_rng(seed)
    grids = [zones.Grid(float(rng.uniform(-5, 5)), float(rng.uniform(-5, 5)), float(rng.uniform(0.4, 2))) for _ in range(3)]
    tables = [{(int(d), int(i), int(j)): float(rng.normal()) for d, i, j in zip(rng.integers(0, 2, 30), rng.integers(-3, 6, 30), rng.integers(0, 5, 30))} for _ in grids]
    frames = [(spark.createDataFrame([(*k, v) for k, v in t.items()], "day int, i int, j int, value double"), g) for t, g in zip(tables, grids)]
    got = zones.align_grids(frames).collect()
    west, south = (min(o(g) + min(k[a] for k in t) * g.r for t, g in zip(tables, grids)) for a, o in ((1, lambda g: g.x0), (2, lambda g: g.y0)))
    east, north = (max(o(g) + (max(k[a] for k in t) + 1) * g.r for t, g in zip(tables, grids)) for a, o in ((1, lambda g: g.x0), (2, lambda g: g.y0)))
    nx, ny = (max(1, int((b - a) / grids[0].r + 1e-9)) for a, b in ((west, east), (south, north)))
    days = {k[0] for t in tables for k in t}
    want = {}
    for d in days:
        for i in range(nx):
            for j in range(ny):
                x, y = west + (i + 0.5) * (east - west) / nx, south + (j + 0.5) * (north - south) / ny
                want[d, i, j] = tuple(t.get((d, int(np.floor((x - g.x0) / g.r)), int(np.floor((y - g.y0) / g.r)))) for t, g in zip(tables, grids))
    assert {(r.day, r.i, r.j): (r.value_0, r.value_1, r.value_2) for r in got} == want and len(got) == len(want)
    assert "CartesianProduct" not in zones.align_grids(frames)._jdf.queryExecution().toString()


def test_aligned_grids_without_cells(spark):
    none = spark.createDataFrame([], "day int, i int, j int, value double")
    one = spark.createDataFrame([(1, 0, 0, 2.0)], "day int, i int, j int, value double")
    g = zones.Grid(0.0, 0.0, 1.0)
    assert zones.align_grids([(none, g), (none, g)]).count() == 0
    assert [(r.value_0, r.value_1) for r in zones.align_grids([(none, g), (one, g)]).collect()] == [(None, 2.0)]


def test_cells_are_pruned_by_month_and_space(spark, tmp_path):
    days = [date(2023, 1, 1) + timedelta(days=k) for k in range(0, 730, 3)]
    rows = [("t", d, i, j, float(i + j)) for d in days for i in range(0, 40, 4) for j in range(0, 8, 4)]
    path = str(tmp_path / "c")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        writers.write_cells(spark.createDataFrame(rows, "variable string, day date, i int, j int, value double").repartition(3), path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    span = zones.cell_span(spark.createDataFrame([(1, [square(2.5, 2.5, 3.0)])], f"zone_id long, rings {RINGS}"), zones.Grid(0.0, 0.0, 1.0))
    assert (span.i0, span.i1) == (1, 6)
    weekly, monthly = (readers.read_cells(spark, path, "t", [2024], p, span) for p in ("epiweek", "month"))
    for got, p in ((weekly, "epiweek"), (monthly, "month")):
        want = {(d, i, j) for _, d, i, j, _ in rows if span.i0 <= i <= span.i1 and span.j0 <= j <= span.j1 and (d.year == 2024 or p == "epiweek" and date(2023, 12, 25) <= d <= date(2023, 12, 31))}
        assert {(r.day, r.i, r.j) for r in got.collect()} == want
        plan = got._jdf.queryExecution().executedPlan().toString()
        scan = plan[plan.index("FileScan"):]
        assert "PushedFilters" in scan and "GreaterThanOrEqual(i,1)" in scan and "LessThanOrEqual(i,6)" in scan and "year" in scan.split("PartitionFilters")[1].split("]")[0]
    files = lambda df: int(df._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numFiles").value())
    for got in (weekly, monthly):
        got._jdf.queryExecution().executedPlan().executeCollect()
    all_files = len([f for f in (tmp_path / "c").rglob("*.parquet")])
    months = {tuple(f.parent.parts[-2:]) for f in (tmp_path / "c").rglob("*.parquet")}
    assert len(months) == 24 and files(monthly) < files(weekly) < 0.7 * all_files
    assert files(weekly) - files(monthly) == len(list((tmp_path / "c").glob("variable=t/year=2023/month=12/*.parquet")))
    with pytest.raises(ValueError):
        readers.read_cells(spark, path, "other", [2024], "month")


def test_runs_that_stop_halfway(spark, tmp_path, monkeypatch):
    path, df = str(tmp_path / "r"), spark.range(10).select(F.col("id").alias("item"))
    double = lambda d: d.select("item", (F.col("item") * 2).alias("x"))
    assert ledger.read_output(spark, path) is None and ledger.read_manifest(spark, path) is None
    with pytest.raises(Exception, match="stop"):
        ledger.run_pending(df.where("item < 6"), path, lambda d: d.select("item", F.when(F.col("item") == 3, F.raise_error(F.lit("stop"))).otherwise(F.col("item")).cast("long").alias("x")))
    assert ledger.read_output(spark, path) is None
    assert ledger.run_pending(df.where("item < 6"), path, double) == 0
    # stopped between the output and the manifest
    double(df.where("item >= 6")).write.parquet(f"{path}/data/run=1")
    spark.range(1).write.parquet(f"{path}/manifest/run=1")
    (tmp_path / "r/manifest/run=1/_SUCCESS").unlink()
    assert ledger.read_output(spark, path).count() == 6
    assert ledger.run_pending(df.unionAll(spark.createDataFrame([(None,)], "item long")), path, double) == 1 and ledger.run_pending(df, path, double) is None
    got = ledger.read_output(spark, path).collect()
    assert sorted((r.item, r.x, r.run) for r in got) == [(k, 2 * k, int(k >= 6)) for k in range(10)]
    assert ledger.read_manifest(spark, path).count() == 10


def test_streams_over_batches_restarts_and_late_rows(spark, tmp_path):
    """Files of two days each in shuffled order within the delay, then rows long after their week was closed."""
    rng = np.random.default_rng(1)
    start = datetime(2024, 1, 1)
    rows = [(k, start + timedelta(hours=int(k * 2)), int(rng.integers(0, 3)), float(k % 11)) for k in range(600)]
    schema = "event_id long, ts timestamp, zone_id long, value double"
    whole = spark.createDataFrame(rows, schema)
    files = [rows[at : at + 24] for at in range(0, 600, 24)]
    for at in range(0, len(files) - 1, 2):
        files[at], files[at + 1] = files[at + 1], files[at]
    source, sink, mark = str(tmp_path / "in"), str(tmp_path / "weeks"), str(tmp_path / "mark")
    cases = str(tmp_path / "cases")

    def arrive(parts):
        for part in parts:
            spark.createDataFrame(part + part[:5], schema).coalesce(1).write.mode("append").parquet(source)  # some come twice

    def drain():
        n = streams.drain_epiweek(streams.arriving_files(spark, source, whole.schema, 2), sink, mark, "7 days")
        q = streams.stream_cases(spark, source, whole.schema, cases, mark + "-cases", ["event_id"], delay="7 days", files=2)
        q.awaitTermination()
        return n, streams.late_records(q)

    arrive(files[:11])
    batches, late = drain()
    assert batches >= 5 and late == 0
    arrive(files[11:])
    assert drain()[0] >= 6
    twice = spark.createDataFrame([r for part in files for r in part + part[:5]], schema)
    want = {(r.zone_id, r.period_start): (r.n, r.max, r.min, r["mean"]) for r in streams.stream_epiweek(twice).collect()}
    table = lambda: {(r.zone_id, r.period_start): (r.n, r.max, r.min, r["mean"]) for r in streams.epiweek_table(spark, sink).collect()}
    assert table() == want and streams.late_observations(spark, sink) == 0
    assert sorted(r.event_id for r in spark.read.parquet(cases).select("event_id").collect()) == list(range(600))
    arrive([[(1000 + k, start + timedelta(days=1), 0, 99.0) for k in range(7)]])
    assert drain() == (1, 12) and streams.late_observations(spark, sink) == 12 and table() == want


def test_interpolation_of_many_stations(spark):
    rng = np.random.default_rng(2)
    s = [(float(x), float(y), float(v)) for x, y, v in rng.uniform(0, 10, (5000, 3))] + [(1.0, 1.0, 5.0)] * 3000
    points = [(k, float(x), float(y)) for k, (x, y) in enumerate(rng.uniform(0, 10, (50, 2)))] + [(50, 1.0, 1.0)]
    got = {r.k: r.value for r in climate.idw(spark.createDataFrame(s, "lon double, lat double, value double"), spark.createDataFrame(points, "k int, lon double, lat double")).collect()}
    a = np.array(s)
    for k, x, y in points:
        d = np.hypot(a[:, 0] - x, a[:, 1] - y)
        w = np.where(d == 0, climate.ON_POINT, 1 / np.where(d == 0, 1, d) ** 2)
        assert abs(got[k] - (w * a[:, 2]).sum() / w.sum()) < 1e-9


def test_no_key_of_the_product_holds_more_than_a_tile(spark, monkeypatch):
    monkeypatch.setattr(climate, "POINT_TILE", 100)
    rng = np.random.default_rng(3)
    s = spark.createDataFrame([tuple(map(float, r)) for r in rng.uniform(0, 10, (600, 3))], "lon double, lat double, value double")
    grid = spark.createDataFrame([(k, float(k % 40), float(k // 40)) for k in range(1000)], "k int, lon double, lat double")
    plan = climate.idw(s, grid)
    assert plan.count() == 1000 and "_tile" in plan._jdf.queryExecution().toString()
    tiles = grid.groupBy(F.pmod(F.xxhash64(*grid.columns), F.lit(10)).alias("t")).count().agg(F.max("count")).first()[0]
    assert tiles < 150


def test_runs_end_at_interval_edges(spark):
    days = [date(2024, 1, 1) + timedelta(days=k) for k in range(20)]
    cells = spark.createDataFrame([(d, 0, 0, 300.0 + 273.15) for d in days if d.day != 15], "day date, i int, j int, value double")
    layer = spark.createDataFrame([(1, "a", "u", [square(0.1, 0.1, 0.8)]), (2, "b", "u", [square(50.1, 0.1, 0.8)])], f"zone_id long, name string, uf string, rings {RINGS}")
    normals = spark.createDataFrame([(1, 1, 20.0)], "zone_id long, month int, normal double")
    cal = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 4), 1), (date(2024, 1, 5), date(2024, 1, 10), 2), (date(2024, 1, 12), date(2024, 1, 18), 3)], "start_date date, end_date date, number int")
    got = pipelines.climate_indicator("anomaly_era5land", "month", cells, layer, zones.Grid(0.0, 0.0, 1.0), [2024], normals=normals, intervals=cal)
    assert sorted((r.zone_id, r.number, r.days_above, r.longest_run) for r in got.collect()) == [(1, 1, 4, 4), (1, 2, 6, 6), (1, 3, 6, 3), (2, 1, 0, 0), (2, 2, 0, 0), (2, 3, 0, 0)]
    assert views.FAR == 99
