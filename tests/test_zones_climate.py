from __future__ import annotations

import math
import random
from datetime import date

from pyspark.sql import functions as F

from geohealth.functions import physics
from geohealth.operators import climate, zones
from geohealth.operators.zones import Grid


def polygon(points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


def layer(spark, shapes):
    return spark.createDataFrame([(k, f"z{k}", "u", rings) for k, rings in shapes.items()], "zone_id long, name string, uf string, rings array<array<struct<x:double,y:double>>>")


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for a, b in zip(ring, ring[1:] + ring[:1]):
            if (a["y"] <= y) != (b["y"] <= y) and x < a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / (b["y"] - a["y"]):
                odd = not odd
    return odd


def test_centre_cells_equal_point_in_polygon(spark):
    rng, shapes = random.Random(4), {}
    for k in range(4):
        turns = sorted(rng.uniform(0, 2 * math.pi) for _ in range(9))
        shapes[k] = [polygon([(5 + k + rng.uniform(1, 4) * math.cos(a), 5 + rng.uniform(1, 4) * math.sin(a)) for a in turns])]
    shapes[9] = [polygon([(1, 1), (9, 1), (9, 9), (1, 9)]), polygon([(3.1, 3.1), (6.2, 3.1), (6.2, 6.2), (3.1, 6.2)])]  # with a hole
    shapes[10] = [polygon([(2.3, 2.3), (2.35, 2.3), (2.35, 2.35)])]  # smaller than a cell
    g = Grid(0.0, 0.0, 0.25)
    z = layer(spark, shapes)
    got = {(r.zone_id, r.i, r.j) for r in zones.zone_cells(z, g, all_touched=False).collect()}
    want = {(k, i, j) for k, rings in shapes.items() for i in range(60) for j in range(60) if inside(rings, (i + 0.5) * 0.25, (j + 0.5) * 0.25)}
    assert got == want
    touched = {(r.zone_id, r.i, r.j) for r in zones.zone_cells(z, g).collect()}
    assert got <= touched and (10, 9, 9) in touched


def test_long_edges_are_split(spark):
    z = layer(spark, {1: [polygon([(0.1, 0.1), (500.3, 480.7), (499.3, 481.7)])]})
    edges = zones.zone_edges(z)
    got = {(r.i, r.j) for r in zones.touched_cells(edges, Grid(0.0, 0.0, 1.0)).collect()}
    n = 20_000
    for t in range(n + 1):
        x, y = 0.1 + 500.2 * t / n, 0.1 + 480.6 * t / n
        assert (math.floor(x), math.floor(y)) in got


def test_zone_without_values_is_kept_and_means_are_two_level(spark):
    members = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (2, 5, 5)], "zone_id long, i int, j int")
    cells = spark.createDataFrame([(date(2024, 1, 1), 0, 0, 2.0), (date(2024, 1, 2), 0, 0, 4.0), (date(2024, 1, 1), 1, 0, 9.0), (date(2024, 1, 2), 1, 0, None)], "day date, i int, j int, value double")
    surface = cells.groupBy("i", "j").agg(F.avg("value").alias("value"))
    assert {r.zone_id: r.mean for r in zones.zonal_stats(surface, members, "mean").collect()} == {1: 6.0, 2: None}
    two = zones.period_indicator(cells.withColumn("period_start", F.lit("2024-01-01").cast("date")), members, ["max", "min", "mean"]).collect()
    assert [(r.zone_id, r["max"], r["min"], r["mean"]) for r in two] == [(1, 9.0, 2.0, 6.0)]


def test_nodata(spark):
    df = spark.createDataFrame([(1.0,), (-9999.0,), (float("nan"),), (None,)], "v double")
    assert [r.v for r in df.select(physics.clean_nodata(F.col("v")).alias("v")).collect()] == [1.0, None, None, None]


def test_runs(spark):
    days = [1, 2, 3, 5, 6, 8]  # the 4th and 7th are missing
    rows = [(1, date(2024, 1, 1), date(2024, 1, d), 5.0 if d != 8 else 3.0, 3.0) for d in days] + [(2, date(2024, 1, 1), date(2024, 1, 1), None, 3.0)]
    df = spark.createDataFrame(rows, "zone_id long, period_start date, day date, value double, normal double")
    assert {r.zone_id: r.longest_run for r in climate.longest_run(df).collect()} == {1: 3, 2: 0}
    assert {r.zone_id: r.days_above for r in climate.days_above(df).collect()} == {1: 5, 2: 0}


def test_idw_in_blocks(spark, monkeypatch):
    rng = random.Random(2)
    s = [(rng.uniform(0, 9), rng.uniform(0, 9), rng.uniform(-5, 5)) for _ in range(60)] + [(1.5, 1.5, 7.0)]
    st = spark.createDataFrame(s, "lon double, lat double, value double")
    grid = spark.createDataFrame([(1.5, 1.5), (4.0, 4.5)], "lon double, lat double")
    want = {}
    for x, y in ((1.5, 1.5), (4.0, 4.5)):
        w = [1e12 if (a, b) == (x, y) else 1 / ((a - x) ** 2 + (b - y) ** 2) for a, b, _ in s]
        want[x] = sum(a * z for a, (_, _, z) in zip(w, s)) / sum(w)
    for block in (256, 10):
        monkeypatch.setattr(climate, "STATION_BLOCK", block)
        got = {r.lon: r.value for r in climate.idw(st, grid).collect()}
        assert all(abs(got[k] - v) < 1e-9 for k, v in want.items())
        assert abs(got[1.5] - 7.0) < 1e-9
    assert [r.value for r in climate.idw(st.limit(0), grid).collect()] == [0.0, 0.0]


def test_humidity_is_full_at_dew_point(spark):
    df = spark.createDataFrame([(20.0, 20.0), (20.0, None)], "t double, td double")
    assert [r.x for r in df.select(physics.relative_humidity(F.col("t"), F.col("td")).alias("x")).collect()] == [100.0, None]


def test_plans_have_no_loop_joins(spark):
    z = layer(spark, {1: [polygon([(0, 0), (3, 0), (3, 3)])]})
    plan = zones.zone_cells(z, Grid(0.0, 0.0, 1.0))._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
