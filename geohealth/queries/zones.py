"""Membership of cells in zones, and statistics over it."""

from __future__ import annotations

from pyspark.sql import functions as F

from geohealth.functions import calendar as cal
from geohealth.functions import physics, shapes
from geohealth.operators import zones as ops
from geohealth.queries import views as v
from geohealth.queries.registry import query


@query("zone_cells_touched", f"WITH {v.SQL_ZONES} SELECT zone_id, i, j FROM members")
def zone_cells_touched(spark, d):
    return ops.zone_cells(v.zones(spark, d), v.GRID)


@query("zone_cells_center", f"WITH {v.SQL_ZONES} SELECT zone_id, i, j FROM inside")
def zone_cells_center(spark, d):
    return ops.zone_cells(v.zones(spark, d), v.GRID, all_touched=False)


def _surface(spark, d):
    return v.cells(spark, d).groupBy("i", "j").agg(F.avg("value").alias("value"))


def _zonal(stat: str, shown: str):
    sql = f"WITH {v.SQL_CELLS}, {v.SQL_ZONES}, s AS (SELECT i, j, avg(value) AS value FROM cells GROUP BY i, j) SELECT zone_id, {v.sql_r4(f'{shown}(value)')} AS value FROM members LEFT JOIN s USING (i, j) GROUP BY zone_id"

    @query(f"zonal_{stat}", sql)
    def run(spark, d):
        got = ops.zonal_stats(_surface(spark, d), ops.zone_cells(v.zones(spark, d), v.GRID), stat)
        return got.select("zone_id", v.r4(F.col(stat)).alias("value"))

    return run


zonal_max, zonal_min, zonal_mean = _zonal("max", "max"), _zonal("min", "min"), _zonal("mean", "avg")


@query("two_level_indicator", f"""WITH {v.SQL_CELLS}, {v.SQL_ZONES}, s AS (SELECT {v.sql_sunday('day')} AS period_start, i, j, max(value) AS hi, min(value) AS lo, avg(value) AS mid FROM cells GROUP BY ALL)
SELECT zone_id, period_start, max(hi) AS max, min(lo) AS min, {v.sql_r4('avg(mid)')} AS mean FROM members JOIN s USING (i, j) GROUP BY ALL""")
def two_level_indicator(spark, d):
    cells = v.cells(spark, d).withColumn("period_start", cal.epi_start(F.col("day")))
    got = ops.period_indicator(cells, ops.zone_cells(v.zones(spark, d), v.GRID), ["max", "min", "mean"])
    return got.withColumn("mean", v.r4(F.col("mean")))


@query("zones_without_cells", f"""WITH {v.SQL_CELLS}, {v.SQL_ZONES}, s AS (SELECT CAST(date_trunc('month', day) AS DATE) AS period_start, i, j, max(value) AS hi FROM cells WHERE i < 6 GROUP BY ALL),
m AS (SELECT * FROM members WHERE zone_id <> 7), line AS (SELECT DISTINCT period_start FROM m JOIN s USING (i, j))
SELECT CAST(n_nationkey AS BIGINT) AS zone_id, period_start, x.max FROM nation CROSS JOIN line LEFT JOIN (SELECT zone_id, period_start, max(hi) AS max FROM m JOIN s USING (i, j) GROUP BY ALL) x ON x.zone_id = n_nationkey AND x.period_start = line.period_start""".replace("period_start, x.max", "line.period_start, x.max"))
def zones_without_cells(spark, d):
    """Zones without valid or member cells keep a row in every period."""
    cells = v.cells(spark, d).where("i < 6").withColumn("period_start", F.trunc("day", "month"))
    members = ops.zone_cells(v.zones(spark, d), v.GRID).where("zone_id <> 7")
    return ops.period_indicator(cells, members, ["max"], v.zones(spark, d))


@query("daily_zone_max", f"WITH {v.SQL_CELLS}, {v.SQL_ZONES} SELECT zone_id, day, max(value) AS value FROM members JOIN cells USING (i, j) GROUP BY ALL")
def daily_zone_max(spark, d):
    return ops.daily_zone_max(v.cells(spark, d), ops.zone_cells(v.zones(spark, d), v.GRID))


@query("extent", f"WITH {v.SQL_ZONES} SELECT min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax FROM corners")
def extent(spark, d):
    return ops.extent(v.zones(spark, d))


@query("envelope", f"WITH {v.SQL_ZONES} SELECT 'Polygon' AS kind, min(x) AS west, max(y) AS north, CAST(5 AS INTEGER) AS points FROM corners")
def envelope(spark, d):
    """The footprint read back: its kind, two of its sides, and its closed ring."""
    ring = F.from_json(F.get_json_object("footprint", "$.coordinates"), "array<array<array<double>>>")[0]
    got = ops.envelope(v.zones(spark, d)).withColumn("ring", ring)
    return got.select(F.get_json_object("footprint", "$.type").alias("kind"), F.col("ring")[0][0].alias("west"), F.col("ring")[2][1].alias("north"), F.size("ring").alias("points"))


@query("bbox_filter", f"WITH {v.SQL_STATIONS} SELECT code, lon, lat FROM stations WHERE lon >= 2.25 AND lon <= 9.25 AND lat >= 1.5 AND lat <= 4.5")
def bbox_filter(spark, d):
    return ops.within_bbox(v.stations(spark, d), 2.25, 1.5, 9.25, 4.5).select("code", "lon", "lat")


@query("nodata_clean", f"WITH {v.SQL_DAILY} SELECT zone_id, count(*) AS n, count(CASE WHEN l_linenumber NOT IN (3, 5) THEN 1 END) AS known, {v.sql_r4('avg(CASE WHEN l_linenumber NOT IN (3, 5) THEN value END)')} AS mean FROM daily GROUP BY zone_id")
def nodata_clean(spark, d):
    """Lines 3 hold the nodata mark and lines 5 NaN."""
    raw = F.when(F.col("l_linenumber") == 3, F.lit(-9999.0)).when(F.col("l_linenumber") == 5, F.lit(float("nan"))).otherwise(F.col("value"))
    clean = v.daily(spark, d).withColumn("value", physics.clean_nodata(raw))
    return clean.groupBy("zone_id").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("known"), v.r4(F.avg("value")).alias("mean"))


@query("grid_snap", f"WITH {v.SQL_STATIONS} SELECT code, CAST(floor((lon + 180) / 0.5) AS INTEGER) AS i, CAST(floor((lat + 90) / 0.5) AS INTEGER) AS j FROM stations")
def grid_snap(spark, d):
    return ops.snap_to_grid(v.stations(spark, d), ops.Grid(-180.0, -90.0, 0.5)).select("code", "i", "j")


_COARSE, _FINE = ops.Grid(0.0, 0.0, 1.0), ops.Grid(0.3, -0.2, 0.7)


@query("aligned_grids", f"""WITH {v.SQL_OBS}, a AS (SELECT CAST(date_trunc('month', day) AS DATE) AS period_start, CAST(user_id % 15 AS INTEGER) AS i, CAST((user_id // 15) % 10 AS INTEGER) AS j, avg(value) AS value FROM obs GROUP BY ALL),
b AS (SELECT CAST(date_trunc('month', day) AS DATE) AS period_start, CAST(user_id % 23 AS INTEGER) AS i, CAST((user_id // 23) % 11 AS INTEGER) AS j, avg(value) AS value FROM obs WHERE month(day) % 2 = 0 GROUP BY ALL),
box AS (SELECT min(w) AS w, max(e) AS e, min(s) AS s, max(n) AS n FROM (SELECT min(i) * 1.0::DOUBLE AS w, (max(i) + 1) * 1.0::DOUBLE AS e, min(j) * 1.0::DOUBLE AS s, (max(j) + 1) * 1.0::DOUBLE AS n FROM a
  UNION ALL SELECT 0.3::DOUBLE + min(i) * 0.7::DOUBLE, 0.3::DOUBLE + (max(i) + 1) * 0.7::DOUBLE, -0.2::DOUBLE + min(j) * 0.7::DOUBLE, -0.2::DOUBLE + (max(j) + 1) * 0.7::DOUBLE FROM b)),
size AS (SELECT *, CAST(floor(e - w + 1e-9) AS INTEGER) AS nx, CAST(floor(n - s + 1e-9) AS INTEGER) AS ny FROM box), x AS (SELECT CAST(unnest(range(nx)) AS INTEGER) AS i, w, (e - w) / nx AS dx FROM size), y AS (SELECT CAST(unnest(range(ny)) AS INTEGER) AS j, s, (n - s) / ny AS dy FROM size),
t AS (SELECT period_start, i, j, w + (i + 0.5::DOUBLE) * dx AS lon, s + (j + 0.5::DOUBLE) * dy AS lat FROM x, y, (SELECT DISTINCT period_start FROM a))
SELECT t.period_start, t.i, t.j, {v.sql_r4('lon')} AS lon, {v.sql_r4('lat')} AS lat, {v.sql_r4('a.value')} AS value_0, {v.sql_r4('b.value')} AS value_1 FROM t LEFT JOIN a ON a.period_start = t.period_start AND a.i = floor(lon) AND a.j = floor(lat)
LEFT JOIN b ON b.period_start = t.period_start AND b.i = floor((lon - 0.3) / 0.7) AND b.j = floor((lat + 0.2) / 0.7)""")
def aligned_grids(spark, d):
    """Monthly means on two grids of uneven steps; the second has every other month only."""
    o = v.obs(spark, d).withColumn("period_start", F.trunc("day", "month"))
    cells = lambda df, n, m: df.groupBy("period_start", (F.col("user_id") % n).cast("int").alias("i"), (F.floor(F.col("user_id") / n) % m).cast("int").alias("j")).agg(F.avg("value").alias("value"))
    got = ops.align_grids([(cells(o, 15, 10), _COARSE), (cells(o.where(F.month("day") % 2 == 0), 23, 11), _FINE)], ["period_start"])
    return got.select("period_start", "i", "j", *[v.r4(F.col(c)).alias(c) for c in ("lon", "lat", "value_0", "value_1")])


@query("zone_text", f"""WITH {v.SQL_ZONES}, ring AS (SELECT zone_id, 0 AS r, p, x, y FROM corners UNION ALL SELECT CAST(n_nationkey AS BIGINT), r, p, (n_nationkey % 5) * 3.0::DOUBLE + a + CASE WHEN p IN (1, 2) THEN s ELSE 0 END, (n_nationkey // 5) * 2.0::DOUBLE + b + CASE WHEN p IN (2, 3) THEN s ELSE 0 END
  FROM nation, (VALUES (1, 0.5::DOUBLE, 0.5::DOUBLE, 0.25::DOUBLE), (2, 0.5625, 0.5625, 0.125)) q(r, a, b, s), range(4) t(p)),
text AS (SELECT zone_id, r, '((' || string_agg(CAST(x AS VARCHAR) || ' ' || CAST(y AS VARCHAR), ', ' ORDER BY p) || ', ' || arg_min(CAST(x AS VARCHAR) || ' ' || CAST(y AS VARCHAR), p) || '))' AS t FROM ring GROUP BY ALL)
SELECT a.zone_id, 'MULTIPOLYGON(' || c.t || ', ' || a.t[:-2] || ', ' || b.t[2:-2] || '))' AS shape, CAST(3 AS INTEGER) AS rings FROM text a JOIN text b ON b.zone_id = a.zone_id AND b.r = 1 JOIN text c ON c.zone_id = a.zone_id AND c.r = 2 WHERE a.r = 0""")
def zone_text(spark, d):
    """Zones with a hole and an island in it, whose rings stand in no order, as text and back."""
    x, y = (F.col("zone_id") % 5) * 3.0, F.floor(F.col("zone_id") / 5) * 2.0
    square = lambda at, s: F.array(*[F.struct((x + at + (s if k in (1, 2) else 0.0)).alias("x"), (y + at + (s if k in (2, 3) else 0.0)).alias("y")) for k in range(4)])
    rings = F.concat(F.array(square(0.5625, 0.125), square(0.5, 0.25)), F.col("rings"))
    got = v.zones(spark, d).select("zone_id", shapes.multipolygon_text(rings).alias("shape"))
    return got.withColumn("rings", F.size(shapes.rings_of_text(F.col("shape"))))
