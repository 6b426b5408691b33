"""Humidity, interpolation and anomalies."""

from __future__ import annotations

from pyspark.sql import functions as F

from geohealth.functions import calendar as cal
from geohealth.functions import physics
from geohealth.operators import climate as ops
from geohealth.operators import zones as zn
from geohealth.plans import pipelines
from geohealth.queries import views as v
from geohealth.queries.registry import query
from geohealth.sources import readers

_RH = "100 * exp(17.625 * 243.04 * ({td} - {t}) / ((243.04 + {td}) * (243.04 + {t})))"


@query("unit_conversion", f"WITH {v.SQL_OBS} SELECT event_id, {v.sql_r4('value - 273.15')} AS celsius, {v.sql_r4('value * 1000')} AS mm FROM obs")
def unit_conversion(spark, d):
    x = F.col("value")
    return v.obs(spark, d).select("event_id", v.r4(physics.kelvin_to_c(x)).alias("celsius"), v.r4(physics.m_to_mm(x)).alias("mm"))


@query("longitude_wrap", f"WITH {v.SQL_STATIONS} SELECT code, {v.sql_r4('CASE WHEN l >= 180 THEN l - 360 ELSE l END')} AS lon FROM (SELECT code, lon * 24 AS l FROM stations)")
def longitude_wrap(spark, d):
    return v.stations(spark, d).select("code", v.r4(physics.wrap_longitude(F.col("lon") * 24)).alias("lon"))


@query("relative_humidity", f"WITH {v.SQL_OBS} SELECT event_id, {v.sql_r4(_RH.format(t='value / 20', td='(value / 20 - user_id % 10)'))} AS rh FROM obs")
def relative_humidity(spark, d):
    t = F.col("value") / 20
    return v.obs(spark, d).select("event_id", v.r4(physics.relative_humidity(t, t - F.col("user_id") % 10)).alias("rh"))


def _two(spark, d):
    c = v.cells(spark, d)
    mean = lambda kind, shift: c.where(F.col("event_type") == kind).groupBy("day", "i", "j").agg((F.avg("value") / 20 + shift).alias("value"))
    return mean("view", 10), mean("click", 0)


@query("humidity_indicator", f"""WITH {v.SQL_CELLS}, {v.SQL_ZONES}, m AS (SELECT event_type, day, i, j, avg(value) / 20 AS x FROM cells GROUP BY ALL),
rh AS (SELECT {v.sql_sunday('a.day')} AS p, i, j, avg({_RH.format(t='(a.x + 10)', td='b.x')}) AS x FROM m a JOIN m b USING (day, i, j) WHERE a.event_type = 'view' AND b.event_type = 'click' GROUP BY ALL)
SELECT zone_id, p AS period_start, {v.sql_r4('avg(x)')} AS mean FROM members JOIN rh USING (i, j) GROUP BY ALL""")
def humidity_indicator(spark, d):
    """Two kinds of events, scaled, as temperature and dew point."""
    got = ops.humidity_indicator(*_two(spark, d), zn.zone_cells(v.zones(spark, d), v.GRID), cal.epi_start)
    return got.withColumn("mean", v.r4(F.col("mean")))


@query("idw_surface", f"WITH {v.SQL_IDW} SELECT i, j, {v.sql_r4('value')} AS value FROM idw")
def idw_surface(spark, d):
    return ops.idw(v.stations(spark, d), v.station_points(spark)).select("i", "j", v.r4(F.col("value")).alias("value"))


@query("zone_normals", f"""WITH {v.SQL_IDW}, {v.SQL_ZONES}, box AS (SELECT zone_id, min(x) AS a, max(x) AS b, min(y) AS c, max(y) AS e FROM corners GROUP BY zone_id)
SELECT zone_id, {v.sql_r4('avg(value)')} AS normal FROM box JOIN idw ON i + 0.25 BETWEEN a AND b AND j + 0.5 BETWEEN c AND e GROUP BY zone_id""")
def zone_normals(spark, d):
    surface = ops.idw(v.stations(spark, d), v.station_points(spark))
    return ops.zone_normals(surface, v.zones(spark, d), v.STATION_GRID).select("zone_id", v.r4(F.col("normal")).alias("normal"))


@query("station_normals_join", f"""WITH {v.SQL_STATIONS} SELECT code, CAST(m + 1 AS INTEGER) AS month, {v.sql_r4('value / 100 + m')} AS value FROM stations, range(12) r(m) WHERE (code + m) % 5 <> 0""")
def station_normals_join(spark, d):
    """Normals in twelve columns, some of them no numbers."""
    s = v.stations(spark, d)
    wide = s.select("code", *[F.when((F.col("code") + m) % 5 != 0, (F.col("value") / 100 + m).cast("string")).otherwise(F.lit("-")).alias(name) for m, name in enumerate(readers.MONTHS)])
    got = ops.station_normals(s.drop("value"), readers.normals_to_long(wide, readers.MONTHS))
    return got.select("code", "month", v.r4(F.col("value")).alias("value"))


def _marked(spark, d):
    daily = v.obs(spark, d).groupBy("zone_id", "day").agg(F.max("value").alias("value")).withColumn("period_start", cal.epi_start(F.col("day")))
    return ops.attach_normal(daily, _normals(spark))


def _normals(spark):
    z = F.floor(F.col("id") / 12)
    return spark.range(25 * 12).select(z.alias("zone_id"), (F.col("id") % 12 + 1).cast("int").alias("month"), (60.0 + (z % 7) * 5 + F.col("id") % 12).alias("normal"))


_SQL_MARKED = f"""{v.SQL_OBS}, daily AS (SELECT zone_id, day, {v.sql_sunday('day')} AS period_start, max(value) AS value FROM obs GROUP BY ALL),
marked AS (SELECT *, value > 60 + (zone_id % 7) * 5 + month(period_start) - 1 AS above FROM daily)"""


@query("days_above_normal", f"WITH {_SQL_MARKED} SELECT zone_id, period_start, count(*) FILTER (WHERE above) AS days_above FROM marked GROUP BY ALL")
def days_above_normal(spark, d):
    return ops.days_above(_marked(spark, d))


_SQL_RUN = """runs AS (SELECT zone_id, period_start, g, count(*) AS n FROM (SELECT *, sum(CASE WHEN before = day - 1 THEN 0 ELSE 1 END) OVER (PARTITION BY zone_id, period_start ORDER BY day) AS g
  FROM (SELECT zone_id, period_start, day, lag(day) OVER (PARTITION BY zone_id, period_start ORDER BY day) AS before FROM marked WHERE above)) GROUP BY ALL)"""


@query("longest_run", f"WITH {_SQL_MARKED}, {_SQL_RUN} SELECT m.zone_id, m.period_start, coalesce(max(r.n), 0) AS longest_run FROM marked m LEFT JOIN runs r USING (zone_id, period_start) GROUP BY ALL")
def longest_run(spark, d):
    return ops.longest_run(_marked(spark, d))


@query("anomaly_indicator", f"""WITH {v.SQL_CELLS}, {v.SQL_ZONES}, daily AS (SELECT zone_id, day, {v.sql_sunday('day')} AS period_start, max(value) AS value FROM members JOIN cells USING (i, j) GROUP BY ALL),
marked AS (SELECT *, value > 60 + (zone_id % 7) * 5 + month(period_start) - 1 AS above FROM daily), {_SQL_RUN}
SELECT zone_id, period_start, days_above, coalesce(longest, 0) AS longest_run FROM (SELECT zone_id, period_start, count(*) FILTER (WHERE above) AS days_above FROM marked GROUP BY ALL)
LEFT JOIN (SELECT zone_id, period_start, max(n) AS longest FROM runs GROUP BY ALL) USING (zone_id, period_start)""")
def anomaly_indicator(spark, d):
    return ops.anomaly_indicator(v.cells(spark, d), zn.zone_cells(v.zones(spark, d), v.GRID), _normals(spark), cal.epi_start)


@query("climate_layer", f"""WITH {v.SQL_CELLS}, {v.SQL_ZONES}, s AS (SELECT CAST(date_trunc('month', day) AS DATE) AS period_start, i, j, max(value) - 273.15 AS hi, min(value) - 273.15 AS lo, avg(value) - 273.15 AS mid FROM cells WHERE year(day) = 2024 GROUP BY ALL)
SELECT CAST(n_nationkey AS BIGINT) AS zone_id, line.period_start, CAST(month(line.period_start) AS INTEGER) AS number, x.max, x.min, x.mean FROM nation CROSS JOIN (SELECT DISTINCT period_start FROM members JOIN s USING (i, j)) line
LEFT JOIN (SELECT zone_id, period_start, {v.sql_r4('max(hi)')} AS max, {v.sql_r4('min(lo)')} AS min, {v.sql_r4('avg(mid)')} AS mean FROM members JOIN s USING (i, j) GROUP BY ALL) x ON x.zone_id = n_nationkey AND x.period_start = line.period_start""")
def climate_layer(spark, d):
    """The whole pipeline of one family."""
    got = pipelines.climate_indicator("temp_era5land", "month", v.cells(spark, d).select("day", "i", "j", "value"), v.zones(spark, d), v.GRID, [2024])
    return got.select("zone_id", "period_start", "number", *[v.r4(F.col(c)).alias(c) for c in ("max", "min", "mean")])


def _families(spark, d, family, period, custom, **more):
    """A family over the observations, with a zone that has no cells."""
    return pipelines.climate_indicator(family, period, layer=v.zones_with_far(spark, d), grid=v.GRID, years=[2024], intervals=v.intervals(spark, d) if custom else None, **more)


def _sql_placed(custom: bool, period: str) -> str:
    """Cells with the start and number of their period."""
    if custom:
        return f"{v.SQL_INTERVALS}, placed AS (SELECT cells.*, a AS period_start, number FROM cells JOIN cal ON day BETWEEN a AND b WHERE year(day) = 2024)"
    if period == "month":
        return "placed AS (SELECT *, CAST(date_trunc('month', day) AS DATE) AS period_start, CAST(month(day) AS INTEGER) AS number FROM cells WHERE year(day) = 2024)"
    return f"placed AS (SELECT *, {v.sql_sunday('day')} AS period_start, {v.sql_epi_week('day')} AS number FROM cells WHERE {v.sql_epi_year('day')} = 2024 AND (year(day) = 2024 OR day BETWEEN DATE '2023-12-25' AND DATE '2023-12-31'))"


_SQL_LINE = "line AS (SELECT DISTINCT period_start, number FROM members JOIN placed USING (i, j))"


@query("climate_precipitation_epiweek", f"""WITH {v.SQL_CELLS}, {v.SQL_ZONES}, {v.SQL_FAR}, {_sql_placed(False, 'epiweek')}, {_SQL_LINE},
s AS (SELECT period_start, i, j, max(value * 1000) AS hi, avg(value * 1000) AS mid FROM placed GROUP BY ALL), x AS (SELECT zone_id, period_start, max(hi) AS hi, avg(mid) AS mid FROM members JOIN s USING (i, j) GROUP BY ALL)
SELECT zone_id, period_start, number, {v.sql_r4('hi')} AS max, {v.sql_r4('mid')} AS mean FROM layer CROSS JOIN line LEFT JOIN x USING (zone_id, period_start)""")
def climate_precipitation_epiweek(spark, d):
    got = _families(spark, d, "precip_era5land", "epiweek", False, cells=v.cells(spark, d).select("day", "i", "j", "value"), stats=["max", "mean"])
    return got.select("zone_id", "period_start", "number", v.r4(F.col("max")).alias("max"), v.r4(F.col("mean")).alias("mean"))


def _anomaly(name: str, period: str, custom: bool):
    sql = f"""WITH {v.SQL_CELLS}, {v.SQL_ZONES}, {v.SQL_FAR}, {_sql_placed(custom, period)}, {_SQL_LINE}, daily AS (SELECT zone_id, period_start, day, max(value + 273.15 - 273.15) AS value FROM members JOIN placed USING (i, j) GROUP BY ALL),
marked AS (SELECT *, value > 60 + (zone_id % 7) * 5 + month(period_start) - 1 AS above FROM daily), {_SQL_RUN}, d AS (SELECT zone_id, period_start, count(*) FILTER (WHERE above) AS n FROM marked GROUP BY ALL), r AS (SELECT zone_id, period_start, max(n) AS n FROM runs GROUP BY ALL)
SELECT layer.zone_id, line.period_start, number, coalesce(d.n, 0) AS days_above, coalesce(r.n, 0) AS longest_run FROM layer CROSS JOIN line LEFT JOIN d ON d.zone_id = layer.zone_id AND d.period_start = line.period_start LEFT JOIN r ON r.zone_id = layer.zone_id AND r.period_start = line.period_start"""

    @query(name, sql)
    def run(spark, d):
        cells = v.cells(spark, d).select("day", "i", "j", (F.col("value") + 273.15).alias("value"))
        return _families(spark, d, "anomaly_era5land", period, custom, cells=cells, normals=_normals(spark)).select("zone_id", "period_start", "number", "days_above", "longest_run")

    return run


climate_anomaly_month, climate_anomaly_custom = _anomaly("climate_anomaly_month", "month", False), _anomaly("climate_anomaly_custom", "month", True)


def _humidity(name: str, period: str, custom: bool):
    kelvin = lambda x: f"({x} + 273.15 - 273.15)"
    sql = f"""WITH {v.SQL_CELLS}, {v.SQL_ZONES}, {v.SQL_FAR}, {_sql_placed(custom, period)}, m AS (SELECT event_type, period_start, number, day, i, j, avg(value) / 20 AS x FROM placed GROUP BY ALL),
rh AS (SELECT period_start, number, i, j, avg({_RH.format(t=kelvin('a.x + 10'), td=kelvin('b.x'))}) AS x FROM m a JOIN m b USING (period_start, number, day, i, j) WHERE a.event_type = 'view' AND b.event_type = 'click' GROUP BY ALL),
z AS (SELECT zone_id, period_start, {v.sql_r4('avg(x)')} AS mean FROM members JOIN rh USING (i, j) GROUP BY ALL)
SELECT zone_id, period_start, number, mean FROM layer CROSS JOIN (SELECT DISTINCT period_start, number FROM members JOIN rh USING (i, j)) LEFT JOIN z USING (zone_id, period_start)"""

    @query(name, sql)
    def run(spark, d):
        t, td = (x.withColumn("value", F.col("value") + 273.15) for x in _two(spark, d))
        got = _families(spark, d, "humidity_era5land", period, custom, cells=t, dewpoint=td)
        return got.select("zone_id", "period_start", "number", v.r4(F.col("mean")).alias("mean"))

    return run


climate_humidity_epiweek, climate_humidity_custom = _humidity("climate_humidity_epiweek", "epiweek", False), _humidity("climate_humidity_custom", "month", True)
