"""Sinks and readers: views of the tables are written to the shared folder, read back and aggregated."""

from __future__ import annotations

from pyspark.sql import functions as F

from geohealth.functions import calendar as cal
from geohealth.operators import health as ops
from geohealth.operators import zones as zn
from geohealth.plans import pipelines
from geohealth.queries import views as v
from geohealth.queries.incremental import _folder
from geohealth.queries.registry import query
from geohealth.sources import readers, writers

_ROLES = readers.ColumnRoles("geocode", "when_", "what", "level", "step", "amount")


@query("indicator_table", f"WITH {v.SQL_CASES} SELECT code % 2 = 0 AS even, 'i' || (o_orderkey % 3) AS indicator, count(*) AS n, {v.sql_r4('sum(value)')} AS total FROM cases GROUP BY ALL")
def indicator_table(spark, d):
    """Parquet files of an indicator table under other names, read by their roles."""
    path = _folder(spark, "indicator") + ".parquet"
    k = F.col("o_orderkey")
    raw = v.cases(spark, d).select(F.col("code").alias("geocode"), F.date_format("day", "yyyy-MM-dd").alias("when_"), F.concat(F.lit("i"), (k % 3).cast("string")).alias("what"), F.lit("municipality").alias("level"), F.lit("month").alias("step"), F.col("value").alias("amount"))
    raw.write.parquet(path)
    got = readers.read_indicator(spark, path, _ROLES)
    return got.groupBy((F.col("cod") % 2 == 0).alias("even"), "indicator").agg(F.count(F.lit(1)).alias("n"), v.r4(F.sum("value")).alias("total"))


@query("indicator_table_csv", f"WITH {v.SQL_CASES} SELECT CAST(code AS VARCHAR) AS cod, count(*) AS n FROM cases GROUP BY ALL")
def indicator_table_csv(spark, d):
    """The same as CSV, all of it text."""
    path = _folder(spark, "indicator") + ".csv"
    v.cases(spark, d).select(F.col("code").alias("geocode"), F.col("day").alias("when_"), F.lit("x").alias("what"), F.lit("municipality").alias("level"), F.lit("month").alias("step"), F.col("value").alias("amount")).write.option("header", True).csv(path)
    return readers.read_indicator(spark, path, _ROLES).groupBy("cod").agg(F.count(F.lit(1)).alias("n"))


@query("case_pages", f"WITH {v.SQL_CASES} SELECT CAST(code + 10 AS BIGINT) AS cod, day AS date, CAST('state' AS VARCHAR) AS agg, count(*) AS n FROM (SELECT DISTINCT code, day, CASE WHEN o_orderkey % 5 <> 0 THEN round(value) ELSE 0 END AS x FROM cases WHERE day >= DATE '1996-01-01' AND code < 20) GROUP BY ALL")
def case_pages(spark, d):
    """Cases as JSON pages of the records of 4,000 keys at most; missing values are 0, repeats go, older days are left out."""
    path = _folder(spark, "pages")
    k = F.col("o_orderkey")
    record = F.struct(F.date_format("day", "yyyy-MM-dd").alias("data_iniSE"), (F.col("code") + 10).alias("municipio_geocodigo"), F.when(k % 5 != 0, F.round("value")).alias("casos"))
    pages = v.cases(spark, d).where("code < 20").groupBy(F.floor(k / 4000).alias("page")).agg(F.collect_list(record).alias("items"))
    pages.select("items").write.option("maxRecordsPerFile", 1).json(path)  # a file for each page
    got = readers.read_case_pages(spark, path, "casos", "cases", start="1996-01-01")
    return got.groupBy("cod", "date", "agg").agg(F.count(F.lit(1)).alias("n"))


@query("custom_calendar_file", f"SELECT CAST(year(w) AS INTEGER) AS year, count(*) AS n, min(w) AS first, CAST(max(w) + 6 AS DATE) AS last FROM (SELECT DISTINCT {v.sql_sunday('CAST(o_orderdate AS DATE)')} AS w FROM orders) GROUP BY ALL")
def custom_calendar_file(spark, d):
    """A calendar of the orders' weeks as CSV with days first, read again."""
    path = _folder(spark, "calendar")
    start = cal.epi_start(F.to_date("o_orderdate"))
    weeks = v.table(spark, d, "orders").select(start.alias("s")).distinct()
    shown = lambda c: F.date_format(c, "dd/MM/yyyy")
    weeks.select(F.year("s").alias("Year"), cal.epi_week(F.col("s")).alias("Week"), shown("s").alias("StartDate"), shown(F.date_add("s", 6)).alias("EndDate")).write.option("header", True).csv(path)
    return readers.read_calendar(spark, path).groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.min("start_date").alias("first"), F.max("end_date").alias("last"))


@query("station_catalogue", f"WITH {v.SQL_STATIONS} SELECT CAST(code AS VARCHAR) AS code, 'N' || nation AS uf, lat, lon FROM stations")
def station_catalogue(spark, d):
    """Stations with decimal commas and semicolons between fields."""
    path = _folder(spark, "stations")
    comma = lambda c: F.translate(F.col(c).cast("string"), ".", ",")
    s = v.stations(spark, d)
    s.select(F.col("code").alias("CD_ESTACAO"), F.lit("x").alias("DC_NOME"), F.concat(F.lit("N"), "nation").alias("SG_ESTADO"), comma("lat").alias("VL_LATITUDE"), comma("lon").alias("VL_LONGITUDE"), comma("value").alias("VL_ALTITUDE")).write.option("header", True).option("sep", ";").csv(path)
    return readers.read_stations(spark, path).select("code", "uf", "lat", "lon")


@query("cells_of_years", f"WITH {v.SQL_CELLS} SELECT i, j, count(*) AS n, max(value) AS most FROM cells WHERE event_type = 'click' AND (year(day) = 2024 OR day BETWEEN DATE '2023-12-25' AND DATE '2023-12-31') GROUP BY ALL")
def cells_of_years(spark, d):
    """A cell table by variable, year and month, of which one variable's partitions are read."""
    path = _folder(spark, "cells")
    writers.write_cells(v.cells(spark, d).withColumnRenamed("event_type", "variable"), path)
    return readers.read_cells(spark, path, "click", [2024], "epiweek").groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("most"))


@query("cells_of_box", f"""WITH {v.SQL_CELLS}, {v.SQL_ZONES}, b AS (SELECT floor(min(x)) - 1 AS i0, floor(max(x)) + 1 AS i1, floor(min(y)) - 1 AS j0, floor(max(y)) + 1 AS j1 FROM corners WHERE zone_id IN (6, 7))
SELECT i, j, count(*) AS n, max(value) AS most FROM cells, b WHERE event_type = 'view' AND year(day) = 2024 AND i BETWEEN i0 AND i1 AND j BETWEEN j0 AND j1 GROUP BY ALL""")
def cells_of_box(spark, d):
    """Cells near two zones only: the box goes down to the files."""
    path = _folder(spark, "cells")
    writers.write_cells(v.cells(spark, d).withColumnRenamed("event_type", "variable"), path)
    span = zn.cell_span(v.zones(spark, d).where("zone_id IN (6, 7)"), v.GRID)
    return readers.read_cells(spark, path, "view", [2024], "month", span).groupBy("i", "j").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("most"))


@query("zone_layer_file", f"WITH {v.SQL_ZONES} SELECT zone_id, n_name AS name, CAST(count(*) AS INTEGER) AS corners, min(x) AS west, max(y) AS north FROM corners JOIN nation ON n_nationkey = zone_id GROUP BY ALL")
def zone_layer_file(spark, d):
    """GeoJSON features, a line each, read as a layer again."""
    path = _folder(spark, "zones")
    writers.write_geojson_lines(v.zones(spark, d), path)
    got = readers.read_zones(spark, path, {"zone_id": "zone_id", "name": "name", "uf": "uf"}, lines=True)
    points = F.flatten("rings")
    return got.select("zone_id", "name", F.size(points).alias("corners"), F.array_min(F.transform(points, lambda p: p["x"])).alias("west"), F.array_max(F.transform(points, lambda p: p["y"])).alias("north"))


@query("registry_file", """WITH reg AS (SELECT 'p' || (r_regionkey % 2) AS provider, 'i' || r_regionkey AS id, 'Title of ' || lower(r_name) AS title, 'http://p' || (r_regionkey % 2) AS url FROM region)
SELECT o_orderkey, 'i' || (o_orderkey % 3 * 2) AS indicator, title, provider, url, 'BRA' AS country FROM orders JOIN reg ON id = 'i' || (o_orderkey % 3 * 2) WHERE provider = 'p0'""")
def registry_file(spark, d):
    """A registry as a JSON file; the orders' indicators must be in it."""
    path = _folder(spark, "registry")
    k = F.col("r_regionkey")
    own = F.struct(F.concat(F.lit("i"), k.cast("string")).alias("id"), F.concat(F.lit("Title of "), F.lower("r_name")).alias("title"), F.lit("casos").alias("field_name"))
    by = v.table(spark, d, "region").groupBy(F.concat(F.lit("p"), (k % 2).cast("string")).alias("p")).agg(F.collect_list(own).alias("indicators"))
    entry = F.struct(F.col("p").alias("name"), F.concat(F.lit("http://"), "p").alias("url"), F.lit("BRA").alias("country"), "indicators")
    by.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("p", entry)))).alias("value")).write.text(path)  # a row a provider
    registry = readers.read_registry(spark, path)
    ops.require_indicators(registry, "p0", ["i0", "i2", "i4"])
    orders = v.table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("i"), (F.col("o_orderkey") % 3 * 2).cast("string")).alias("indicator"))
    return ops.attach_indicator(orders, registry, "p0").select("o_orderkey", "indicator", "title", "provider", "url", "country")


@query("period_files", f"""WITH {v.SQL_CASES}, c AS (SELECT CAST(date_trunc('month', day) AS DATE) AS period_start, 'i' || (o_orderkey % 2) AS name_indicator, o_orderkey FROM cases)
SELECT period_start, name_indicator, count(*) AS n FROM c WHERE NOT (name_indicator = 'i1' AND month(period_start) = 3 AND o_orderkey % 4 = 1) GROUP BY ALL""")
def period_files(spark, d):
    """A directory for each indicator and month: one indicator is written, then the other beside it, then its Marches anew."""
    path = _folder(spark, "periods")
    rows = v.cases(spark, d).select("code", "value", "o_orderkey", F.trunc("day", "month").alias("period_start"), F.concat(F.lit("i"), (F.col("o_orderkey") % 2).cast("string")).alias("name_indicator"))
    for part in ("name_indicator = 'i0'", "name_indicator = 'i1'", "name_indicator = 'i1' AND month(period_start) = 3 AND o_orderkey % 4 <> 1"):
        writers.write_periods(rows.where(part), path)
    return spark.read.parquet(path).groupBy("period_start", "name_indicator").agg(F.count(F.lit(1)).alias("n"))


@query("custom_climate", f"""WITH {v.SQL_CELLS}, {v.SQL_ZONES}, {v.SQL_INTERVALS},
s AS (SELECT a AS period_start, number, i, j, max(value) AS hi FROM cells JOIN cal ON day BETWEEN a AND b WHERE year(day) = 2024 GROUP BY ALL), line AS (SELECT DISTINCT period_start, number FROM members JOIN s USING (i, j))
SELECT CAST(n_nationkey AS BIGINT) AS zone_id, line.period_start, line.number, x.max, 'temp_cptec' AS name_indicator, 'custom' AS time_agg, 'municipality' AS spatial_agg, 'source' AS data_source
FROM nation CROSS JOIN line LEFT JOIN (SELECT zone_id, period_start, max(hi) AS max FROM members JOIN s USING (i, j) GROUP BY ALL) x ON x.zone_id = n_nationkey AND x.period_start = line.period_start""")
def custom_climate(spark, d):
    """The climate pipeline over intervals of seven days with gaps, with descriptions."""
    return pipelines.climate_indicator("temp_cptec", "month", v.cells(spark, d).select("day", "i", "j", "value"), v.zones(spark, d), v.GRID, [2024], ["max"], intervals=v.intervals(spark, d), source="source")


@query("ordered_periods", f"SELECT {v.sql_sunday('CAST(o_orderdate AS DATE)')} AS period_start, count(*) AS n FROM orders GROUP BY ALL")
def ordered_periods(spark, d):
    weekly = v.table(spark, d, "orders").groupBy(cal.epi_start(F.to_date("o_orderdate")).alias("period_start")).agg(F.count(F.lit(1)).alias("n"))
    return ops.order_periods(weekly, "period_start")
