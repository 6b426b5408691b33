"""Indicator tables: splitting, enriching, classes, colours and rows for the database."""

from __future__ import annotations

from pyspark.sql import functions as F

from geohealth.functions import calendar as cal
from geohealth.operators import calendar as calops
from geohealth.operators import classify
from geohealth.operators import health as ops
from geohealth.plans import pipelines
from geohealth.queries import views as v
from geohealth.queries.calendar import case_years
from geohealth.queries.registry import query

_AGG = "CASE WHEN o_orderkey % 2 = 0 THEN 'municipality' ELSE 'state' END"
_TIME = "CASE WHEN o_orderkey % 3 = 0 THEN 'week' WHEN o_orderkey % 3 = 1 THEN 'month' ELSE 'epiweek' END"


def _tagged(spark, d):
    """The indicator table without Julys of i0."""
    return _all_tagged(spark, d).where("indicator <> 'i0' OR month(day) <> 7")


def _all_tagged(spark, d):
    """Cases as an indicator table: every 11th code is missing, every 13th no number. i0 has values below 1."""
    k = F.col("o_orderkey")
    cod = F.when(k % 11 == 0, None).when(k % 13 == 0, F.lit("x")).otherwise(F.col("code").cast("string"))
    kind = F.when(k % 3 == 0, "week").when(k % 3 == 1, "month").otherwise("epiweek")
    small = k % 5 == 0
    return v.cases(spark, d).select(
        "o_orderkey", cod.alias("cod"), F.date_format("day", "yyyy-MM-dd").alias("date"), F.when(small, "i0").otherwise("i1").alias("indicator"), F.when(k % 2 == 0, "municipality").otherwise("state").alias("agg"),
        kind.alias("agg_time"), F.when(small, F.col("value") / 1e6 + 3.3e-9).otherwise(F.col("value")).alias("value"), "day")


def _registry(spark, d):
    r = v.table(spark, d, "region")
    k = F.col("r_regionkey")
    return r.select(F.concat(F.lit("p"), (k % 2).cast("string")).alias("provider"), F.concat(F.lit("i"), F.floor(k / 2).cast("string")).alias("id"), F.concat(F.lit("Title of "), F.lower("r_name")).alias("title"))


_SQL_REG = "reg AS (SELECT 'p' || (r_regionkey % 2) AS provider, 'i' || (r_regionkey // 2) AS id, 'Title of ' || lower(r_name) AS title FROM region)"
_SQL_ALL_TAG = f"{v.SQL_CASES}, tagged AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'x' ELSE CAST(code AS VARCHAR) END AS cod, day, CASE WHEN o_orderkey % 5 = 0 THEN 'i0' ELSE 'i1' END AS indicator, {_AGG} AS agg, {_TIME} AS kind, CASE WHEN o_orderkey % 5 = 0 THEN value / 1e6 + 3.3e-9 ELSE value END AS value FROM cases)"
_SQL_TAG = f"{_SQL_ALL_TAG[:-1]} WHERE o_orderkey % 5 <> 0 OR month(day) <> 7)"


@query("combination_split", f"WITH {_SQL_TAG} SELECT o_orderkey, agg, CASE WHEN kind = 'week' THEN 'epiweek' ELSE kind END AS agg_time FROM tagged WHERE cod IS NOT NULL AND agg = 'municipality' AND kind IN ('week', 'epiweek', 'month')")
def combination_split(spark, d):
    return ops.select_combinations(_tagged(spark, d), ["municipality"], ["week", "month"]).select("o_orderkey", "agg", "agg_time")


@query("region_crop", f"WITH {v.SQL_CASES} SELECT o_orderkey, code FROM cases WHERE code IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def region_crop(spark, d):
    region = v.table(spark, d, "nation").where("n_regionkey = 1").select(F.col("n_nationkey").cast("long").alias("code"))
    return ops.crop_to_region(v.cases(spark, d), region).select("o_orderkey", "code")


@query("zone_enrichment", f"WITH {v.SQL_CASES} SELECT o_orderkey, code, n_name AS name, 'R' || n_regionkey AS uf FROM cases JOIN nation ON n_nationkey = code WHERE n_nationkey % 4 <> 3")
def zone_enrichment(spark, d):
    """Every fourth zone is missing from the layer."""
    return ops.enrich_zones(v.cases(spark, d), v.zones(spark, d).where("zone_id % 4 <> 3")).select("o_orderkey", "code", "name", "uf")


@query("indicator_registry", f"WITH {_SQL_ALL_TAG}, {_SQL_REG} SELECT t.o_orderkey, t.indicator, r.title, r.provider FROM tagged t JOIN reg r ON r.id = t.indicator WHERE r.provider = 'p0'")
def indicator_registry(spark, d):
    return ops.attach_indicator(_all_tagged(spark, d), _registry(spark, d), "p0").select("o_orderkey", "indicator", "title", "provider")


def _west(rings: str):
    return F.array_min(F.transform(F.flatten(rings), lambda p: p["x"]))


@query("vintage_refresh", f"WITH {v.SQL_ZONES}, west AS (SELECT zone_id, min(x) AS x FROM corners GROUP BY zone_id) SELECT CAST(n_nationkey AS BIGINT) AS zone_id, x + CASE WHEN n_nationkey % 3 = 0 THEN 1 ELSE 0 END AS west, CASE WHEN n_nationkey % 3 = 0 THEN 'new ' || n_name ELSE n_name END AS name, CASE WHEN n_nationkey % 3 = 0 THEN 'N' || n_regionkey ELSE 'R' || n_regionkey END AS uf FROM nation JOIN west ON zone_id = n_nationkey")
def vintage_refresh(spark, d):
    old = v.zones(spark, d)
    new = old.where("zone_id % 3 = 0").select("zone_id", F.concat(F.lit("new "), "name").alias("name"), F.replace("uf", F.lit("R"), F.lit("N")).alias("uf"),
                                            F.transform("rings", lambda ring: F.transform(ring, lambda p: F.struct((p["x"] + 1).alias("x"), p["y"].alias("y")))).alias("rings"))
    return ops.refresh_zones(old, new).select("zone_id", "name", "uf", _west("rings").alias("west"))


_SQL_BREAKS = "breaks AS (SELECT min(value) AS least, max(value) AS most, (max(value) - min(value)) / 5 AS step FROM cases)"


@query("class_breaks", f"WITH {v.SQL_CASES}, {_SQL_BREAKS} SELECT least, most, {v.sql_r4('step')} AS step, CAST(CASE WHEN most > 0 AND most < 1 THEN 4 ELSE 2 END AS INTEGER) AS decimals FROM breaks")
def class_breaks(spark, d):
    return classify.class_breaks(v.cases(spark, d)).withColumn("step", v.r4(F.col("step")))


@query("equal_interval_class", f"""WITH {v.SQL_CASES}, {_SQL_BREAKS}, b AS (SELECT [round(least + step * k, 2) FOR k IN [1, 2, 3, 4]] AS b FROM breaks)
SELECT o_orderkey, CAST(1 + len(list_filter(b, lambda x: value >= x)) AS INTEGER) AS class, CASE 1 + len(list_filter(b, lambda x: value >= x)) WHEN 1 THEN printf('Lower than %.2f', b[1]) WHEN 5 THEN printf('Greater than %.2f', b[4])
  ELSE printf('Between %.2f and %.2f', b[len(list_filter(b, lambda x: value >= x))], b[1 + len(list_filter(b, lambda x: value >= x))]) END AS label FROM cases, b""")
def equal_interval_class(spark, d):
    return classify.equal_interval_class(v.cases(spark, d)).select("o_orderkey", "class", "label")


@query("adaptive_round", f"WITH {v.SQL_CASES} SELECT o_orderkey, round(value / 1000000 + 3e-7, 4) AS value FROM cases")
def adaptive_round(spark, d):
    """Values below 1, so four decimals."""
    return classify.adaptive_round(v.cases(spark, d).withColumn("value", F.col("value") / 1_000_000 + v.NUDGE)).select("o_orderkey", "value")


PALETTE = [(0.0, "0:0:128"), (100_000.0, "0:128:255"), (200_000.0, "0:255:128"), (300_000.0, "255:255:0"), (400_000.0, "255:64:0")]
_SQL_PALETTE = "palette AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {t}::DOUBLE, '{c}')" for i, (t, c) in enumerate(PALETTE)) + ") p(idx, threshold, color))"


@query("nearest_color", f"WITH {v.SQL_CASES}, {_SQL_PALETTE} SELECT o_orderkey, arg_min(color, abs(threshold - value) * 10 + idx * 1e-6) AS color FROM cases, palette GROUP BY o_orderkey")
def nearest_color(spark, d):
    return v.cases(spark, d).select("o_orderkey", classify.nearest_color(F.col("value"), PALETTE).alias("color"))


@query("bin_color", f"WITH {v.SQL_CASES}, {_SQL_PALETTE} SELECT o_orderkey, CASE WHEN o_orderkey % 17 = 0 THEN 'transparent' ELSE (SELECT color FROM palette WHERE idx = least(4, (SELECT count(*) FROM palette q WHERE q.threshold < c.value))) END AS color FROM cases c")
def bin_color(spark, d):
    value = F.when(F.col("o_orderkey") % 17 != 0, F.col("value"))
    return v.cases(spark, d).select("o_orderkey", classify.bin_color(value, PALETTE).alias("color"))


_WEEKS = ["19950101", "19950108", "19950115", "19950122"]


_MONTHS = [f"2000{m:02d}01" for m in range(1, 13)]
_SQL_YEARLY = "yearly AS (SELECT code * 10000 + year(day) AS code, CAST(month(day) AS INTEGER) AS m, count(*) AS n FROM cases GROUP BY ALL)"


def _monthly(spark, d):
    """Cases by month, with the code and year as key and the month in a year that stands for all."""
    day = F.col("day")
    return v.cases(spark, d).groupBy((F.col("code") * 10_000 + F.year(day)).alias("code"), F.make_date(F.lit(2000), F.month(day), F.lit(1)).alias("period_start")).agg(F.count(F.lit(1)).alias("value"))


@query("long_to_wide", f"WITH {v.SQL_CASES}, {_SQL_YEARLY} SELECT code, " + ", ".join(f"max(CASE WHEN m = {int(w[4:6])} THEN n END) AS w_{w}" for w in _MONTHS) + " FROM yearly GROUP BY code")
def long_to_wide(spark, d):
    """All months of the table: a row a code and year."""
    return ops.periods_to_wide(_monthly(spark, d), "code", _MONTHS)


@query("wide_to_long", f"WITH {v.SQL_CASES}, {_SQL_YEARLY} SELECT c.code, make_date(2000, t.m, 1) AS period_start, w.n AS value FROM (SELECT DISTINCT code FROM yearly) c CROSS JOIN (SELECT CAST(unnest(range(1, 13)) AS INTEGER) AS m) t LEFT JOIN yearly w ON w.code = c.code AND w.m = t.m")
def wide_to_long(spark, d):
    """A code and year without cases in a month keeps its row."""
    return ops.periods_to_long(long_to_wide(spark, d), "code")


_SQL_LAYER = f"""{_SQL_TAG}, {_SQL_REG}, {v.SQL_ZONES}, r AS (SELECT TRY_CAST(cod AS BIGINT) AS code, n_name AS name, 'R' || n_regionkey AS uf, provider AS data_source, title AS name_indicator, CASE WHEN kind = 'month' THEN 'month' ELSE 'epiweek' END AS time_agg, agg AS spatial_agg, day, value
  FROM tagged JOIN reg ON reg.id = indicator AND provider = 'p0' JOIN nation ON n_nationkey = TRY_CAST(cod AS BIGINT)),
s AS (SELECT *, CASE WHEN time_agg = 'month' THEN CAST(date_trunc('month', day) AS DATE) ELSE day END AS start_date FROM r),
most AS (SELECT name_indicator, spatial_agg, time_agg, max(value) AS most FROM s GROUP BY ALL),
line AS (SELECT name_indicator, spatial_agg, time_agg, start_date, lead(start_date) OVER (PARTITION BY name_indicator, spatial_agg, time_agg ORDER BY start_date) AS nxt FROM (SELECT DISTINCT name_indicator, spatial_agg, time_agg, start_date FROM s)),
health AS (SELECT code, name, uf, data_source, name_indicator, CASE WHEN time_agg = 'month' THEN CAST(month(start_date) AS INTEGER) ELSE {v.sql_epi_week('start_date')} END AS number, start_date,
  CAST(coalesce(nxt - 1, CASE WHEN time_agg = 'month' THEN CAST(start_date + INTERVAL 1 MONTH AS DATE) - 1 ELSE start_date END) AS DATE) AS end_date, time_agg, spatial_agg, CASE WHEN most > 0 AND most < 1 THEN round(value, 4) ELSE round(value, 2) END AS value
  FROM s JOIN line USING (name_indicator, spatial_agg, time_agg, start_date) JOIN most USING (name_indicator, spatial_agg, time_agg))"""


def _health(spark, d):
    epi = calops.epi_calendar(spark, case_years(spark, d))
    return pipelines.health_indicator(_tagged(spark, d), ["municipality", "state"], ["week", "month"], v.zones(spark, d), epi, _registry(spark, d), "p0")


@query("health_layer", f"WITH {_SQL_LAYER} SELECT h.*, CAST(5 AS INTEGER) AS corners, west FROM health h JOIN (SELECT zone_id, min(x) AS west FROM corners GROUP BY zone_id) ON zone_id = code")
def health_layer(spark, d):
    """The whole pipeline over two indicators of different size, one of them without Julys, in two kinds of places and periods."""
    return _health(spark, d).withColumn("corners", F.size(F.flatten("geometry"))).withColumn("west", _west("geometry")).drop("geometry")


@query("layer_db_rows", f"""WITH {_SQL_LAYER}, shape AS (SELECT zone_id, 'SRID=4326;MULTIPOLYGON(((' || string_agg(CAST(x AS VARCHAR) || ' ' || CAST(y AS VARCHAR), ', ' ORDER BY p) || ', ' || arg_min(CAST(x AS VARCHAR) || ' ' || CAST(y AS VARCHAR), p) || ')))' AS geometry FROM corners GROUP BY zone_id)
SELECT code, name_indicator, geometry, count(*) AS n, CAST(sum(CAST(round(value + 3e-7, 2) AS DECIMAL(10, 2))) AS DECIMAL(20, 2)) AS total FROM health JOIN shape ON zone_id = code GROUP BY ALL""")
def layer_db_rows(spark, d):
    """The pipeline's rows as they are loaded into a database, with their shapes as text."""
    rows = ops.to_db_rows(_health(spark, d), "health")
    return rows.groupBy("code", "name_indicator", "geometry").agg(F.count(F.lit(1)).alias("n"), F.sum("value").cast("decimal(20,2)").alias("total"))


@query("classified_layers", f"""WITH {_SQL_TAG}, b AS (SELECT indicator, agg, min(value) AS least, max(value) AS most FROM tagged GROUP BY ALL), breaks AS (SELECT indicator, agg, most > 0 AND most < 1 AS fine, [least + (most - least) / 5 * k FOR k IN [1, 2, 3, 4]] AS e FROM b),
shown AS (SELECT indicator, agg, [CASE WHEN fine THEN round(x, 4) ELSE round(x, 2) END FOR x IN e] AS steps, [CASE WHEN fine THEN printf('%.4f', round(x, 4)) ELSE printf('%.2f', round(x, 2)) END FOR x IN e] AS t FROM breaks),
c AS (SELECT o_orderkey, 1 + len(list_filter(steps, lambda x: value >= x)) AS class, t FROM tagged JOIN shown USING (indicator, agg))
SELECT o_orderkey, CAST(class AS INTEGER) AS class, CASE class WHEN 1 THEN 'Lower than ' || t[1] WHEN 5 THEN 'Greater than ' || t[4] ELSE 'Between ' || t[class - 1] || ' and ' || t[class] END AS label FROM c""")
def classified_layers(spark, d):
    """Four layers in one table, each with classes of its own."""
    return pipelines.classify_layer(_tagged(spark, d), by=["indicator", "agg"]).select("o_orderkey", "class", "label")


def _loose(spark, d):
    k = F.col("o_orderkey")
    return v.cases(spark, d).select("o_orderkey", F.when(k % 11 != 0, F.col("code")).alias("code"), F.when(k % 7 != 0, F.month("day")).alias("number"), F.when(k % 5 != 0, F.col("value")).alias("value"))


_SQL_LOOSE = f"WITH {v.SQL_CASES}, loose AS (SELECT o_orderkey, CASE WHEN o_orderkey % 11 <> 0 THEN code END AS code, CAST(CASE WHEN o_orderkey % 7 <> 0 THEN month(day) END AS INTEGER) AS number, CASE WHEN o_orderkey % 5 <> 0 THEN value END AS value FROM cases)"


@query("db_rows_health", _SQL_LOOSE + " SELECT o_orderkey, code, coalesce(number, 0) AS number, CAST(coalesce(value, 0) AS DECIMAL(10, 2)) AS value FROM loose")
def db_rows_health(spark, d):
    return ops.to_db_rows(_loose(spark, d), "health")


@query("db_rows_climate", _SQL_LOOSE + " SELECT o_orderkey, code, number, CAST(value AS DECIMAL(10, 4)) AS value FROM loose WHERE code IS NOT NULL AND value IS NOT NULL")
def db_rows_climate(spark, d):
    return ops.to_db_rows(_loose(spark, d), "climate")


@query("missing_filled", _SQL_LOOSE + " SELECT o_orderkey, coalesce(value, 0) AS value FROM loose")
def missing_filled(spark, d):
    return ops.fill_missing(_loose(spark, d), ["value"]).select("o_orderkey", "value")


@query("standard_schema", f"WITH {_SQL_TAG} SELECT TRY_CAST(cod AS BIGINT) AS code, agg AS spatial_agg, 'src' AS data_source, 'cases' AS name_indicator, 'epiweek' AS time_agg, count(*) AS n FROM tagged GROUP BY ALL")
def standard_schema(spark, d):
    """Codes coerced and the canonical columns in order, counted by code."""
    t = _tagged(spark, d).withColumn("code", F.col("cod"))
    described = ops.describe(t, "src", "cases", "epiweek", "mun").withColumn("spatial_agg", F.col("agg"))
    return ops.standardize(described).groupBy("code", "spatial_agg", "data_source", "name_indicator", "time_agg").agg(F.count(F.lit(1)).alias("n"))


@query("union_slices", f"WITH {v.SQL_CASES} SELECT o_orderkey, code, CASE WHEN code < 12 THEN value END AS value FROM cases")
def union_slices(spark, d):
    """Slices by code, of which one has no values."""
    c = v.cases(spark, d).select("o_orderkey", "code", "value")
    return ops.union_all([c.where("code < 12"), c.where("code >= 12").drop("value")])


@query("dedupe_cases", "SELECT user_id, event_type, CAST(ts AS DATE) AS day FROM events GROUP BY ALL")
def dedupe_cases(spark, d):
    return ops.dedupe(v.obs(spark, d).select("user_id", "event_type", "day"))


@query("first_case", f"WITH {v.SQL_CASES} SELECT code, arg_min(value, CAST(strftime(day, '%Y%m%d') AS BIGINT) * 1000000000 + o_orderkey) AS first FROM cases GROUP BY code")
def first_case(spark, d):
    return ops.first_by(v.cases(spark, d), ["code"], F.col("value"), F.struct("day", "o_orderkey"))
