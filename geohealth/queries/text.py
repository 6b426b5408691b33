"""Names, dates in them, items, manifests and releases."""

from __future__ import annotations

from pyspark.sql import functions as F

from geohealth.functions import calendar as cal
from geohealth.functions import physics
from geohealth.functions import text as fn
from geohealth.operators import health
from geohealth.operators import imagery as ops
from geohealth.queries import views as v
from geohealth.queries.registry import query
from geohealth.sources import writers

_EXT = ["tif", "png", "json", "csv"]


def _paths(spark, d):
    """Names with a moment, a day, a range of days or no date; an item's files lie in different directories."""
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    later = F.date_format(F.date_add(F.to_date("o_orderdate"), 6), "yyyyMMdd")
    when = F.when(k % 4 == 0, day).when(k % 4 == 1, F.concat(day, F.lit("T101530"))).when(k % 4 == 2, F.concat_ws("_", day, later)).otherwise(F.lit("none"))
    extension = F.get(F.array(*[F.lit(e) for e in _EXT]), (k % 7 % 4).cast("int"))
    name = F.concat(F.lit("item"), (F.col("o_custkey") % 300).cast("string"), F.lit("_"), when)
    return v.table(spark, d, "orders").select("o_orderkey", F.concat(F.lit("/data/d"), (k % 5).cast("string"), F.lit("/"), name, F.lit("."), extension).alias("path"), name.alias("name"))


_SQL_PATHS = """named AS (SELECT o_orderkey, 'item' || (o_custkey % 300) || '_' || CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') || 'T101530' WHEN 2 THEN strftime(o_orderdate, '%Y%m%d') || '_' || strftime(o_orderdate + INTERVAL 6 DAY, '%Y%m%d') ELSE 'none' END AS name,
  strftime(o_orderdate, '%Y-%m-%d') || CASE WHEN o_orderkey % 4 = 1 THEN 'T10:15:30' ELSE 'T00:00:00' END AS s, strftime(CASE WHEN o_orderkey % 4 = 2 THEN o_orderdate + INTERVAL 6 DAY ELSE o_orderdate END, '%Y-%m-%d') || CASE WHEN o_orderkey % 4 = 1 THEN 'T10:15:30' ELSE 'T00:00:00' END AS e,
  ['tif', 'png', 'json', 'csv'][o_orderkey % 7 % 4 + 1] AS ext FROM orders), paths AS (SELECT *, '/data/d' || (o_orderkey % 5) || '/' || name || '.' || ext AS path FROM named)"""


@query("item_dates", f"WITH {_SQL_PATHS} SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 3 THEN s END AS start, CASE WHEN o_orderkey % 4 <> 3 THEN e END AS \"end\" FROM paths")
def item_dates(spark, d):
    start, end = fn.item_dates(F.col("name"))
    return _paths(spark, d).select("o_orderkey", start.alias("start"), end.alias("end"))


@query("item_assets", f"WITH {_SQL_PATHS} SELECT name AS item, s AS start, e AS \"end\", string_agg(ext, ',' ORDER BY ext) AS keys, count(*) AS n, min(p) AS first FROM (SELECT name, s, e, ext, min(path) AS p FROM paths WHERE o_orderkey % 4 <> 3 GROUP BY ALL) GROUP BY ALL")
def item_assets(spark, d):
    items = ops.build_items(_paths(spark, d))
    keys = F.array_sort(F.map_keys("assets"))
    first = F.array_min(F.transform(F.map_values("assets"), lambda a: a["href"]))
    return items.select("item", "start", "end", F.array_join(keys, ",").alias("keys"), F.size("assets").cast("long").alias("n"), first.alias("first"))


@query("pending_items", f"WITH {_SQL_PATHS} SELECT o_orderkey FROM paths WHERE name NOT IN (SELECT name FROM paths WHERE o_orderkey % 10 = 0)")
def pending_items(spark, d):
    p = _paths(spark, d).withColumnRenamed("name", "item")
    return ops.pending(p, p.where("o_orderkey % 10 = 0")).select("o_orderkey")


@query("dates_from_paths", f"WITH {_SQL_PATHS} SELECT DISTINCT s AS start FROM paths WHERE o_orderkey % 4 <> 3")
def dates_from_paths(spark, d):
    return ops.dates_from_paths(_paths(spark, d))


@query("latest_release", "SELECT o_orderkey, 'set ' || o_orderpriority || ' ' || o_orderkey AS asset_name FROM orders WHERE o_orderpriority LIKE '%URGENT%' ORDER BY o_orderdate DESC, 'set ' || o_orderpriority || ' ' || o_orderkey LIMIT 1")
def latest_release(spark, d):
    r = v.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("published_at"), F.concat(F.lit("set "), "o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string")).alias("asset_name"))
    return health.latest_release(r, "URGENT").select("o_orderkey", "asset_name")


@query("collection_metadata", """WITH n AS (SELECT p_partkey, lower(stat || '_' || var || '_' || prov || '_' || per || reg) AS name FROM (SELECT p_partkey, ['max', 'min', 'mean'][p_partkey % 3 + 1] AS stat, ['temp', 'prec', 'humidity', 'temp_anomaly'][p_partkey % 4 + 1] AS var, ['era5land', 'cptec', 'x'][p_partkey // 4 % 3 + 1] AS prov, ['epiweek', 'month', 'y'][p_partkey // 12 % 3 + 1] AS per, ['', '_ne_a', '_no_a'][p_partkey // 36 % 3 + 1] AS reg FROM part))
SELECT p_partkey, concat_ws(' ', CASE WHEN name LIKE '%max%' THEN 'maximum' END, CASE WHEN name LIKE '%min%' THEN 'minimum' END, CASE WHEN name LIKE '%mean%' THEN 'mean' END, CASE WHEN name LIKE '%temp%' THEN 'temperature' END, CASE WHEN name LIKE '%prec%' THEN 'precipitation' END, CASE WHEN name LIKE '%humidity%' THEN 'relative humidity' END, CASE WHEN name LIKE '%anomaly%' THEN 'anomaly' END) AS words,
  CASE WHEN name LIKE '%temp_anomaly_era5land_epiweek%' OR name LIKE '%temp_anomaly_era5land_month%' THEN 'anomaly' WHEN name LIKE '%prec%' AND name NOT LIKE '%\\_x\\_%' ESCAPE '\\' THEN 'precipitation' WHEN name LIKE '%humidity%' THEN 'humidity' ELSE 'temperature' END AS indicator,
  CASE WHEN name LIKE '%era5land%' THEN 'ERA5-Land' WHEN name LIKE '%cptec%' THEN 'CPTEC' ELSE 'Unknown' END AS provider, CASE WHEN name LIKE '%epiweek%' THEN 'epidemiological week' WHEN name LIKE '%month%' THEN 'month' ELSE 'time period' END AS period,
  CASE WHEN name LIKE '%\\_ne\\_%' ESCAPE '\\' THEN 'Northeast' WHEN name LIKE '%\\_no\\_%' ESCAPE '\\' THEN 'North' ELSE 'Brazil' END AS region FROM n""")
def collection_metadata(spark, d):
    k = F.col("p_partkey")
    pick = lambda values, n: F.get(F.array(*[F.lit(x) for x in values]), n.cast("int"))
    name = F.concat(F.concat_ws("_", pick(["max", "min", "mean"], k % 3), pick(["temp", "prec", "humidity", "temp_anomaly"], k % 4), pick(["ERA5Land", "CPTEC", "x"], F.floor(k / 4) % 3), pick(["epiweek", "month", "y"], F.floor(k / 12) % 3)), pick(["", "_ne_a", "_no_a"], F.floor(k / 36) % 3))
    return v.table(spark, d, "part").select("p_partkey", *[c.alias(n) for n, c in fn.parse_collection_name(name).items()])


@query("layer_name", """SELECT n_nationkey, CASE WHEN n_nationkey % 4 <> 3 THEN lower(replace(n_name || ' Rate', ' ', '_')) || CASE n_nationkey % 3 WHEN 0 THEN '_NE' WHEN 1 THEN '' ELSE '_delta' END || '_' || ['mun', 'hr', 'uf'][n_nationkey % 4 + 1] || CASE WHEN n_nationkey % 2 = 0 THEN '_epiweek' ELSE '_month' END END AS layer FROM nation""")
def layer_name(spark, d):
    k = F.col("n_nationkey")
    pick = lambda values, n: F.get(F.array(*[F.lit(x) for x in values]), n.cast("int"))
    return v.table(spark, d, "nation").select("n_nationkey", fn.layer_name(F.concat("n_name", F.lit(" Rate")), pick(["Northeast", None, "delta"], k % 3), pick(["municipality", "health_region", "state", "parish"], k % 4), pick(["week", "month"], k % 2)).alias("layer"))


@query("natural_order", f"WITH {v.SQL_DAILY} SELECT label, n FROM (SELECT 'epiweek_' || {v.sql_epi_week('day')} AS label, count(*) AS n FROM daily GROUP BY ALL) ORDER BY CAST(split_part(label, '_', 2) AS INTEGER)")
def natural_order(spark, d):
    label = F.concat(F.lit("epiweek_"), cal.epi_week(F.col("day")).cast("string"))
    return v.daily(spark, d).groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n")).orderBy(fn.natural_number(F.col("label")), "label")


@query("accents_stripped", "SELECT lang, CAST(count(*) AS BIGINT) AS n, CAST(sum(length(translate(text, 'áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ', 'aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN'))) AS BIGINT) AS chars, CAST(sum(length(regexp_replace(text, '[^áéíóúñçü]', '', 'g'))) AS BIGINT) AS marked FROM documents GROUP BY lang")
def accents_stripped(spark, d):
    docs = v.table(spark, d, "documents")
    marked = F.length("text") - F.length(F.translate("text", "áéíóúñçü", ""))
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(fn.strip_accents(F.col("text"))).cast("long")).alias("chars"), F.sum(marked.cast("long")).alias("marked"))


@query("request_manifest", """WITH days AS (SELECT CAST(unnest(range(min(CAST(ts AS DATE)), max(CAST(ts AS DATE)) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM events)
SELECT d.day, strftime(d.day, 'https://example.org/%Y/%m/%d.nc') AS url, count(e.event_id) AS n FROM days d LEFT JOIN events e ON CAST(e.ts AS DATE) = d.day GROUP BY ALL""")
def request_manifest(spark, d):
    """A request for each day between the first and the last event, with the day's events."""
    o = v.obs(spark, d)
    first, last = o.agg(F.min("day"), F.max("day")).first()
    days = writers.daily_manifest(spark, str(first), str(last), "https://example.org/{yyyy}/{MM}/{dd}.nc")
    return days.join(o.groupBy("day").agg(F.count(F.lit(1)).alias("n")), "day", "left").select("day", "url", F.coalesce("n", F.lit(0)).alias("n"))


@query("monthly_requests", "WITH months AS (SELECT CAST(unnest(range(CAST(date_trunc('month', min(o_orderdate)) AS DATE), CAST(max(o_orderdate) AS DATE) + INTERVAL 1 DAY, INTERVAL 1 MONTH)) AS DATE) AS m FROM orders) SELECT CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month, CAST(day(last_day(m)) AS INTEGER) AS days FROM months")
def monthly_requests(spark, d):
    first, last = v.table(spark, d, "orders").agg(F.min(F.to_date("o_orderdate")), F.max(F.to_date("o_orderdate"))).first()
    return writers.monthly_manifest(spark, str(first), str(last))


@query("iso_dates", "SELECT o_orderkey, o_orderkey % 3 = 0 AS iso FROM orders")
def iso_dates(spark, d):
    k = F.col("o_orderkey")
    text = F.when(k % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).when(k % 3 == 1, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(F.lit("2024-13-45"))
    return v.table(spark, d, "orders").select("o_orderkey", cal.is_iso_date(text).alias("iso"))


@query("valid_area", "SELECT s_suppkey, (s_suppkey % 100) <= 90 AND s_suppkey % 7 <> 0 AND (s_suppkey % 400) - 200 BETWEEN -180 AND 180 - 5 AS valid FROM supplier")
def valid_area(spark, d):
    k = F.col("s_suppkey")
    north = (k % 100).cast("double")
    west = (k % 400 - 200).cast("double")
    south = F.when(k % 7 == 0, north).otherwise(north - 10)
    return v.table(spark, d, "supplier").select("s_suppkey", physics.valid_area(north, west, south, west + 5).alias("valid"))
