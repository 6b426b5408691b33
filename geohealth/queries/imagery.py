"""Pixels, images and their places."""

from __future__ import annotations

from pyspark.sql import functions as F

from geohealth.functions import geodesy, physics
from geohealth.operators import imagery as ops
from geohealth.operators import zones as zn
from geohealth.plans import pipelines
from geohealth.queries import views as v
from geohealth.queries.registry import query

_KEYS = ["l_orderkey", "l_linenumber"]


def _bands(spark, d):
    """Quantity as red and price as near infrared."""
    return v.daily(spark, d).withColumn("red", F.col("value") * 100).withColumn("nir", F.col("l_extendedprice") / 10)


_SQL_BANDS = f"{v.SQL_DAILY}, bands AS (SELECT *, value * 100 AS red, l_extendedprice / 10 AS nir FROM daily)"


@query("ndvi", f"WITH {_SQL_BANDS} SELECT l_orderkey, l_linenumber, {v.sql_r4('CASE WHEN nir + red <> 0 THEN greatest(-1, least(1, (nir - red) / (nir + red))) END')} AS ndvi FROM bands")
def ndvi(spark, d):
    return _bands(spark, d).select(*_KEYS, v.r4(physics.ndvi(F.col("nir"), F.col("red"))).alias("ndvi"))


def _reflectance(dn):
    c = lambda x: F.lit(float(x))
    return physics.reflectance(dn, c(16), c(320), F.col("l_discount") + 1, c(5000), F.col("l_tax") + 1, c(12.5))


_SQL_REF = "CASE WHEN {0} <> 0 THEN (({0} - 320) / 65536) / ((l_discount + 1) * (5000 / 1e6)) * (l_tax + 1) / 12.5 END"


@query("reflectance", f"WITH {_SQL_BANDS} SELECT l_orderkey, l_linenumber, {v.sql_r4(_SQL_REF.format('red'))} AS value FROM bands")
def reflectance(spark, d):
    return _bands(spark, d).select(*_KEYS, v.r4(_reflectance(F.col("red"))).alias("value"))


@query("sensor_ndvi", f"WITH {_SQL_BANDS}, r AS (SELECT l_orderkey, l_linenumber, {_SQL_REF.format('nir')} AS n, {_SQL_REF.format('red')} AS r FROM bands) SELECT l_orderkey, l_linenumber, CAST(CASE WHEN n + r <> 0 AND (n - r) / (n + r) BETWEEN -1 AND 1 THEN round_even((n - r) / (n + r) * 10000, 0) END AS SMALLINT) AS ndvi FROM r")
def sensor_ndvi(spark, d):
    return _bands(spark, d).select(*_KEYS, physics.sensor_ndvi(_reflectance(F.col("nir")), _reflectance(F.col("red"))).alias("ndvi"))


_K = [0.011, -0.002, 0.0003, 0.00002, -0.000001, 0.0000004]


@query("vignette", f"WITH {v.SQL_DAILY}, r AS (SELECT l_orderkey, l_linenumber, sqrt((value / 10 - 2.5) ** 2 + (l_linenumber - 3.5) ** 2) AS r FROM daily) SELECT l_orderkey, l_linenumber, {v.sql_r4('1 + ' + ' + '.join(f'({k}) * r ** {n + 1}' for n, k in enumerate(_K)))} AS factor FROM r")
def vignette(spark, d):
    x = physics.vignette(F.col("value") / 10, F.col("l_linenumber"), F.lit(2.5), F.lit(3.5), [F.lit(k) for k in _K])
    return v.daily(spark, d).select(*_KEYS, v.r4(x).alias("factor"))


def _pixels(spark, d):
    return v.daily(spark, d).select(F.col("l_partkey").alias("image"), F.lit("red").alias("band"), "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") == 7, F.lit(-9999.0)).otherwise(F.col("value")).alias("dn"))


_SQL_PIXELS = f"{v.SQL_DAILY}, pixels AS (SELECT l_partkey AS image, 'red' AS band, l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 7 THEN value END AS dn FROM daily)"


@query("band_stats", f"WITH {_SQL_PIXELS} SELECT image, band, min(dn) AS least, max(dn) AS most, {v.sql_r4('avg(dn)')} AS mean, {v.sql_r4('stddev_pop(dn)')} AS spread FROM pixels GROUP BY ALL")
def band_stats(spark, d):
    return ops.band_stats(_pixels(spark, d)).withColumn("mean", v.r4(F.col("mean"))).withColumn("spread", v.r4(F.col("spread")))


@query("equalize", f"""WITH {_SQL_PIXELS}, known AS (SELECT *, min(dn) OVER w AS lo, max(dn) OVER w AS hi FROM pixels WHERE dn IS NOT NULL WINDOW w AS (PARTITION BY image)),
placed AS (SELECT *, CAST(least(255, floor((dn - lo) / ((hi - lo) / 256))) AS INTEGER) AS bin FROM known), n AS (SELECT image, bin, count(*) AS n FROM placed GROUP BY ALL),
full_ AS (SELECT i.image, b.bin, coalesce(n.n, 0) AS n FROM (SELECT DISTINCT image FROM placed) i CROSS JOIN range(256) b(bin) LEFT JOIN n ON n.image = i.image AND n.bin = b.bin),
cdf AS (SELECT image, bin, 255 * sum(n) OVER (PARTITION BY image ORDER BY bin) / sum(n) OVER (PARTITION BY image) AS c FROM full_)
SELECT a.image, a.l_orderkey, a.l_linenumber, {v.sql_r4('x.c + (coalesce(y.c, x.c) - x.c) * CASE WHEN a.bin = 255 THEN 0 ELSE (a.dn - a.lo) / ((a.hi - a.lo) / 256) - a.bin END')} AS eq
FROM placed a JOIN cdf x ON x.image = a.image AND x.bin = a.bin LEFT JOIN cdf y ON y.image = a.image AND y.bin = a.bin + 1""")
def equalize(spark, d):
    return ops.equalize(_pixels(spark, d)).select("image", *_KEYS, v.r4(F.col("eq")).alias("eq"))


def _images(spark, d):
    p, k = v.table(spark, d, "part"), F.col("p_partkey")
    return p.select(
        F.concat(F.lit("img_"), k.cast("string")).alias("item"), F.col("p_type").alias("collection"), k,
        (60.0 + F.col("p_size")).alias("flight_height_m"), F.lit(17.3).alias("sensor_width_mm"), F.lit(12.29).alias("focal_mm"), (5000 + k % 300).alias("width"), (4000 + k % 200).alias("height"),
        (-35.0 + (k % 600) / 10).alias("lat"), (-70.0 + (k % 350) / 10).alias("lon"), (k % 360).cast("double").alias("yaw"))


_SQL_IMAGES = "images AS (SELECT 'img_' || p_partkey AS item, p_type AS collection, p_partkey, 60.0::DOUBLE + p_size AS h, 17.3::DOUBLE AS sw, 12.29::DOUBLE AS f, 5000 + p_partkey % 300 AS width, 4000 + p_partkey % 200 AS height, -35.0::DOUBLE + (p_partkey % 600) / 10 AS lat, -70.0::DOUBLE + (p_partkey % 350) / 10 AS lon, CAST(p_partkey % 360 AS DOUBLE) AS yaw FROM part)"
_SQL_GSD = "h * sw / (width * f)"


def _gsd(images):
    return images.withColumn("gsd_m", physics.gsd_m(*[F.col(c) for c in ("flight_height_m", "sensor_width_mm", "width", "focal_mm")])).withColumn("gsd_cm", F.col("gsd_m") * 100)


@query("gsd", f"WITH {_SQL_IMAGES} SELECT p_partkey, round({_SQL_GSD} + 3e-9, 6) AS gsd_m FROM images")
def gsd(spark, d):
    return _gsd(_images(spark, d)).select("p_partkey", F.round(F.col("gsd_m") + 3e-9, 6).alias("gsd_m"))


@query("dms_decimal", f"SELECT p_partkey, {v.sql_r4('CASE WHEN p_partkey % 4 IN (1, 3) THEN -1 ELSE 1 END * (p_partkey % 90 + (p_partkey % 60) / 60 + p_size / 3600)')} AS value FROM part")
def dms_decimal(spark, d):
    k = F.col("p_partkey")
    side = F.get(F.array(*[F.lit(h) for h in "NSEW"]), (k % 4).cast("int"))
    return v.table(spark, d, "part").select("p_partkey", v.r4(geodesy.dms_to_decimal(k % 90, k % 60, F.col("p_size"), side)).alias("value"))


_A, _E2, _E = geodesy.A, geodesy.E2, geodesy.ECC
_SQL_W = f"sqrt(1 - {_E2!r} * sin(radians(lat)) ** 2)"
_SQL_MY = f"{_A!r} * ln(tan(pi() / 4 + radians({{0}}) / 2) * ((1 - {_E!r} * sin(radians({{0}}))) / (1 + {_E!r} * sin(radians({{0}})))) ** ({_E!r} / 2))"
_SQL_FOOT = f"""ends AS (SELECT p_partkey, lat, lon, degrees({_SQL_GSD} * height / 2 * {_SQL_W} ** 3 / ({_A!r} * (1 - {_E2!r}))) AS dlat, degrees({_SQL_GSD} * width / 2 * {_SQL_W} / ({_A!r} * cos(radians(lat)))) AS dlon FROM images),
foot AS (SELECT p_partkey, {_A!r} * radians(lon - dlon) AS xmin, {_SQL_MY.format('(lat - dlat)')} AS ymin, {_A!r} * radians(lon + dlon) AS xmax, {_SQL_MY.format('(lat + dlat)')} AS ymax, lat, lon, dlat, dlon FROM ends)"""


@query("image_footprint", f"WITH {_SQL_IMAGES}, {_SQL_FOOT} SELECT p_partkey, " + ", ".join(f"round({c} + 3e-5, 2) AS {c}" for c in ("xmin", "ymin", "xmax", "ymax")) + " FROM foot")
def image_footprint(spark, d):
    got = ops.image_footprint(_gsd(_images(spark, d)))
    return got.select("p_partkey", *[F.round(F.col(c) + 3e-5, 2).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")])


@query("bbox_wgs84", f"WITH {_SQL_IMAGES}, {_SQL_FOOT} SELECT p_partkey, round(lon - dlon + 3e-9, 6) AS west, round(lat - dlat + 3e-9, 6) AS south, round(lon + dlon + 3e-9, 6) AS east, round(lat + dlat + 3e-9, 6) AS north FROM foot")
def bbox_wgs84(spark, d):
    """Projected and back: the oracle needs no projection."""
    got = ops.bbox_wgs84(ops.image_footprint(_gsd(_images(spark, d))))
    return got.select("p_partkey", *[F.round(F.col(c) + 3e-9, 6).alias(c) for c in ("west", "south", "east", "north")])


_SQL_TURN = "lat + sin(radians(yaw)) * ({x} - 50) * 0.25 - cos(radians(yaw)) * ({y} - 40) * 0.25"


@query("affine_bounds", f"""WITH {_SQL_IMAGES}, c AS (SELECT p_partkey, lon + 12.5 + cos(radians(yaw)) * (x - 50) * 0.25 + sin(radians(yaw)) * (y - 40) * 0.25 AS gx, lat - 10 + sin(radians(yaw)) * (x - 50) * 0.25 - cos(radians(yaw)) * (y - 40) * 0.25 AS gy FROM images, (VALUES (0, 0), (100, 0), (0, 80), (100, 80)) q(x, y))
SELECT p_partkey, {v.sql_r4('min(gx)')} AS xmin, {v.sql_r4('min(gy)')} AS ymin, {v.sql_r4('max(gx)')} AS xmax, {v.sql_r4('max(gy)')} AS ymax FROM c GROUP BY p_partkey""")
def affine_bounds(spark, d):
    """Rasters of 100 by 80 pixels of 0.25, turned about their middle."""
    c = lambda x: F.lit(float(x))
    gt = [F.col("lon"), c(0.25), c(0), F.col("lat"), c(0), c(-0.25)]
    turned = geodesy.rotate_affine(gt, F.col("yaw"), c(50), c(40))
    return _images(spark, d).select("p_partkey", *[v.r4(x).alias(n) for n, x in geodesy.bounds(turned, c(100), c(80)).items()])


@query("midpoint", f"WITH {_SQL_IMAGES} SELECT {v.sql_r4('(max(lon) + min(lon)) / 2')} AS lon, {v.sql_r4('(max(lat) + min(lat)) / 2')} AS lat FROM images")
def midpoint(spark, d):
    return ops.midpoint(_images(spark, d)).select(v.r4(F.col("lon")).alias("lon"), v.r4(F.col("lat")).alias("lat"))


@query("utc_time", f"""WITH {v.SQL_ZONES}, img AS (SELECT p_partkey, CAST(p_partkey % 15 AS INTEGER) AS i, CAST((p_partkey // 15) % 10 AS INTEGER) AS j, TIMESTAMP '2024-01-01 00:00:00' + CAST(p_partkey % 5000 AS INTEGER) * INTERVAL 1 HOUR AS t FROM part), tz AS (SELECT i, j, min(zone_id) AS z FROM inside GROUP BY ALL)
SELECT p_partkey, strftime(t + CASE WHEN z % 3 = 0 THEN INTERVAL 3 HOUR WHEN z % 3 = 1 THEN INTERVAL 4 HOUR WHEN z % 3 = 2 THEN INTERVAL 5 HOUR END, '%Y-%m-%dT%H:%M:%S') AS utc FROM img LEFT JOIN tz USING (i, j)""")
def utc_time(spark, d):
    """Zones of three offsets; images outside of all have no time."""
    k, z = F.col("p_partkey"), F.col("zone_id")
    local = F.timestamp_seconds(F.lit(1704067200) + k % 5000 * 3600)
    img = v.table(spark, d, "part").select(k, (k % 15).cast("int").alias("i"), (F.floor(k / 15) % 10).cast("int").alias("j"), local.alias("local_ts"))
    tz = v.zones(spark, d).select("zone_id", F.when(z % 3 == 0, "-03:00").when(z % 3 == 1, "-04:00").otherwise("-05:00").alias("tz"))
    got = ops.to_utc(img, zn.zone_cells(v.zones(spark, d), v.GRID, all_touched=False), tz)
    return got.select("p_partkey", F.date_format("utc_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("utc"))


@query("drone_items", f"WITH {_SQL_IMAGES}, {_SQL_FOOT}, {_SQL_PIXELS} SELECT i.p_partkey, i.collection, 'sensor ' || lower(i.collection) AS instrument, round({_SQL_GSD} + 3e-9, 6) AS gsd_m, round(f.lon - f.dlon + 3e-9, 6) AS west, b.n AS bands, b.most FROM images i JOIN foot f USING (p_partkey) LEFT JOIN (SELECT image, 1 AS n, max(dn) AS most FROM pixels GROUP BY image) b ON b.image = i.p_partkey WHERE i.p_partkey % 3 <> 0")
def drone_items(spark, d):
    """The whole catalogue; every third image is published already."""
    images = _images(spark, d)
    kinds = images.select("collection").distinct().withColumn("instrument", F.concat(F.lit("sensor "), F.lower("collection")))
    pixels = _pixels(spark, d).withColumn("image", F.concat(F.lit("img_"), F.col("image").cast("string")))
    got = pipelines.drone_catalogue(images, images.where("p_partkey % 3 = 0"), kinds, pixels)
    bands = F.when(F.col("bands").isNotNull(), F.size("bands"))
    return got.select("p_partkey", "collection", "instrument", F.round(F.col("gsd_m") + 3e-9, 6).alias("gsd_m"), F.round(F.col("west") + 3e-9, 6).alias("west"), bands.alias("bands"), F.get(F.col("bands"), F.lit(0))["most"].alias("most"))


@query("drone_catalogue", f"""WITH {_SQL_IMAGES}, {v.SQL_ZONES}, tz AS (SELECT i, j, min(zone_id) AS z FROM inside GROUP BY ALL), img AS (SELECT *, CAST(p_partkey % 15 AS INTEGER) AS i, CAST((p_partkey // 15) % 10 AS INTEGER) AS j, TIMESTAMP '2024-01-01 00:00:00' + CAST(p_partkey % 5000 AS INTEGER) * INTERVAL 1 HOUR AS t FROM images WHERE p_partkey % 5 <> 0)
SELECT p_partkey, 'sensor ' || lower(collection) AS instrument, strftime(t + CASE WHEN z % 2 = 0 THEN INTERVAL 3 HOUR WHEN z % 2 = 1 THEN INTERVAL 4 HOUR END, '%Y-%m-%dT%H:%M:%S') AS utc,
  CAST(CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 1 ELSE 2 END AS INTEGER) AS assets, CASE WHEN p_partkey % 4 > 1 THEN '/data/thumbs/img_' || p_partkey || '_20240105.png' END AS thumbnail FROM img LEFT JOIN tz USING (i, j)""")
def drone_catalogue(spark, d):
    """The catalogue with the time of each image's zone and its files: a picture for three of four, a thumbnail for two."""
    k, z = F.col("p_partkey"), F.col("zone_id")
    name = F.concat(F.lit("img_"), k.cast("string"), F.lit("_20240105"))
    images = _images(spark, d).withColumns({"item": name, "i": (k % 15).cast("int"), "j": (F.floor(k / 15) % 10).cast("int"), "local_ts": F.timestamp_seconds(F.lit(1704067200) + k % 5000 * 3600)})
    kinds = images.select("collection").distinct().withColumn("instrument", F.concat(F.lit("sensor "), F.lower("collection")))
    tz = v.zones(spark, d).select("zone_id", F.when(z % 2 == 0, "-03:00").otherwise("-04:00").alias("tz"))
    file = lambda folder, kind: F.concat(F.lit(f"/data/{folder}/"), "item", F.lit("." + kind)).alias("path")
    paths = images.where("p_partkey % 4 > 0").select(file("pictures", "tif")).unionAll(images.where("p_partkey % 4 > 1").select(file("thumbs", "png")))
    got = pipelines.drone_catalogue(images, images.where("p_partkey % 5 = 0"), kinds, cells=zn.zone_cells(v.zones(spark, d), v.GRID, all_touched=False), zone_of=tz, paths=paths)
    return got.select("p_partkey", "instrument", F.date_format("utc_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("utc"), F.when(F.col("assets").isNotNull(), F.size("assets")).alias("assets"), F.try_element_at("assets", F.lit("png"))["href"].alias("thumbnail"))
