"""Pixels, images and catalogue items."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geohealth.functions import geodesy, physics, text

#: Media types and roles by extension.
ASSET_TYPES = {"tif": ("image/tiff", "data"), "jp2": ("image/jp2", "data"), "png": ("image/png", "thumbnail"), "json": ("application/json", "metadata"), "csv": ("text/csv", "data"), "geojson": ("application/geo+json", "data")}


def band_stats(pixels: DataFrame) -> DataFrame:
    """image, band, and least, most, mean, spread (population) of dn without nodata."""
    return pixels.withColumn("dn", physics.clean_nodata(F.col("dn"))).groupBy("image", "band").agg(
        F.min("dn").alias("least"), F.max("dn").alias("most"), F.avg("dn").alias("mean"), F.stddev_pop("dn").alias("spread"))


#: Pixels that a task of equalize() sorts and counts, on average.
TASK_PIXELS = 1_000_000


def equalize(pixels: DataFrame, bins: int = 256, task_pixels: int = TASK_PIXELS) -> DataFrame:
    """pixels with eq: dn through the image's cumulative histogram, scaled to 0 .. bins - 1, linear between left bin edges.

    The histogram has at most `bins` rows an image; the running sum is over these, not over the pixels. Beyond
    `task_pixels` for each core the pixels are counted out to as many tasks as that takes, so that a task's memory
    doesn't grow with their number.
    """
    # one column as key: rows are dealt out by it and joined on it, whichever parts of it are constant
    known = pixels.withColumn("dn", physics.clean_nodata(F.col("dn"))).where(F.col("dn").isNotNull()).withColumn("_of", F.struct("image", "band"))
    tasks = -(-known.count() // task_pixels)
    spread = lambda df, key: df.repartition(tasks, key) if tasks > known.sparkSession.sparkContext.defaultParallelism else df
    known = spread(known, "_of")
    span = known.groupBy("_of").agg(F.min("dn").alias("_lo"), F.max("dn").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    at = known.join(span, "_of").withColumn("_bin", F.when(width > 0, F.least(F.lit(bins - 1), F.floor((F.col("dn") - F.col("_lo")) / width))).otherwise(F.lit(0)).cast("int"))
    counts = at.groupBy("_of", "_bin").agg(F.count(F.lit(1)).alias("_n"))
    run = Window.partitionBy("_of").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("_of")
    cdf = counts.withColumn("_cum", F.sum("_n").over(run)).withColumn("_all", F.sum("_n").over(whole))
    cell = F.struct("_of.image", "_of.band", "_bin").alias("_cell")
    scaled = cdf.select(cell, ((bins - 1) * F.col("_cum") / F.col("_all")).alias("_c"), ((bins - 1) * F.lead("_cum").over(whole.orderBy("_bin")) / F.col("_all")).alias("_occupied"), F.lead("_bin").over(whole.orderBy("_bin")).alias("_nextbin"))
    # an empty next bin repeats the sum so far
    following = F.when(F.col("_nextbin") == F.col("_bin") + 1, F.col("_occupied")).otherwise(F.col("_c"))
    following = F.when(F.col("_bin") == bins - 1, F.col("_c")).otherwise(following)
    part = F.when(width > 0, (F.col("dn") - F.col("_lo")) / width - F.col("_bin")).otherwise(F.lit(0.0))
    placed = spread(at.select("*", cell).drop("_of"), "_cell").join(spread(scaled, "_cell"), "_cell")
    return placed.withColumn("eq", F.col("_c") + (following - F.col("_c")) * F.when(F.col("_bin") == bins - 1, F.lit(0.0)).otherwise(part)).select(*pixels.columns, "eq")


def midpoint(images: DataFrame) -> DataFrame:
    """Middle of the extremes of each axis."""
    return images.agg(((F.max("lon") + F.min("lon")) / 2).alias("lon"), ((F.max("lat") + F.min("lat")) / 2).alias("lat"))


def image_footprint(images: DataFrame) -> DataFrame:
    """images (lat, lon, width, height, gsd_cm) with their Mercator bounds."""
    return images.withColumns(geodesy.footprint(*[F.col(c) for c in ("lat", "lon", "width", "height", "gsd_cm")]))


def bbox_wgs84(images: DataFrame) -> DataFrame:
    """images with Mercator bounds and west, south, east, north in degrees, and the box as GeoJSON."""
    x = {n: geodesy.inverse_lon(F.col(c)) for n, c in (("west", "xmin"), ("east", "xmax"))}
    y = {n: geodesy.inverse_lat(F.col(c)) for n, c in (("south", "ymin"), ("north", "ymax"))}
    out = images.withColumns(x | y)
    return out.withColumn("bbox_geojson", geodesy.box_geojson(*[F.col(c) for c in ("west", "south", "east", "north")]))


def to_utc(images: DataFrame, cells: DataFrame, zone_of: DataFrame, local: str = "local_ts") -> DataFrame:
    """images (i, j of their cell) with utc_ts: the time zone of the zone that holds the cell; NULL outside of all.

    cells: zone_id, i, j; zone_of: zone_id, tz. A cell on a border takes the smaller zone.
    """
    tz = cells.join(zone_of, "zone_id").groupBy("i", "j").agg(F.min_by("tz", "zone_id").alias("_tz"))
    return images.join(tz, ["i", "j"], "left").withColumn("utc_ts", F.to_utc_timestamp(F.col(local), F.col("_tz"))).drop("_tz")


def build_items(paths: DataFrame, path: str = "path") -> DataFrame:
    """One row per item (file name up to its first dot): start, end and its assets, a map of extension to href, type and role.

    All files of an item count, in whatever directory they are; names without a date are left out.
    """
    name = F.element_at(F.split(F.col(path), "/"), -1)
    stem, extension = F.substring_index(name, ".", 1), F.lower(F.substring_index(name, ".", -1))
    kinds = lambda at: F.coalesce(*[F.when(extension == e, F.lit(v[at])) for e, v in ASSET_TYPES.items()], F.lit("application/octet-stream" if at == 0 else "data"))
    dated = paths.select(path, text.item_period(stem).alias("_when")).where(F.col("_when.start").isNotNull())
    files = dated.select(stem.alias("item"), F.col("_when.start").alias("start"), F.col("_when.end").alias("end"), extension.alias("key"), F.struct(F.col(path).alias("href"), kinds(0).alias("type"), kinds(1).alias("role")).alias("asset"))
    one = files.groupBy("item", "start", "end", "key").agg(F.min("asset").alias("asset"))
    return one.groupBy("item", "start", "end").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "asset")))).alias("assets"))


def attach_collection(items: DataFrame, collections: DataFrame) -> DataFrame:
    """items with the columns of their collection."""
    return items.join(collections, "collection")


def pending(inputs: DataFrame, manifest: DataFrame, key: str = "item") -> DataFrame:
    """Inputs whose output the manifest doesn't list."""
    return inputs.join(manifest.select(key).distinct(), key, "left_anti")


def dates_from_paths(df: DataFrame, path: str = "path") -> DataFrame:
    """Distinct start dates in the names, in order."""
    return df.select(text.item_dates(F.element_at(F.split(F.col(path), "/"), -1))[0].alias("start")).where(F.col("start").isNotNull()).distinct().orderBy("start")
