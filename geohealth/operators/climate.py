"""Anomalies, interpolation and humidity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geohealth.functions import physics
from geohealth.operators.zones import Grid, cell_period_stats, every_zone, zonal_stats

#: Weight of a station that lies on the point itself.
ON_POINT = 1e12
#: Stations in a block, whose weights are summed up in one step, and points in a tile.
STATION_BLOCK, POINT_TILE = 256, 16_384


def attach_normal(df: DataFrame, zone_normals: DataFrame) -> DataFrame:
    """normal of the month in which the period starts, by zone; zone_normals has zone_id, month and normal."""
    n = zone_normals.select(F.col("zone_id").alias("_z"), F.col("month").alias("_m"), "normal")
    return df.join(n, (F.col("zone_id") == F.col("_z")) & (F.month("period_start") == F.col("_m")), "left").drop("_z", "_m")


def days_above(df: DataFrame) -> DataFrame:
    """zone_id, period_start and the days whose value is above normal; a missing value or normal isn't."""
    return df.groupBy("zone_id", "period_start").agg(F.count_if(F.col("value") > F.col("normal")).alias("days_above"))


def _longest(days: Column) -> Column:
    """The longest run of consecutive days in a sorted array of distinct days."""
    first = F.struct(F.lit(None).cast("date").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(acc: Column, day: Column) -> Column:
        run = F.when(F.date_add(acc["last"], 1) == day, acc["run"] + 1).otherwise(1)
        return F.struct(day.alias("last"), run.alias("run"), F.greatest(acc["best"], run).alias("best"))

    return F.aggregate(days, first, step, lambda acc: acc["best"])


def _above() -> Column:
    """The sorted days above normal of a group; there are no more than the period has days."""
    return F.array_sort(F.collect_set(F.when(F.col("value") > F.col("normal"), F.col("day"))))


def longest_run(df: DataFrame) -> DataFrame:
    """zone_id, period_start and the longest run of consecutive days above normal; a day without a row breaks it, 0 if none.

    A period's days are few, so its run is found in the one grouping; gaps need no filling.
    """
    return df.groupBy("zone_id", "period_start").agg(_longest(_above()).cast("long").alias("longest_run"))


def anomaly_indicator(cells: DataFrame, members: DataFrame, zone_normals: DataFrame, period: Callable[[Column], Column] | None = None, layer: DataFrame | None = None) -> DataFrame:
    """zone_id, period_start, days_above, longest_run of the zones' daily maxima, in one grouping.

    period: day column -> its start; without it cells have period_start, and runs end where a period does. The normal is
    that of the month in which the period starts. With a layer every zone of it has a row in every period: 0 days where it
    has no valid cell, as no day of it is above normal.
    """
    placed = cells if period is None else cells.withColumn("period_start", period(F.col("day")))
    daily = placed.join(members, ["i", "j"]).groupBy("zone_id", "period_start", "day").agg(F.max("value").alias("value"))
    marked = attach_normal(daily, zone_normals).groupBy("zone_id", "period_start").agg(
        F.count_if(F.col("value") > F.col("normal")).alias("days_above"), _longest(_above()).cast("long").alias("longest_run"))
    return marked if layer is None else every_zone(marked, layer, ["period_start"]).na.fill(0, ["days_above", "longest_run"])


def station_normals(stations: DataFrame, normals: DataFrame) -> DataFrame:
    """Stations with their normals, by station code."""
    return stations.join(normals, "code")


def idw(stations: DataFrame, grid: DataFrame, power: float = 2.0) -> DataFrame:
    """The grid's columns with value: the stations' values weighted by 1 / distance^power.

    stations: lon, lat, value; grid: lon, lat and any keys. A station on the point weighs ON_POINT; without weight the
    value is 0. It is a product of blocks: stations go into blocks of about STATION_BLOCK and points into tiles of about
    POINT_TILE, and each tile meets each block under a key of its own (tile, block), so no key holds more than one
    tile, however many stations or points there are. A point sums a block up in place; then its blocks' sums are added.
    """
    known = stations.where(F.col("value").isNotNull() & F.col("lon").isNotNull() & F.col("lat").isNotNull())
    known = known.select(*[F.col(c).cast("double").alias(c) for c in ("lon", "lat", "value")]).groupBy("lon", "lat", "value").agg(F.count(F.lit(1)).alias("n"))  # copies are one that weighs more
    blocks = max(1, -(-known.count() // STATION_BLOCK))
    packed = known.withColumn("_block", F.pmod(F.xxhash64("lon", "lat", "value"), F.lit(blocks)).cast("int"))
    packed = packed.groupBy("_block").agg(F.collect_list(F.struct("lon", "lat", "value", "n")).alias("_s"))

    def add(acc, s):
        d = F.sqrt((F.col("lon") - s["lon"]) * (F.col("lon") - s["lon"]) + (F.col("lat") - s["lat"]) * (F.col("lat") - s["lat"]))
        w = F.when(d == 0, F.lit(ON_POINT)).otherwise(1 / F.pow(d, F.lit(power)))
        return F.struct((acc["w"] + w * s["n"]).alias("w"), (acc["z"] + w * s["n"] * s["value"]).alias("z"))

    zero = F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("z"))
    summed = F.aggregate(F.coalesce("_s", F.array().cast("array<struct<lon:double,lat:double,value:double,n:bigint>>")), zero, add).alias("_p")
    if blocks == 1:  # one block is one row
        sums = grid.withColumn("_block", F.lit(0)).join(F.broadcast(packed), "_block", "left").select(*grid.columns, summed).select(*grid.columns, F.col("_p.w").alias("_w"), F.col("_p.z").alias("_z"))
    else:
        tiles = max(1, -(-grid.count() // POINT_TILE))
        spread = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
        points = grid.select("*", F.pmod(F.xxhash64(*grid.columns), F.lit(tiles)).cast("int").alias("_tile"), spread(blocks, "_block"))
        met = points.join(packed.select("*", spread(tiles, "_tile")), ["_tile", "_block"])
        sums = met.select(*grid.columns, summed).groupBy(*grid.columns).agg(F.sum("_p.w").alias("_w"), F.sum("_p.z").alias("_z"))
    return sums.select(*grid.columns, F.when(F.col("_w") > 0, F.col("_z") / F.col("_w")).otherwise(F.lit(0.0)).alias("value"))


def zone_normals(surface: DataFrame, zones: DataFrame, grid: Grid) -> DataFrame:
    """zone_id and normal: the mean of the grid's points (i, j at x0 + i r, y0 + j r) within the zone's bounding box."""
    p = zones.select("zone_id", F.explode(F.flatten("rings")).alias("p")).groupBy("zone_id").agg(*[f(f"p.{a}").alias(f"{n}{a}") for a in "xy" for n, f in (("lo", F.min), ("hi", F.max))])
    steps = lambda a, o: F.sequence(F.ceil((F.col(f"lo{a}") - o) / grid.r).cast("int"), F.floor((F.col(f"hi{a}") - o) / grid.r).cast("int"))
    holds = lambda a, o: F.ceil((F.col(f"lo{a}") - o) / grid.r) <= F.floor((F.col(f"hi{a}") - o) / grid.r)
    box = p.where(holds("x", grid.x0) & holds("y", grid.y0)).withColumn("i", F.explode(steps("x", grid.x0))).withColumn("j", F.explode(steps("y", grid.y0)))
    return box.join(surface, ["i", "j"]).groupBy("zone_id").agg(F.avg("value").alias("normal"))


def align(t: DataFrame, td: DataFrame) -> DataFrame:
    """Two variables' cell tables side by side, as t and td, where both have the day and cell (and the period, if they have one)."""
    keys = ["day", "i", "j", *(["period_start"] if "period_start" in t.columns else [])]
    return t.withColumnRenamed("value", "t").join(td.withColumnRenamed("value", "td"), keys)


def humidity_indicator(t: DataFrame, td: DataFrame, members: DataFrame, period: Callable[[Column], Column] | None = None, layer: DataFrame | None = None) -> DataFrame:
    """zone_id, period_start and mean: relative humidity by cell and day, averaged over the days and then the zone's cells.

    Without a period the tables have period_start. With a layer every zone of it has a row in every period, NULL where it has no valid cell.
    """
    both = align(t, td)
    start = F.col("period_start") if period is None else period(F.col("day")).alias("period_start")
    rh = both.select(start, "i", "j", physics.relative_humidity(F.col("t"), F.col("td")).alias("value"))
    return zonal_stats(cell_period_stats(rh, ["mean"]), members, "mean", "mean", ["period_start"], layer)
