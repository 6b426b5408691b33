"""Whole pipelines: climate and health indicators, drone catalogue, classified and loaded layers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geohealth.functions import calendar as cal
from geohealth.functions import physics
from geohealth.operators import calendar, classify, climate, health, imagery, zones
from geohealth.operators.zones import Grid
from geohealth.sources.scratch import stored

#: The families' names.
FAMILIES = ("temp_era5land", "precip_era5land", "anomaly_era5land", "humidity_era5land", "temp_cptec", "precip_cptec")


def climate_indicator(family: str, period: str, cells: DataFrame, layer: DataFrame, grid: Grid, years: list[int], stats: list[str] | None = None,
                      dewpoint: DataFrame | None = None, normals: DataFrame | None = None, all_touched: bool = True, intervals: DataFrame | None = None, source: str | None = None) -> DataFrame:
    """zone_id, period_start, number and the family's columns: every zone of the layer in every period that has data.

    intervals (start_date, end_date, number) is a custom calendar that takes the period's place; days in none of its
    intervals are left out, and runs of days end where an interval does. With a source the rows have descriptions too.

    cells: day, i, j, value in the provider's units (K and m for era5land). humidity takes dewpoint, anomaly takes
    normals (zone_id, month, normal), of which the month of the period's first day counts. A zone without valid cells has
    0 days of anomaly, and NULL for all else.
    """
    if family not in FAMILIES:
        raise ValueError(f"unknown family: {family}")
    era = family.endswith("era5land")

    def placed(df: DataFrame) -> DataFrame:
        """day, i, j, value in common units, and the period_start of each of its periods."""
        value = physics.clean_nodata(F.col("value"))
        if era:
            value = physics.m_to_mm(value) if family.startswith("precip") else physics.kelvin_to_c(value)
        if intervals is not None:
            own = df.where(F.year("day").isin(years)).select("day", "i", "j", value.alias("value"))
            return calendar.assign_intervals(own, intervals.select("start_date", "end_date")).select("day", "i", "j", "value", F.col("start_date").alias("period_start"))
        own = calendar.filter_years(df, years, period).select("day", "i", "j", value.alias("value"))
        number = cal.epi_year(F.col("day")) if period == "epiweek" else F.year("day")
        return own.where(number.isin(years)).withColumn("period_start", cal.period_start(F.col("day"), period))

    members = zones.zone_cells(layer, grid, all_touched)
    if family.startswith("anomaly"):
        out = climate.anomaly_indicator(placed(cells), members, normals, layer=layer)
    elif family.startswith("humidity"):
        out = climate.humidity_indicator(placed(cells), placed(dewpoint), members, layer=layer)
    else:
        out = zones.period_indicator(placed(cells), members, stats or list(zones.STATS), layer)
    if intervals is not None:
        out = out.join(intervals.select(F.col("start_date").alias("period_start"), "number"), "period_start")
    else:
        out = out.withColumn("number", cal.period_number(F.col("period_start"), period))
    return out if source is None else health.describe(out, source, family, "custom" if intervals is not None else period, "mun")


#: Columns that tell the layers of health rows apart: each indicator by its aggregations is a layer.
FRAME = ["indicator", "agg", "agg_time"]


def health_indicator(df: DataFrame, spatial: list[str], temporal: list[str], layer: DataFrame, epi: DataFrame, registry: DataFrame, provider: str, region: DataFrame | None = None, indicators: list[str] | None = None) -> DataFrame:
    """Canonical rows of indicator, cod, date, agg, agg_time, value: split, described, placed, rounded and dated.

    indicators: those that are wanted (all without it). Each must be in the provider's registry, or UnknownIndicator is
    raised. Every indicator is rounded and dated by itself, as is each of its aggregations: decimals follow its own
    largest value, and its periods end before its own next start. One aggregate by layer and start has what that takes;
    it is stored, and joined to the rows, so they are read twice in all.
    """
    asked = df if indicators is None else df.where(F.col("indicator").isin(indicators))
    rows, found = health.select_combinations(asked, spatial, temporal, "indicator")
    health.require_indicators(registry, provider, indicators or found)
    rows = health.attach_indicator(rows, registry, provider).withColumn("code", F.col("cod").cast("string").try_cast("bigint"))
    rows = health.crop_to_region(rows, region) if region is not None else rows
    rows = health.standard_dates(rows.withColumn("value", F.col("value").try_cast("double")), epi)
    zones_of = layer.select(F.col("zone_id").alias("code"))
    spans = rows.join(zones_of, "code", "left_semi").groupBy(*FRAME, "start_date").agg(F.min("value").alias("_least"), F.max("value").alias("_most"))
    spans = stored(spans, "spans")  # a row a layer and start
    bounds = spans.groupBy(*FRAME).agg(F.min("_least").alias("_low"), F.max("_most").alias("_high"))
    decimals = classify.class_breaks(bounds.withColumn("_v", F.explode(F.array("_low", "_high"))), "_v", FRAME).select(*[F.col(c).alias(f"_b_{c}") for c in FRAME], "decimals")
    same = lambda mark: reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{mark}{c}")) for c in FRAME])
    ends = calendar.period_end(spans.select(*FRAME, "start_date"), F.col("agg_time"), "start_date", by=FRAME).join(decimals, same("_b_"))
    ends = ends.select(*[F.col(c).alias(f"_p_{c}") for c in FRAME], F.col("start_date").alias("_p_start_date"), F.col("period_end").alias("end_date"), "decimals")
    ends = stored(ends, "ends")  # so that the optimiser knows how small it is
    dated = rows.join(ends, same("_p_") & (F.col("start_date") == F.col("_p_start_date")))
    out = health.enrich_zones(dated, layer).withColumn("value", classify.round_adaptively(F.col("value"), F.col("decimals")))
    return health.standardize(out.withColumnsRenamed({"title": "name_indicator", "provider": "data_source", "agg": "spatial_agg", "agg_time": "time_agg", "rings": "geometry"}))


def drone_catalogue(images: DataFrame, done: DataFrame, collections: DataFrame, pixels: DataFrame | None = None, cells: DataFrame | None = None, zone_of: DataFrame | None = None, paths: DataFrame | None = None) -> DataFrame:
    """Items that aren't published yet, with ground distance, footprint, box, collection and band statistics.

    With cells (zone_id, i, j) and zone_of (zone_id, tz) they have their UTC time, with paths the assets of their name.
    """
    new = imagery.pending(images, done)
    gsd = physics.gsd_m(F.col("flight_height_m"), F.col("sensor_width_mm"), F.col("width"), F.col("focal_mm"))
    placed = imagery.bbox_wgs84(imagery.image_footprint(new.withColumn("gsd_m", gsd).withColumn("gsd_cm", gsd * 100)))
    items = imagery.attach_collection(placed, collections)
    if cells is not None:
        items = imagery.to_utc(items, cells, zone_of)
    if paths is not None:
        items = items.join(imagery.build_items(paths).select("item", "assets"), "item", "left")
    if pixels is None:
        return items
    stats = imagery.band_stats(pixels).groupBy("image").agg(F.array_sort(F.collect_list(F.struct("band", "least", "most", "mean", "spread"))).alias("bands"))
    return items.join(stats, items["item"] == stats["image"], "left").drop("image")


def classify_layer(df: DataFrame, value: str = "value", by: Sequence[str] = ()) -> DataFrame:
    """Classes of a layer, or of all layers of a table by the columns that tell them apart."""
    return classify.equal_interval_class(df, value, by)


def load_layer(df: DataFrame, flavour: str, url: str, table: str, mode: str = "append") -> None:
    from geohealth.sources.writers import write_jdbc

    write_jdbc(health.to_db_rows(df, flavour), url, table, mode)
