"""Sinks: partitioned periods, GeoJSON lines and relational tables; request manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geohealth.functions.shapes import polygons
from geohealth.operators.zones import as_multi

PARTS = ["name_indicator", "spatial_agg", "time_agg", "period_start"]


def write_periods(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """A directory per indicator, aggregations and period. Rows of a period meet in few files, and large periods are split.

    Overwriting replaces the periods that df has and no others, so indicators stand beside each other on a path; the old
    files go when the whole write has succeeded.
    """
    by = [c for c in PARTS if c in df.columns]
    writer = df.hint("rebalance", *by).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)


def write_cells(df: DataFrame, path: str) -> None:
    """Cells (variable, day, i, j, value) in a directory per variable, year and month, sorted by i and j within files, so that
    readers skip months by their directories and cells by the files' bounds."""
    parts = df.withColumn("year", F.year("day")).withColumn("month", F.month("day"))
    parts = parts.repartitionByRange("variable", "year", "month", "i", "j").sortWithinPartitions("variable", "year", "month", "i", "j")
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("variable", "year", "month").parquet(path)


def geojson_feature(properties: list[str], rings: Column) -> Column:
    """A feature with a multi-polygon of the rings: parts with their holes. A single ring is a part by itself."""
    parts = F.when(F.size(rings) == 1, as_multi(rings)).otherwise(polygons(rings))
    shape = F.transform(parts, lambda part: F.transform(part, lambda ring: F.transform(ring, lambda p: F.array(p["x"], p["y"]))))
    geometry = F.struct(F.lit("MultiPolygon").alias("type"), shape.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), geometry.alias("geometry")))


def write_geojson_lines(df: DataFrame, path: str, rings: str = "rings") -> None:
    """One feature a line; all columns but the rings are properties."""
    df.select(geojson_feature([c for c in df.columns if c != rings], F.col(rings)).alias("value")).write.mode("overwrite").text(path)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", **options: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, batchsize="10000", **options).mode(mode).save()


def daily_manifest(spark: SparkSession, start: str, end: str, template: str) -> DataFrame:
    """day and url of every day; the template has {yyyy}, {MM}, {dd}."""
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias("day"))
    url: Column = F.lit(template)
    for mark in ("yyyy", "MM", "dd"):
        url = F.replace(url, F.lit("{" + mark + "}"), F.date_format("day", mark))
    return days.select("day", url.alias("url"))


def monthly_manifest(spark: SparkSession, start: str, end: str) -> DataFrame:
    """year, month and the number of days of every month."""
    first = F.sequence(F.trunc(F.lit(start).cast("date"), "month"), F.lit(end).cast("date"), F.expr("interval 1 month"))
    months = spark.range(1).select(F.explode(first).alias("m"))
    return months.select(F.year("m").alias("year"), F.month("m").alias("month"), F.dayofmonth(F.last_day("m")).alias("days"))
