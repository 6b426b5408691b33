"""Indicator tables: splitting, enriching, and bringing to one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geohealth.functions import calendar as cal
from geohealth.functions.shapes import multipolygon_text

CANONICAL = ["code", "name", "uf", "data_source", "name_indicator", "number", "start_date", "end_date", "time_agg", "spatial_agg", "value", "geometry"]
#: Rings of a zone: array of arrays of points.
GEOMETRY = "array<array<struct<x:double,y:double>>>"


class UnknownIndicator(ValueError):
    """An indicator that the provider's registry doesn't list."""


class MissingCombination(ValueError):
    """A combination that was asked for has no rows."""


def select_combinations(df: DataFrame, spatial: list[str], temporal: list[str], name: str | None = None):
    """Rows of the pairs of aggregations; week and epiweek are one; rows without a code go; each pair must have rows.

    With the name of a column also its values, of which there must be few (the indicators), from the same look at the rows.
    """
    named = df.withColumn("agg_time", F.when(F.col("agg_time") == "week", "epiweek").otherwise(F.col("agg_time"))).where(F.col("cod").isNotNull())
    wanted = list(dict.fromkeys("epiweek" if t == "week" else t for t in temporal))
    kept = named.where(F.col("agg").isin(spatial) & F.col("agg_time").isin(wanted))
    found = kept.select("agg", "agg_time", *([name] if name else [])).distinct().collect()  # at most the pairs asked for, times the names
    if lost := [(s, t) for s in spatial for t in wanted if (s, t) not in {(r[0], r[1]) for r in found}]:
        raise MissingCombination(f"no rows for {lost}")
    return (kept, sorted({r[2] for r in found if r[2] is not None})) if name else kept


def crop_to_region(df: DataFrame, region: DataFrame, key: str = "code") -> DataFrame:
    """Rows whose code the crop layer has."""
    return df.join(region.select(key).distinct(), key, "left_semi")


def enrich_zones(df: DataFrame, zones: DataFrame) -> DataFrame:
    """Rows whose code the zone layer has, with its name, uf and rings. A code that is listed twice counts once."""
    layer = zones.groupBy(F.col("zone_id").alias("code")).agg(F.min_by(F.struct("name", "uf", "rings"), "name").alias("_zone"))
    return df.join(layer, "code").select("*", "_zone.*").drop("_zone")


def attach_indicator(df: DataFrame, registry: DataFrame, provider: str) -> DataFrame:
    """Title and provider of each indicator, with the provider's url and country where the registry has them."""
    more = [c for c in ("url", "country") if c in registry.columns]
    mine = registry.where(F.col("provider") == provider).select(F.col("id").alias("indicator"), "title", "provider", *more)
    return df.join(mine, "indicator")


def require_indicators(registry: DataFrame, provider: str, ids: list[str]) -> None:
    """Raise UnknownIndicator for an id that the provider doesn't have. The registry is small, and only these ids come back."""
    known = {r[0] for r in registry.where((F.col("provider") == provider) & F.col("id").isin(ids)).select("id").distinct().collect()}
    if lost := [i for i in ids if i not in known]:
        raise UnknownIndicator(f"{provider} has no {lost}")


def refresh_zones(old: DataFrame, new: DataFrame) -> DataFrame:
    """The old layer with name, uf and rings of the new one where it has them."""
    fields = [c for c in ("name", "uf", "rings") if c in old.columns]
    n = new.select("zone_id", *[F.col(c).alias("_" + c) for c in fields if c in new.columns])
    return old.join(n, "zone_id", "left").select("zone_id", *[(F.coalesce("_" + c, c) if c in new.columns else F.col(c)).alias(c) for c in fields])


def standard_dates(df: DataFrame, calendar: DataFrame, date: str = "date", agg_time: str = "agg_time") -> DataFrame:
    """start_date and number from dates as YYYY-MM-DD, YYYY-WW, YYYY-MM or YYYY, by the kind of period."""
    text, kind = F.col(date), F.col(agg_time)
    part = F.split(text, "-")
    week = calendar.select(F.col("year").alias("_y"), F.col("week").alias("_w"), F.col("start_date").alias("_s"))
    weekly = kind.isin("week", "epiweek") & text.rlike(r"^\d{4}-\d{1,2}$")
    keys = weekly & (F.get(part, F.lit(0)).try_cast("int") == F.col("_y")) & (F.get(part, F.lit(1)).try_cast("int") == F.col("_w"))
    month = F.try_to_date(F.concat(text, F.lit("-01")), "yyyy-MM-dd")
    year = F.try_to_date(F.concat(text, F.lit("-01-01")), "yyyy-MM-dd")
    day = F.try_to_date(text, "yyyy-MM-dd")
    start = F.when(kind.isin("week", "epiweek"), F.coalesce("_s", day)).when(kind == "month", F.trunc(F.coalesce(day, month), "month")).otherwise(F.trunc(F.coalesce(day, month, year), "year"))
    number = F.when(kind.isin("week", "epiweek"), cal.epi_week(F.col("start_date"))).when(kind == "month", F.month("start_date")).otherwise(F.year("start_date"))
    return df.join(week, keys, "left").withColumn("start_date", start).withColumn("number", number).drop("_y", "_w", "_s")


def standardize(df: DataFrame) -> DataFrame:
    """The canonical columns, in order; codes that are no numbers become NULL; columns that are missing are NULL."""
    code = F.col("code").cast("string").try_cast("bigint")
    return df.select(*[code.alias("code") if c == "code" else F.col(c) if c in df.columns else F.lit(None).cast(GEOMETRY if c == "geometry" else "string").alias(c) for c in CANONICAL])


def describe(df: DataFrame, source: str, indicator: str, time_agg: str, spatial_agg: str, start: str | None = None) -> DataFrame:
    """Constant descriptions; mun is written out. With the name of a start column also number and start_date of the period."""
    if start is not None:
        df = df.withColumn("number", cal.period_number(F.col(start), time_agg)).withColumn("start_date", F.col(start))
    spatial = "municipality" if spatial_agg == "mun" else spatial_agg
    values = {"data_source": source, "name_indicator": indicator, "time_agg": time_agg, "spatial_agg": spatial}
    return df.withColumns({k: F.lit(v) for k, v in values.items()})


def fill_missing(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.na.fill(0, columns)


def dedupe(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(keys)


def latest_release(releases: DataFrame, name: str) -> DataFrame:
    """The newest release with an asset whose name holds the indicator's name; ties go to the smaller name."""
    own = releases.where(F.contains(F.col("asset_name"), F.lit(name)))
    return own.orderBy(F.desc("published_at"), "asset_name").limit(1)


def encode_geometry(df: DataFrame, rings: str = "geometry", srid: int = 4326) -> DataFrame:
    """df with the rings as the text of a multi-polygon with its reference system. A shape that many rows share is written once."""
    own = df.withColumn("_shape", F.xxhash64(rings))
    shapes = own.where(F.col(rings).isNotNull()).select("code", "_shape", rings).dropDuplicates(["code", "_shape"])
    text = shapes.select(F.col("code").alias("_code"), F.col("_shape").alias("_s"), multipolygon_text(F.col(rings), srid).alias("_text"))
    joined = own.drop(rings).join(text, F.col("code").eqNullSafe(F.col("_code")) & (F.col("_shape") == F.col("_s")), "left")
    return joined.withColumnRenamed("_text", rings).select(*df.columns)


def to_db_rows(df: DataFrame, flavour: str) -> DataFrame:
    """Rows for the relational table. health: missing numbers and values are 0, values have 2 decimals. climate: rows without
    code or value are left out, values have 4. Rings become text that a geometry column takes."""
    if flavour not in ("health", "climate"):
        raise ValueError(f"unknown flavour: {flavour}")
    if dict(df.dtypes).get("geometry", "").startswith("array"):
        df = encode_geometry(df)
    if flavour == "health":
        return df.withColumn("number", F.coalesce("number", F.lit(0))).withColumn("value", F.coalesce("value", F.lit(0)).cast("decimal(10,2)"))
    return df.where(F.col("code").isNotNull() & F.col("value").isNotNull()).withColumn("value", F.col("value").cast("decimal(10,4)"))


def union_all(dfs: list[DataFrame]) -> DataFrame:
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def periods_to_long(wide: DataFrame, key: str, prefix: str = "w_") -> DataFrame:
    """key, period_start, value from columns named by the period's first day."""
    columns = [c for c in wide.columns if c.startswith(prefix)]
    long = wide.unpivot([key], columns, "period", "value")
    return long.select(key, F.to_date(F.substring("period", len(prefix) + 1, 8), "yyyyMMdd").alias("period_start"), "value")


def periods_to_wide(long: DataFrame, key: str, starts: list[str], prefix: str = "w_") -> DataFrame:
    """One column for each of the given starts (yyyyMMdd)."""
    label = F.concat(F.lit(prefix), F.date_format("period_start", "yyyyMMdd"))
    return long.withColumn("_p", label).groupBy(key).pivot("_p", [prefix + s for s in starts]).agg(F.first("value"))


def order_periods(df: DataFrame, start: str = "start_date") -> DataFrame:
    return df.orderBy(start)


def first_by(df: DataFrame, keys: list[str], value: Column, order: Column) -> DataFrame:
    """The value of the first row of each key."""
    return df.groupBy(*keys).agg(F.min_by(value, order).alias("first"))
