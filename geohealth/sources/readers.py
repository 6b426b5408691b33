"""Readers of indicator tables, case pages, calendars, stations, normals, cells and zones."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geohealth.functions import text
from geohealth.operators.calendar import filter_years
from geohealth.operators.zones import CellSpan
from geohealth.sources.scratch import file_system


@dataclass(frozen=True)
class ColumnRoles:
    """The input's names of the roles."""

    cod: str
    date: str
    name: str
    spt_agg: str
    temp_agg: str
    value: str

    def renames(self) -> dict[str, str]:
        return {self.cod: "cod", self.date: "date", self.name: "indicator", self.spt_agg: "agg", self.temp_agg: "agg_time", self.value: "value"}


def read_indicator(spark: SparkSession, path: str | list[str], roles: ColumnRoles) -> DataFrame:
    """Indicator tables with the roles' columns: CSV all as text, Parquet with its types. All paths are one scan."""
    first = path if isinstance(path, str) else path[0]
    reader = spark.read.option("header", True).option("inferSchema", False).csv if first.rstrip("/").endswith("csv") else spark.read.parquet
    df = reader(path) if isinstance(path, str) or reader != spark.read.parquet else reader(*path)
    names = roles.renames()
    if lost := [c for c in names if c not in df.columns]:
        raise ValueError(f"columns are missing: {lost}")
    return df.select(*[F.col(c).alias(n) for c, n in names.items()])


PAGES = "pagination struct<total_pages:int>, items array<struct<data_iniSE:string,municipio_geocodigo:bigint,uf:string,casos:double,p_inc100k:double,nivel:int,casconf:double>>"


def read_case_pages(spark: SparkSession, path: str, field: str, indicator: str, start: str | None = None, end: str | None = None, code: int | None = None, uf: str | None = None) -> DataFrame:
    """Landed JSON pages, one row per record: indicator, date, agg, agg_time, cod, value (missing: 0), filtered by day, code and state."""
    items = spark.read.schema(PAGES).option("multiLine", True).json(path).select(F.explode("items").alias("r")).select("r.*")
    items = items.where(F.col("uf") == uf) if uf is not None else items
    day, cod = F.to_date("data_iniSE"), F.col("municipio_geocodigo")
    agg = F.when(F.length(cod.cast("string")) == 2, "state").otherwise("municipality")
    out = items.select(F.lit(indicator).alias("indicator"), day.alias("date"), agg.alias("agg"), F.lit("epiweek").alias("agg_time"), cod.alias("cod"), F.coalesce(F.col(field).cast("double"), F.lit(0.0)).alias("value"))
    for bound, keep in ((start, F.col("date") >= F.lit(start)), (end, F.col("date") <= F.lit(end)), (code, F.col("cod") == F.lit(code))):
        out = out.where(keep) if bound is not None else out
    return out.dropDuplicates()


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """year, week, start_date, end_date of a CSV with Year, Week, StartDate, EndDate; dates as ISO or dd/MM/yyyy."""
    df = spark.read.option("header", True).csv(path)
    if lost := [c for c in ("Year", "Week", "StartDate", "EndDate") if c not in df.columns]:
        raise ValueError(f"columns are missing: {lost}")
    day = lambda c: F.coalesce(F.try_to_date(F.col(c), "yyyy-MM-dd"), F.try_to_date(F.col(c), "dd/MM/yyyy"))
    return df.select(F.col("Year").cast("int").alias("year"), F.col("Week").cast("int").alias("week"), day("StartDate").alias("start_date"), day("EndDate").alias("end_date"))


def _decimal(name: str):
    return F.translate(F.col(name), ",", ".").try_cast("double")


def read_stations(spark: SparkSession, path: str) -> DataFrame:
    """code, name, uf, lat, lon, altitude of a station catalogue: ';' between fields, decimal commas."""
    df = spark.read.option("header", True).option("sep", ";").csv(path)
    return df.select(F.col("CD_ESTACAO").alias("code"), F.col("DC_NOME").alias("name"), F.col("SG_ESTADO").alias("uf"), _decimal("VL_LATITUDE").alias("lat"), _decimal("VL_LONGITUDE").alias("lon"), _decimal("VL_ALTITUDE").alias("altitude"))


#: Month headers without accents.
MONTHS = ["Janeiro", "Fevereiro", "Marco", "Abril", "Maio", "Junho", "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro"]


def read_normals(spark: SparkSession, path: str) -> DataFrame:
    """code, month, value of a table with a column per month; what is no number is left out."""
    df = spark.read.option("header", True).option("sep", ";").csv(path)
    plain = {c: c.translate(str.maketrans(text.ACCENTED, text.PLAIN)) for c in df.columns}
    return normals_to_long(df.withColumnsRenamed(plain).withColumnRenamed("Codigo", "code"), MONTHS)


def normals_to_long(wide: DataFrame, months: list[str]) -> DataFrame:
    long = wide.select("code", *[F.col(m).cast("string").alias(m) for m in months]).unpivot(["code"], months, "_month", "_value")
    number = F.array_position(F.array(*[F.lit(m) for m in months]), F.col("_month")).cast("int")
    value = F.translate("_value", ",", ".").try_cast("double")
    return long.select("code", number.alias("month"), value.alias("value")).where(F.col("value").isNotNull())


def _variables(spark: SparkSession, path: str) -> set[str]:
    """The variables that have a directory; no file is opened."""
    files, folder = file_system(spark, path)
    return {unquote(f.getPath().getName().removeprefix("variable=")) for f in files.listStatus(folder) if f.getPath().getName().startswith("variable=")}


def read_cells(spark: SparkSession, path: str, variable: str, years: list[int], period: str, span: CellSpan | None = None) -> DataFrame:
    """day, i, j, value of a variable's cells in the years (and, for epiweeks, in the lookback before them).

    Directories are by variable and year, or by variable, year and month: only those that are asked for are read, so of
    the year before the first only December, and that for epiweeks only. With a span of cells (that of the zones' box)
    its bounds reach the files, which are skipped where they have none of these cells.
    """
    if variable not in _variables(spark, path):
        raise ValueError(f"no such variable: {variable}")
    df = spark.read.parquet(path)
    wanted = F.col("year").isin(years)
    if period == "epiweek":
        before = F.col("year") == min(years) - 1
        wanted |= before & (F.col("month") == 12) if "month" in df.columns else before
    pruned = df.where((F.col("variable") == variable) & wanted)
    if span is not None:
        pruned = pruned.where(F.col("i").between(span.i0, span.i1) & F.col("j").between(span.j0, span.j1))
    return filter_years(pruned, years, period).select("day", "i", "j", "value")


REGISTRY = "map<string,struct<name:string,url:string,country:string,indicators:array<struct<id:string,name:string,title:string,disease:string,description:string,field_name:string>>>>"


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """provider, url, country and an indicator's id, title and field of a JSON file: provider -> its indicators."""
    whole = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", REGISTRY)).alias("provider", "p"))
    return whole.select("provider", "p.url", "p.country", F.explode("p.indicators").alias("i")).select("provider", "url", "country", "i.id", "i.title", "i.field_name")


FEATURE = "struct<properties:map<string,string>,geometry:struct<type:string,coordinates:string>>"
ZONES = f"type string, features array<{FEATURE}>"


def _zones(features: DataFrame, mapping: dict[str, str]) -> DataFrame:
    prop = lambda n: F.try_element_at(F.col("f.properties"), F.lit(mapping[n]))
    shape, kind = F.col("f.geometry.coordinates"), F.col("f.geometry.type")
    single = F.from_json(shape, "array<array<array<double>>>")
    several = F.flatten(F.from_json(shape, "array<array<array<array<double>>>>"))
    points = F.when(kind == "Polygon", single).otherwise(several)
    rings = F.transform(points, lambda ring: F.transform(ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y"))))
    return features.select(prop("zone_id").try_cast("bigint").alias("zone_id"), prop("name").alias("name"), prop("uf").alias("uf"), rings.alias("rings"))


def read_zones(spark: SparkSession, path: str, mapping: dict[str, str], lines: bool = False) -> DataFrame:
    """zone_id, name, uf, rings of GeoJSON features; mapping: our names to the file's properties. Polygons and multi-polygons.

    A file holds a whole collection, which one task reads. With lines each line holds a feature (a comma may follow it, and
    lines without one, such as a collection's first and last, are left out): large files are then split over many tasks.
    """
    if lines:
        text = spark.read.text(path).select(F.regexp_replace(F.trim("value"), r",\s*$", "").alias("line"))
        found = text.where(F.get_json_object("line", "$.type") == "Feature").select(F.from_json("line", FEATURE).alias("f"))
        return _zones(found, mapping)
    return _zones(spark.read.schema(ZONES).option("multiLine", True).json(path).select(F.explode("features").alias("f")), mapping)
