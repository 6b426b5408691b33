"""Calendars and joins with them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from geohealth.functions import calendar as cal


def epi_calendar(spark: SparkSession, years: list[int]) -> DataFrame:
    """year, week, start_date, end_date of every epiweek whose epidemiological year is asked for."""
    first, last = min(years), max(years)
    days = F.sequence(F.make_date(F.lit(first - 1), F.lit(12), F.lit(20)), F.make_date(F.lit(last + 1), F.lit(1), F.lit(10)), F.expr("interval 1 day"))
    starts = spark.range(1).select(F.explode(days).alias("d")).where(F.dayofweek("d") == 1)
    return starts.select(cal.epi_year(F.col("d")).alias("year"), cal.epi_week(F.col("d")).alias("week"), F.col("d").alias("start_date"), F.date_add("d", 6).alias("end_date")).where(F.col("year").isin(years))


def attach_week_number(df: DataFrame, calendar: DataFrame, day: str = "start_date") -> DataFrame:
    """year and week of the calendar's week that starts on the day; NULL where none does."""
    weeks = calendar.select(F.col("start_date").alias("_start"), "year", "week")
    return df.join(weeks, F.col(day) == F.col("_start"), "left").drop("_start")


def week_to_date(df: DataFrame, calendar: DataFrame, label: str = "date") -> DataFrame:
    """start_date of labels YYYY-WW."""
    part = F.split(F.col(label), "-")
    weeks = calendar.select(F.col("year").alias("_y"), F.col("week").alias("_w"), "start_date")
    keys = (F.get(part, F.lit(0)).try_cast("int") == F.col("_y")) & (F.get(part, F.lit(1)).try_cast("int") == F.col("_w"))
    return df.join(weeks, keys, "left").drop("_y", "_w")


def assign_intervals(df: DataFrame, calendar: DataFrame, day: str = "day") -> DataFrame:
    """Columns of the custom calendar's closed interval that holds the day; days in none are dropped, days in two come twice.

    The calendar is spread to one row a day, so the join is on equality and needs no comparison of every pair.
    """
    days = calendar.withColumn("_day", F.explode(F.sequence("start_date", "end_date", F.expr("interval 1 day"))))
    return df.join(days, F.col(day) == F.col("_day")).drop("_day")


def filter_years(df: DataFrame, years: list[int], period: str, day: str = "day") -> DataFrame:
    """Rows of the years; for epiweeks also 25 to 31 December before the first of them."""
    keep = F.year(day).isin(years)
    if period == "epiweek":
        keep |= (F.year(day) == min(years) - 1) & (F.month(day) == 12) & (F.dayofmonth(day) >= 25)
    return df.where(keep)


def period_stats(df: DataFrame, period: str, keys: Sequence[str], day: str = "day", value: str = "value") -> DataFrame:
    """keys, period_start, year and number of each period, with the max, min and mean of value; missing values are skipped."""
    d = F.col(day)
    year = cal.epi_year(d) if period == "epiweek" else F.year(d)
    by = df.groupBy(*keys, cal.period_start(d, period).alias("period_start"), year.alias("year"), cal.period_number(d, period).alias("number"))
    return by.agg(F.max(value).alias("max"), F.min(value).alias("min"), F.avg(value).alias("mean"))


def timeline(df: DataFrame, start: str = "period_start") -> DataFrame:
    """Distinct starts in order."""
    return df.select(start).distinct().orderBy(start)


def period_end(df: DataFrame, period: str | Column, start: str = "period_start", calendar_end: bool = False, by: Sequence[str] = ()) -> DataFrame:
    """period_end: the day before the next start that occurs; of the last one by the kind of period.

    The last epiweek ends on its start and the last year after 365 days, unless calendar_end asks for their real ends.
    With `by` each layer has a timeline of its own; a column as period gives each row's kind. The timeline has a row for
    each distinct start and is small beside the data; it is joined back by equality.
    """
    kind = period if isinstance(period, Column) else F.lit(period)
    year = F.make_date(F.year(start), F.lit(12), F.lit(31)) if calendar_end else F.date_add(F.col(start), 364)
    week = F.date_add(F.col(start), 6 if calendar_end else 0)
    last = F.when(kind == "year", year).when(kind.isin("epiweek", "week"), week).otherwise(F.date_sub(F.add_months(F.col(start), 1), 1))
    line = df.select(*by, start, last.alias("_last")).distinct().withColumn("_chunk", F.year(start))
    # the next start within a year, or else the first start of a later year that has any
    chunks = line.groupBy(*by, "_chunk").agg(F.min(start).alias("_first")).withColumn("_later", F.lead("_first").over(Window.partitionBy(*by).orderBy("_chunk")))
    after = F.lead(start).over(Window.partitionBy(*by, "_chunk").orderBy(start))
    same = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}{c}").eqNullSafe(F.col(f"{b}{c}")) for c in by], F.lit(True))
    later = chunks.select(*[F.col(c).alias(f"_c_{c}") for c in by], F.col("_chunk").alias("_c"), "_later")
    ends = line.withColumn("_next", after).join(later, (F.col("_chunk") == F.col("_c")) & same("", "_c_"))
    ends = ends.select(*[F.col(c).alias(f"_e_{c}") for c in by], F.col(start).alias("_s"), F.coalesce(F.date_sub(F.coalesce("_next", "_later"), 1), "_last").alias("period_end"))
    return df.join(ends, (F.col(start) == F.col("_s")) & same("", "_e_"), "left").drop("_s", *[f"_e_{c}" for c in by])
