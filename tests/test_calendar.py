from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import functions as F

from geohealth.functions import calendar as cal
from geohealth.operators import calendar as ops


def test_epi_calendar_rules(spark):
    rows = ops.epi_calendar(spark, list(range(2010, 2026))).collect()
    assert len(rows) == 835
    by = {(r.year, r.week): r for r in rows}
    assert (2025, 53) in by and (2024, 53) not in by
    assert by[2025, 1].start_date == date(2024, 12, 29)
    assert all(r.start_date.weekday() == 6 and r.end_date - r.start_date == timedelta(6) for r in rows)


def test_closed_form_equals_calendar(spark):
    days = spark.sql("SELECT explode(sequence(date'2010-01-03', date'2025-12-27', interval 1 day)) AS day")
    d = F.col("day")
    mine = days.select("day", cal.epi_year(d).alias("y"), cal.epi_week(d).alias("w"), cal.epi_start(d).alias("s"))
    cal_rows = ops.epi_calendar(spark, list(range(2010, 2027)))
    wrong = mine.join(cal_rows, mine.s == cal_rows.start_date, "left").where("y <> year or w <> week or year is null or day > end_date or day < start_date")
    assert wrong.count() == 0


def test_interval_gaps_and_single_days(spark):
    custom = spark.createDataFrame([(1, date(2024, 1, 1), date(2024, 1, 1)), (2, date(2024, 1, 3), date(2024, 1, 5))], "week int, start_date date, end_date date")
    days = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 7)], "day date")
    assert sorted((r.day.day, r.week) for r in ops.assign_intervals(days, custom).collect()) == [(1, 1), (3, 2), (4, 2), (5, 2)]


def test_period_end_defaults_and_calendar_end(spark):
    s = spark.createDataFrame([(date(2023, 1, 1),), (date(2024, 1, 1),)], "period_start date")
    got = {r.period_start.year: r.period_end for r in ops.period_end(s, "year").collect()}
    assert got == {2023: date(2023, 12, 31), 2024: date(2024, 12, 30)}
    got = {r.period_start.year: r.period_end for r in ops.period_end(s, "year", calendar_end=True).collect()}
    assert got[2024] == date(2024, 12, 31)
    w = spark.createDataFrame([(date(2023, 12, 24),), (date(2024, 1, 7),)], "period_start date")
    got = {r.period_start: r.period_end for r in ops.period_end(w, "epiweek").collect()}
    assert got == {date(2023, 12, 24): date(2024, 1, 6), date(2024, 1, 7): date(2024, 1, 7)}


def test_lookback(spark):
    days = spark.createDataFrame([(date(2023, 12, 24),), (date(2023, 12, 25),), (date(2024, 5, 1),), (None,)], "day date")
    assert ops.filter_years(days, [2024], "epiweek").count() == 2
    assert ops.filter_years(days, [2024], "month").count() == 1
