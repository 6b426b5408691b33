"""Epidemiological weeks and months over dated records."""

from __future__ import annotations

from pyspark.sql import functions as F

from geohealth.functions import calendar as cal
from geohealth.operators import calendar as ops
from geohealth.queries import views as v
from geohealth.queries.registry import query


def _stats(spark, d, period):
    return ops.period_stats(v.daily(spark, d), period, ["zone_id"]).withColumn("mean", v.r4(F.col("mean")))


_SQL_STATS = "WITH {daily} SELECT zone_id, {start} AS period_start, {year} AS year, {number} AS number, max(value) AS max, min(value) AS min, {mean} AS mean FROM daily GROUP BY ALL"


@query("epiweek_stats", _SQL_STATS.format(daily=v.SQL_DAILY, start=v.sql_sunday("day"), year=v.sql_epi_year("day"), number=v.sql_epi_week("day"), mean=v.sql_r4("avg(value)")))
def epiweek_stats(spark, d):
    return _stats(spark, d, "epiweek")


@query("month_stats", _SQL_STATS.format(daily=v.SQL_DAILY, start="CAST(date_trunc('month', day) AS DATE)", year="CAST(year(day) AS INTEGER)", number="CAST(month(day) AS INTEGER)", mean=v.sql_r4("avg(value)")))
def month_stats(spark, d):
    return _stats(spark, d, "month")


_SQL_CAL = f"""years AS (SELECT min(year(CAST(o_orderdate AS DATE))) AS a, max(year(CAST(o_orderdate AS DATE))) AS b FROM orders), sundays AS (SELECT a, b, CAST(unnest(range(CAST({v.sql_sunday("make_date(a - 1, 12, 6)")} AS TIMESTAMP), make_timestamp(b + 1, 2, 1, 0, 0, 0), INTERVAL 7 DAY)) AS DATE) AS s FROM years),
cal AS (SELECT CAST(year(s + 3) AS INTEGER) AS year, CAST(row_number() OVER (PARTITION BY year(s + 3) ORDER BY s) AS INTEGER) AS week, s AS start_date, s + 6 AS end_date FROM sundays WHERE year(s + 3) BETWEEN a AND b)"""


def case_years(spark, d) -> list[int]:
    """All years from the first case to the last."""
    a, b = v.table(spark, d, "orders").agg(F.min(F.year("o_orderdate")), F.max(F.year("o_orderdate"))).first()
    return list(range(a, b + 1))


@query("epi_calendar", f"WITH {v.SQL_CASES}, {_SQL_CAL} SELECT c.year, c.week, c.start_date, CAST(c.end_date AS DATE) AS end_date, count(k.code) AS n FROM cal c LEFT JOIN cases k ON k.day BETWEEN c.start_date AND c.end_date GROUP BY ALL")
def epi_calendar(spark, d):
    """The calendar's weeks with the cases of each."""
    starts = v.cases(spark, d).groupBy(cal.epi_start(F.col("day")).alias("_s")).agg(F.count(F.lit(1)).alias("n"))
    c = ops.epi_calendar(spark, case_years(spark, d))
    return c.join(starts, F.col("start_date") == F.col("_s"), "left").select("year", "week", "start_date", "end_date", F.coalesce("n", F.lit(0)).alias("n"))


@query("custom_interval_join", f"""WITH {v.SQL_CASES}, custom AS (SELECT CAST(k AS INTEGER) AS label, a + CAST(k * 10 AS INTEGER) AS s, a + CAST(k * 10 + CASE WHEN k % 3 = 0 THEN 0 ELSE 8 END AS INTEGER) AS e FROM (SELECT a, unnest(range((b - a) // 10 + 1)) AS k FROM (SELECT min(day) AS a, max(day) AS b FROM cases)))
SELECT label, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM cases JOIN custom ON day BETWEEN s AND e GROUP BY label""")
def custom_interval_join(spark, d):
    """Intervals of 9 days with gaps, from the first case to the last; every third has one day."""
    cases = v.cases(spark, d)
    span = cases.agg(F.min("day").alias("a"), F.max("day").alias("b"))
    custom = span.select(F.posexplode(F.sequence("a", "b", F.expr("interval 10 days"))).alias("label", "start_date"))
    custom = custom.withColumn("end_date", F.date_add("start_date", F.when(F.col("label") % 3 == 0, 0).otherwise(8)))
    got = ops.assign_intervals(cases, custom)
    return got.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round(F.col("value") * 100).cast("long")).alias("cents"))


@query("week_number_lookup", f"WITH {v.SQL_CASES}, {_SQL_CAL} SELECT k.o_orderkey, k.day, c.year, c.week FROM cases k LEFT JOIN cal c ON c.start_date = k.day")
def week_number_lookup(spark, d):
    """Weeks of the cases whose day starts one."""
    got = ops.attach_week_number(v.cases(spark, d), ops.epi_calendar(spark, case_years(spark, d)), "day")
    return got.select("o_orderkey", "day", "year", "week")


@query("year_week_lookup", f"WITH {v.SQL_CASES}, {_SQL_CAL} SELECT c.start_date, count(*) AS n FROM (SELECT {v.sql_epi_year('day')} AS y, {v.sql_epi_week('day')} AS w FROM cases) k LEFT JOIN cal c ON c.year = k.y AND c.week = k.w GROUP BY 1")
def year_week_lookup(spark, d):
    """Labels YYYY-WW of the cases taken back to the first day of the week."""
    day = F.col("day")
    label = v.cases(spark, d).select(F.concat_ws("-", cal.epi_year(day).cast("string"), F.lpad(cal.epi_week(day).cast("string"), 2, "0")).alias("date"))
    return ops.week_to_date(label, ops.epi_calendar(spark, case_years(spark, d))).groupBy("start_date").agg(F.count(F.lit(1)).alias("n"))


@query("period_end_dates", f"""WITH {v.SQL_CASES}, s AS (SELECT DISTINCT CAST(date_trunc('month', day) AS DATE) AS p FROM cases WHERE month(day) <> 7)
SELECT p AS period_start, coalesce(lead(p) OVER (ORDER BY p) - 1, CAST(p + INTERVAL 1 MONTH AS DATE) - 1) AS period_end FROM s""")
def period_end_dates(spark, d):
    """Ends of months, of which July is missing: June reaches the day before August."""
    months = v.cases(spark, d).where(F.month("day") != 7).select(cal.month_start(F.col("day")).alias("period_start")).distinct()
    return ops.period_end(months, "month")


@query("year_lookback_filter", f"WITH {v.SQL_DAILY} SELECT l_orderkey, l_linenumber, day FROM daily WHERE year(day) IN (1997, 1998) OR day BETWEEN DATE '1996-12-25' AND DATE '1996-12-31'")
def year_lookback_filter(spark, d):
    return ops.filter_years(v.daily(spark, d), [1997, 1998], "epiweek").select("l_orderkey", "l_linenumber", "day")


@query("timeline", f"WITH {v.SQL_DAILY} SELECT {v.sql_sunday('day')} AS period_start FROM daily GROUP BY 1")
def timeline(spark, d):
    return ops.timeline(v.daily(spark, d).select(cal.epi_start(F.col("day")).alias("period_start")))
