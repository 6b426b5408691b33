"""Epidemiological weeks (Sunday to Saturday; the year is that of the week's Wednesday) and months, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epi_start(day: Column) -> Column:
    """The Sunday on or before the day."""
    return F.date_sub(day, F.dayofweek(day) - 1)


def epi_end(day: Column) -> Column:
    return F.date_add(epi_start(day), 6)


def _middle(day: Column) -> Column:
    return F.date_add(epi_start(day), 3)


def epi_year(day: Column) -> Column:
    return F.year(_middle(day))


def epi_week(day: Column) -> Column:
    return (F.floor((F.dayofyear(_middle(day)) - 1) / 7) + 1).cast("int")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def period_start(day: Column, period: str) -> Column:
    """First day of the epiweek or month of a day."""
    if period not in ("epiweek", "month"):
        raise ValueError(f"unknown period: {period}")
    return epi_start(day) if period == "epiweek" else month_start(day)


def period_number(day: Column, period: str) -> Column:
    return epi_week(day) if period == "epiweek" else F.month(day)


def is_iso_date(text: Column) -> Column:
    """Whether a text has the form YYYY-MM-DD and is a date."""
    return F.coalesce(text.rlike(r"^\d{4}-\d{2}-\d{2}$") & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), F.lit(False))
