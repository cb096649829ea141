"""Calendar quarters as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quarter_end(day: Column) -> Column:
    """The last day of the day's quarter; also the first quarter end on or after it."""
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


def previous_quarter_end(day: Column) -> Column:
    return F.date_sub(F.trunc(day, "quarter"), 1)


def quarter_label(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("Q"), F.quarter(day).cast("string"))


def is_quarter_end(day: Column) -> Column:
    """A day from the 28th on in the last month of a quarter."""
    return F.month(day).isin(3, 6, 9, 12) & (F.dayofmonth(day) >= 28)


def quarter_ends_between(first: Column, last: Column) -> Column:
    """The quarter ends from ``first`` to ``last``, as an array."""
    starts = F.sequence(F.trunc(first, "quarter"), F.trunc(last, "quarter"), F.expr("interval 3 months"))
    return F.filter(F.transform(starts, lambda d: F.last_day(F.add_months(d, 2))), lambda d: (d >= first) & (d <= last))


def with_period_labels(df: DataFrame, period: str = "period", start: str | None = None) -> DataFrame:
    """Add year, quarter, label and, if a start is given, the days covered."""
    day = F.col(period)
    out = df.withColumns({"year": F.year(day), "qtr": F.quarter(day), "quarter": quarter_label(day)})
    return out.withColumn("span_days", F.datediff(day, F.col(start))) if start else out


def basis_label(day: Column, adopted: Column, after: str = "CECL", before: str = "incurred_loss") -> Column:
    """Which accounting basis a period is on; a null adoption date counts as not adopted."""
    return F.when(F.coalesce(day >= adopted, F.lit(False)), after).otherwise(before)


def stamp_to_date(stamp: Column, open_end: str = "99991231") -> Column:
    """A YYYYMMDD stamp as a date; blank, zero, open-ended and impossible ones are null."""
    clean = F.trim(stamp.cast("string"))
    good = clean.rlike("^[0-9]{8}$") & (clean != open_end)
    return F.when(good, F.try_to_timestamp(clean, F.lit("yyyyMMdd")).cast("date"))
