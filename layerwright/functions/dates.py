"""Date keys and time stamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """``yyyyMMdd`` as an integer; NULL for text that is no date.

    Reckoned from the parts of the date, which costs far less per row than
    formatting and casting text.
    """
    date = day.try_cast("timestamp").cast("date")
    return F.year(date) * 10_000 + F.month(date) * 100 + F.dayofmonth(date)


def day_parts(day: Column) -> dict[str, Column]:
    return {"Year": F.year(day), "Month": F.month(day), "Day": F.dayofmonth(day)}


def utc_stamp(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss (UTC)`` of a timestamp, in a session that runs in UTC."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss '(UTC)'")


def utc_folder(moment: Column) -> Column:
    """``year=yyyy/month=MM/day=dd`` of a timestamp, in a session that runs in UTC."""
    return F.date_format(moment, "'year='yyyy'/month='MM'/day='dd")
