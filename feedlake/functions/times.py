"""Parsing of the time columns the feeds deliver."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# "Mon, 01 Jan 2024 10:00:00 GMT" or "... +0000", the weekday optional.
_MAIL_DATE = r"^([A-Za-z]{3},\s*)?(\d{1,2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2} ([A-Z]{1,4}|[+-]\d{4}))$"


def parse_time(col: Column, data_type: T.DataType) -> Column:
    """A timestamp from epoch seconds, an ISO string or a mail date; NULL if it is none."""
    if isinstance(data_type, T.NumericType):
        return F.timestamp_seconds(col)
    if not isinstance(data_type, T.StringType):
        return col.cast("timestamp")
    mail = F.regexp_extract(F.trim(col), _MAIL_DATE, 2)
    named_zone = F.when(mail.rlike("[A-Z]$"), F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss z")))
    offset = F.when(mail.rlike("[0-9]$"), F.try_to_timestamp(mail, F.lit("d MMM yyyy HH:mm:ss xx")))
    return F.when(mail != "", F.coalesce(named_zone, offset)).otherwise(F.try_to_timestamp(col))


def week_label(col: Column, iso_year: bool = False) -> Column:
    """``2024-W07``: calendar year and ISO week, so 2024-12-30 is ``2024-W01``.

    With ``iso_year`` the year belongs to the week: 2024-12-30 is ``2025-W01``.
    """
    year = F.extract(F.lit("YEAROFWEEK"), col) if iso_year else F.year(col)
    return F.concat(year.cast("string"), F.lit("-W"), F.lpad(F.weekofyear(col).cast("string"), 2, "0"))


def month_label(col: Column) -> Column:
    return F.concat(F.year(col).cast("string"), F.lit("-"), F.lpad(F.month(col).cast("string"), 2, "0"))
