"""Date column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Folder date format of the source listing, drop-file time format, retention.
FOLDER_DATE_FORMAT = "dd.MM.yyyy"
FULL_SUFFIX = "_FULL"
DROP_TS_FORMAT = "yyyy-MM-dd_HH-mm-ss"
RETENTION_DAYS = 21
_MICROS_PER_DAY = 86_400_000_000


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def folder_date(d) -> Column:
    """C4: ``dd.MM.yyyy``."""
    return F.date_format(_c(d), FOLDER_DATE_FORMAT)


def is_new_year(d) -> Column:
    """1 January, the day of the full drop."""
    return (F.month(_c(d)) == 1) & (F.dayofmonth(_c(d)) == 1)


def drop_folder(d) -> Column:
    """Folder of a dated drop: the date, with ``_FULL`` on 1 January."""
    return F.concat(folder_date(d), F.when(is_new_year(d), F.lit(FULL_SUFFIX)).otherwise(F.lit("")))


def parse_drop_time(stem) -> Column:
    """``yyyy-MM-dd_HH-mm-ss`` -> timestamp; null when the name does not parse."""
    return F.try_to_timestamp(_c(stem), F.lit(DROP_TS_FORMAT))


def age_days(ts, now) -> Column:
    """Whole days elapsed (floor of elapsed time, not calendar days)."""
    micros = F.timestamp_diff("MICROSECOND", _c(ts), _c(now))
    return F.floor(micros / F.lit(_MICROS_PER_DAY)).cast("bigint")


def is_expired(ts, now, days: int = RETENTION_DAYS) -> Column:
    """at least ``days`` whole days old."""
    return age_days(ts, now) >= F.lit(days)
