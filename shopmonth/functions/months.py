"""Month and time expressions. A month is always the DATE of its first day."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The published naming scheme of monthly tables and files.
TABLE_PREFIX = "data_"
FILE_SUFFIX = ".csv.gz"
CSV_SUFFIXES = (".csv", ".csv.gz")
FILE_NAME_LIKE = "data_____-___%.csv.gz"


def utc_clock(instant: Column) -> Column:
    """TIMESTAMP → what a clock in UTC shows then, as TIMESTAMP_NTZ; the session's zone plays no part."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)


def parse_event_time(column: Column | str) -> Column:
    """Text → UTC time without a zone; text that does not parse becomes null instead of failing.

    A zone behind the time counts, and text without one is UTC.
    """
    column = F.col(column) if isinstance(column, str) else column
    has_zone = column.rlike(r":\d{1,2}(\.\d+)?\s*([A-Za-z]|[+-]\d)")
    return F.when(has_zone, utc_clock(F.try_to_timestamp(F.when(has_zone, column)))).otherwise(
        column.try_cast("timestamp_ntz"))


def elapsed_days(start: Column | str, end: Column | str) -> Column:
    """Whole 24-hour days between two instants (not the number of date changes)."""
    start = F.col(start) if isinstance(start, str) else start
    end = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("DAY", start, end)


def month_start(column: Column | str) -> Column:
    return F.trunc(column, "MM")


def month_label(month: Column | str) -> Column:
    """DATE → ``2019-Oct``."""
    return F.date_format(month, "yyyy-MMM")


def file_name(month: Column | str) -> Column:
    """DATE → ``data_2019-Oct.csv.gz``, the name retention jobs look for."""
    return F.concat(F.lit(TABLE_PREFIX), month_label(month), F.lit(FILE_SUFFIX))


def table_label(month: Column | str) -> Column:
    """DATE → ``data_2019_oct``, the name of a published table."""
    return F.concat(F.lit(TABLE_PREFIX), F.lower(F.replace(month_label(month), F.lit("-"), F.lit("_"))))


def month_from_label(label: Column | str) -> Column:
    """``2019-Oct`` → DATE; anything else becomes null."""
    label = F.col(label) if isinstance(label, str) else label
    well_formed = F.when(label.rlike(r"^\d{4}-[A-Z][a-z]{2}$"), label)
    return F.try_to_timestamp(well_formed, F.lit("yyyy-MMM")).cast("date")


def month_from_name(name: Column | str) -> Column:
    """``data_2019-Oct.csv.gz`` → DATE; names of another form become null."""
    name = F.col(name) if isinstance(name, str) else name
    after_prefix = F.split_part(name, F.lit("_"), F.lit(2))
    return month_from_label(F.split_part(after_prefix, F.lit("."), F.lit(1)))


def last_months(as_of: Column | str, count: int, include_current: bool = True) -> Column:
    """Array of the last ``count`` months up to ``as_of``, oldest first."""
    newest = F.add_months(month_start(as_of), 0 if include_current else -1)
    return F.sequence(F.add_months(newest, 1 - count), newest, F.expr("interval 1 month"))


def expired_month(as_of: Column | str, months_back: int = 13) -> Column:
    """The month that leaves the warehouse at ``as_of``."""
    return F.add_months(month_start(as_of), -months_back)


def shift_month(day: dt.date, months: int) -> dt.date:
    """First day of the month ``months`` away, for bounds used as literals."""
    index = day.year * 12 + day.month - 1 + months
    return dt.date(index // 12, index % 12 + 1, 1)


def oldest_recent_month(as_of: dt.date, keep: int = 12) -> dt.date:
    """First of the ``keep`` newest calendar months, the running one included.

    Literal on purpose: a comparison with it reaches the scan as a partition or
    data filter.
    """
    return shift_month(as_of, 1 - keep)


def month_name(month: int) -> str:
    return "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()[month - 1]


def landed_stem(month: dt.date) -> str:
    """Name of a month's landed folder, and of its file without suffix: ``2019-Oct``."""
    return f"{month.year}-{month_name(month.month)}"


def landed_file(month: dt.date) -> str:
    """Name of the landed raw file of a month: ``2019-Oct.csv.gz``."""
    return landed_stem(month) + FILE_SUFFIX


def published_table(month: dt.date) -> str:
    """Name of the warehouse table of a month: ``data_2019_oct``."""
    return f"{TABLE_PREFIX}{month.year}_{month_name(month.month).lower()}"
