from __future__ import annotations

from pyspark.sql import Column, functions as F

LOCAL_ZONE = "Europe/Berlin"

# Day-first spellings of exported times. Bracketed parts may be missing, and fractions of
# one to nine digits are accepted (cut to microseconds).
DAY_FIRST_FORMATS = (
    "dd/MM/yyyy[ HH:mm[:ss[.SSSSSSSSS]]]",
    "dd.MM.yyyy[ HH:mm[:ss[.SSSSSSSSS]]]",
)
YEAR_FIRST = r"^\d{4}-\d{2}-\d{2}([ T].*)?$"

# Upper bound in milliseconds (exclusive) and label of each gap bucket.
GAP_BUCKETS = (
    (500, "< 0.5s"),
    (1000, "0.5-1s"),
    (2000, "1-2s"),
    (5000, "2-5s"),
    (10000, "5-10s"),
    (30000, "10-30s"),
    (60000, "30-60s"),
)
FIRST_EVENT = "First Event"
LONGEST_GAP = "> 60s"


def parse_export_time(text: Column) -> Column:
    """Timestamp from any of the accepted spellings, judged row by row; NULL when none fits."""
    trimmed = F.trim(text)
    # A failed attempt costs far more than one that fits, so only the format with the text's separator is tried.
    separator = F.substring(trimmed, 3, 1)
    day_first = [F.when(separator == f[2], F.try_to_timestamp(trimmed, F.lit(f))) for f in DAY_FIRST_FORMATS]
    year_first = F.when(trimmed.rlike(YEAR_FIRST), trimmed.try_cast("timestamp"))
    return F.coalesce(*day_first, year_first)


def utc_to_local(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    """Wall-clock time in ``zone``, daylight saving included (session zone must be UTC)."""
    return F.from_utc_timestamp(ts, zone)


def millis_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS")


def millis_between(start: Column, end: Column) -> Column:
    """Milliseconds between the two times, each cut to its millisecond first."""
    return F.unix_millis(end) - F.unix_millis(start)


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1e6)


def gap_bucket(previous: Column, gap_ms: Column) -> Column:
    label = F.when(previous.isNull(), FIRST_EVENT)
    for bound, name in GAP_BUCKETS:
        label = label.when(gap_ms < bound, name)
    return label.otherwise(LONGEST_GAP)


def iso_weekday(day: Column) -> Column:
    """1 for Monday to 7 for Sunday."""
    return F.weekday(day) + 1
