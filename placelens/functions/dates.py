"""Date and time expressions; all are defined in the session zone, which is pinned to UTC."""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats of day tags, run arguments and readable times.
DAY_FORMAT = "yyyyMMdd"
COMPACT_FORMAT = "yyyyMMddHHmmss"
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Fixed value: the report interval in seconds.
RUN_SECONDS = 600


def day_tag(moment: Column | str) -> Column:
    return F.date_format(moment, DAY_FORMAT)


def yesterday_tag(moment: Column) -> Column:
    return days_before(moment, 1)


def days_before(moment: Column, days: int) -> Column:
    return F.date_format(F.date_sub(F.to_date(moment), days), DAY_FORMAT)


def tag_days_before(tag: Column, days: int) -> Column:
    """Shift a yyyyMMdd tag back; a text that is no date gives NULL."""
    return days_before(F.try_to_timestamp(tag, F.lit(DAY_FORMAT)), days)


def compact_to_text(compact: Column) -> Column:
    return to_text(F.try_to_timestamp(compact, F.lit(COMPACT_FORMAT)))


def to_text(moment: Column) -> Column:
    return F.date_format(moment, TEXT_FORMAT)


def from_text(text: Column) -> Column:
    """Strict parse; bad text gives NULL."""
    return F.try_to_timestamp(text, F.lit(TEXT_FORMAT))


def from_text_lenient(text: Column) -> Column:
    """The beginning of a text read as a time whose fields may lie beyond their range and roll over: 2024-02-30 is 1 March.

    Fields are whole numbers, of as many digits as there are; month 0 is the December before, day 0 the last of the month before.
    A text that does not begin with all six fields gives NULL, as does a year that Spark's dates do not have.
    """
    number = r"([+-]?[0-9]{1,9})"
    pattern = rf"^([0-9]{{1,4}})-{number}-{number} +{number}:{number}:{number}"
    year, month, day, hour, minute, second = (
        F.regexp_extract(text, pattern, group).try_cast("bigint") for group in range(1, 7)
    )
    months = year * 12 + month - 1
    first = F.try_make_timestamp(F.floor(months / 12).cast("int"), (F.pmod(months, F.lit(12)) + 1).cast("int"), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    seconds = (day - 1) * 86_400 + hour * 3600 + minute * 60 + second
    return F.timestamp_seconds(F.unix_timestamp(first) + seconds)


def midnight(moment: Column) -> Column:
    return F.date_trunc("day", moment)


def epoch_seconds(moment: Column | str) -> Column:
    return F.unix_timestamp(moment)


def floor_to_run(moment: Column) -> Column:
    """Round down to the 10-minute report time."""
    seconds = epoch_seconds(moment)
    return F.timestamp_seconds(seconds - F.pmod(seconds, F.lit(RUN_SECONDS)))


def run_bounds(run: str) -> tuple[int, int, str]:
    """Epoch bounds [from, to) and day tag of a run argument yyyyMMddHHmmss.

    A run covers its day from midnight up to the run time rounded down to 10 minutes. At midnight
    it covers the whole previous day.
    """
    at = dt.datetime.strptime(run, "%Y%m%d%H%M%S").replace(tzinfo=dt.timezone.utc)
    upper = int(at.timestamp()) // RUN_SECONDS * RUN_SECONDS
    last = dt.datetime.fromtimestamp(upper - 1, dt.timezone.utc)
    day = last.replace(hour=0, minute=0, second=0)
    return int(day.timestamp()), upper, day.strftime("%Y%m%d")


def day_tags(day: str, back: int) -> list[str]:
    """The tags of `day` and the `back` days before it, oldest first."""
    last = dt.datetime.strptime(day, "%Y%m%d")
    return [(last - dt.timedelta(days=n)).strftime("%Y%m%d") for n in range(back, -1, -1)]
