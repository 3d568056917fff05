"""Click and impression logs in the shape the attribution join expects."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelens.functions.text import attributable, is_present
from placelens.functions.urls import url_key

# Log columns in the order slot type, index, page, URL, visitor.
CLICK_COLUMNS = {"typename": "urlfrom", "idx": "idx02", "pagenum": "pgnum", "url": "urlto", "visitor": "clientime"}
VIEW_COLUMNS = {"typename": "type", "idx": "idx", "pagenum": "pagenum", "url": "url", "visitor": "ime"}


def one_day(table: DataFrame, day: str | None = None, **equals: str) -> DataFrame:
    """Rows of partition `dt` = day (all days without one) where the given columns have given values."""
    if day is not None:
        table = table.where(F.col("dt") == day)
    for column, value in equals.items():
        table = table.where(F.col(column) == value)
    return table


def log_rows(
    log: DataFrame, columns: dict[str, str], partitions: int | None = None, key: Callable[[Column], Column] = url_key
) -> DataFrame:
    """Rename to `typename, idx, pagenum, content, visitor, dateline` and key the URL.

    Rows without visitor are dropped first, and rows without a place or URL, which match no slot. The
    place columns become text, whatever type the table gives them. `partitions` spreads the rows before
    the URL patterns run, for unsplittable input. `key` turns the URL into the content key: with `url_key_offset`
    a URL without an id has the empty key instead of its own text.
    """
    kept = log.where(is_present(F.col(columns["visitor"])))
    for name in ("typename", "idx", "pagenum", "url"):
        kept = kept.where(F.col(columns[name]).isNotNull())
    if partitions:
        kept = kept.repartition(partitions)
    return kept.select(
        *(F.col(columns[name]).cast("string").alias(name) for name in ("typename", "idx", "pagenum")),
        key(F.col(columns["url"])).alias("content"),
        F.col(columns["visitor"]).alias("visitor"),
        F.col("dateline").cast("bigint").alias("dateline"),
    )


def click_log(
    table: DataFrame,
    day: str | None = None,
    partitions: int | None = None,
    key: Callable[[Column], Column] = url_key,
    **equals: str,
) -> DataFrame:
    """Clicks from a page slot to an article."""
    clicks = one_day(table, day, **equals)
    clicks = clicks.where(attributable(F.col(CLICK_COLUMNS["typename"]), F.col(CLICK_COLUMNS["url"])))
    return log_rows(clicks, CLICK_COLUMNS, partitions, key)


def view_log(table: DataFrame, day: str | None = None, partitions: int | None = None, **equals: str) -> DataFrame:
    """Impressions of an article in a page slot."""
    return log_rows(one_day(table, day, **equals), VIEW_COLUMNS, partitions)


def live_rooms(table: DataFrame, day: str | None = None, **equals: str) -> DataFrame:
    """Stream address per live room."""
    return one_day(table, day, **equals).select("roomkey", "flvurl")


def position_history(table: DataFrame, sourcetypes: tuple[str, ...], **equals: str) -> DataFrame:
    """Edit history of one source, restricted to its kinds of entry."""
    return one_day(table.where(F.col("sourcetype").isin(*sourcetypes)), **equals)
