"""Edit histories turned into validity intervals."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from placelens.functions.dates import day_tag
from placelens.functions.text import java_split

# Fixed value: the edit type that ends an entry.
TOMBSTONE = "delete"


def next_times(history: DataFrame, key: list[str], order: str, tie: str, slice_unit: str = "hour") -> DataFrame:
    """For every distinct key and `order`: the next later one of that key and the greatest `tie`.

    Edits are first collapsed to distinct times with map-side aggregation, so copies of one edit cost
    nothing. The times of a key are then cut into calendar slices; each slice is a window group of its
    own and gets the first time of the following slice as a marker row. A key that holds most of the
    history is thereby sorted by many tasks.
    """
    times = (
        history.groupBy(*key, order)
        .agg(F.max(tie).alias("_last"))
        .withColumn("_slice", F.date_trunc(slice_unit, order))
    )
    # Carrying the tie along keeps both uses of `times` alike, so its shuffle is done once and read twice.
    heads = times.groupBy(*key, "_slice").agg(F.min(order).alias("_head"), F.max("_last").alias("_last"))
    next_slice = F.lead("_head").over(Window.partitionBy(*key).orderBy("_slice"))
    markers = heads.select(*key, next_slice.alias(order), "_last", "_slice").where(F.col(order).isNotNull())
    marked = times.withColumn("_marker", F.lit(False)).unionByName(markers.withColumn("_marker", F.lit(True)))
    following = F.lead(order).over(Window.partitionBy(*key, "_slice").orderBy(order))
    return marked.withColumn("_next", following).where(~F.col("_marker")).select(*key, order, "_last", "_next")


def version_intervals(
    history: DataFrame,
    key: str | list[str] = "id",
    order: str = "modifydate",
    start: str = "starttime",
    end: str = "endtime",
    tie: str = "seq",
    slice_unit: str = "hour",
) -> DataFrame:
    """Add `real_starttime`, `real_endtime` and their day tags to every version of an edit history.

    A version is in force from the later of its planned start and its edit time, until its planned end
    or the next edit of the same key, whichever comes first. Among edits at the same instant the
    greatest `tie` is the newest. Empty and inverted intervals are kept. Deletes stay in the result so
    that they end the version before them; see `drop_tombstones`.
    """
    key = [key] if isinstance(key, str) else key
    versions = history.join(next_times(history, key, order, tie, slice_unit), [*key, order], "left")
    return version_bounds(versions, order, start, end, tie)


def version_bounds(versions: DataFrame, order: str, start: str, end: str, tie: str) -> DataFrame:
    """Intervals and day tags of versions that have `_last`, the greatest tie of their instant, and `_next`, the next one (see `next_times`)."""
    next_edit = F.when(F.col(tie) < F.col("_last"), F.col(order)).otherwise(F.col("_next"))
    bounds = {"real_starttime": F.greatest(start, order), "real_endtime": F.least(F.col(end), next_edit)}
    tags = {"real_startdate": day_tag("real_starttime"), "real_enddate": day_tag("real_endtime")}
    return versions.withColumns(bounds).withColumns(tags).drop("_last", "_next")


def drop_tombstones(versions: DataFrame, optype: str = "optype") -> DataFrame:
    """Remove deletes; only right after `version_intervals`. An unknown edit type is no delete."""
    return versions.where(~F.col(optype).eqNullSafe(TOMBSTONE))


def explode_list(versions: DataFrame, values: str = "newstype", into: str = "typeid") -> DataFrame:
    """One row per element of a comma-separated list."""
    return versions.withColumn(into, F.explode(java_split(F.col(values), ",")))


def union_histories(*histories: DataFrame) -> DataFrame:
    """Stack sources, duplicates kept, and number them in `source`.

    Equal ids of two sources are different entries: use `source` as part of the key.
    """
    numbered = (history.withColumn("source", F.lit(number)) for number, history in enumerate(histories))
    return reduce(DataFrame.unionByName, numbered)


def started_on(versions: DataFrame, day: str | Column) -> DataFrame:
    return versions.where(F.col("real_startdate") == day)
