"""Joins whose broadcast side is measured, and row repetition."""

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BROADCAST_BYTES = 64 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """The payload of one row in memory, as an expression. Columns must be numbers, dates, times, text or binary."""
    size = F.lit(16 * (len(df.columns) + 1))
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(name), F.lit(0))
    return size.cast("bigint")


def measurable(df: DataFrame) -> bool:
    """Whether `row_bytes` knows every column's size; arrays, maps, structs and the like have no bound."""
    flat = r"string|binary|boolean|tinyint|smallint|int|bigint|float|double|decimal\(.*|date|timestamp.*|void|interval.*"
    return all(re.fullmatch(flat, kind) for _, kind in df.dtypes)


def fits_broadcast(df: DataFrame, copies: Column | None = None, limit: int | None = None) -> bool:
    """Whether the rows of `df`, each counted `copies` times, measure at most `limit` bytes (`BROADCAST_BYTES` without one).

    One aggregate with one row to the driver; no estimate is involved. Rows with a column that can't be measured never fit.
    """
    if not measurable(df):
        return False
    size = row_bytes(df) if copies is None else row_bytes(df) * copies
    return (df.agg(F.sum(size)).first()[0] or 0) <= (BROADCAST_BYTES if limit is None else limit)


def sized(side: DataFrame, fits: bool) -> DataFrame:
    """The smaller side of a join, marked by its measured size.

    A side that fits is broadcast, so the other one is not shuffled at all. Otherwise both meet in a
    sort-merge join, in which adaptive execution splits the partitions of a busy key among several tasks;
    without that mark Spark might still broadcast the side on the strength of an estimate.
    """
    return F.broadcast(side) if fits else side.hint("merge")


def match_keys(rows: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal `keys`, taken from a side that holds no NULL in them.

    There null-safe equality says the same as `=`, and NULL in `rows` matches nothing. But `=` would have Spark test the
    keys of `rows` for NULL below the projection that computes them, and so compute a URL key three
    times per row.
    """
    named = rows.withColumnsRenamed({key: f"_{key}" for key in keys})
    equal = reduce(Column.__and__, (F.col(f"_{key}").eqNullSafe(F.col(key)) for key in keys))
    return named.join(side, equal).drop(*(f"_{key}" for key in keys))


def repeat_rows(df: DataFrame, times: Column, step: int = 4096) -> DataFrame:
    """Emit every row `times` times, in two steps so that no row needs a long array."""
    whole = F.floor((times - 1) / step)
    steps = df.withColumn("_times", times).withColumn("_step", F.explode(F.sequence(F.lit(0).cast("bigint"), whole)))
    rest = F.least(F.lit(step).cast("bigint"), F.col("_times") - F.col("_step") * step)
    return steps.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), rest))).drop("_times", "_step", "_copy")
