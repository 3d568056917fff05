"""Helpers the operators share: stored tables, row identity, ranks over a whole table."""

import math
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from placelens.operators.joins import fits_broadcast, sized
from placelens.session import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = "[^\\x20\\x09-\\x0D]+"
BUCKET_ROWS = 20_000
RANGE_ROWS = 100_000


def importable(spark: SparkSession) -> None:
    """Let Python workers started beside the driver import this package, as `--py-files` does on a cluster."""
    here = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if here not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{known}:{here}".strip(":")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder, compressed well, and read it back.

    Cuts lineage: whatever reads the result survives lost executors without computing `df` again. `session.remove_written`
    deletes the folder once the results are complete.
    """
    return written(df, name, compression="zstd")


def measured_join(rows: DataFrame, side: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with `side` broadcast if its measured size allows it, else by a sort-merge join that splits busy keys."""
    return rows.join(sized(side, fits_broadcast(side)), on, how)


def plain_lower(text: Column) -> Column:
    """Lower-case A-Z only; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def word_count(text: Column) -> Column:
    """How many runs of characters other than space and \\x09-\\x0D `text` has; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def row_digest(df: DataFrame) -> Column:
    """A 128-bit digest of all columns of a row: equal for rows that agree in every column."""
    return F.md5(F.to_json(F.struct(*(F.col(f"`{name}`") for name in df.columns))).cast("binary"))


def fresh_name(df: DataFrame, name: str) -> str:
    """`name`, with as many underscores in front as it takes to be no column of `df`."""
    taken = {column.lower() for column in df.columns}
    while name in taken:
        name = "_" + name
    return name


def one_row_each(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows whose `key` is in `wanted` (distinct keys); of rows that share a key, one.

    Rows share a key only if they agree in every column, so it does not matter which one stays. They are rare:
    the whole rows are shuffled again only for such keys, and only if there are any.
    """
    hits = measured_join(rows, wanted, key, "left_semi")
    repeated = stored(hits.groupBy(key).count().where("count > 1").select(key), "repeated")
    if repeated.isEmpty():
        return hits
    once = measured_join(hits, repeated, key, "left_anti")
    return once.unionByName(measured_join(hits, repeated, key, "left_semi").dropDuplicates([key]))


def bucket_count(rows: int) -> int:
    return max(1, math.ceil(rows / BUCKET_ROWS))


def group_key(column: Column) -> Column:
    """A key without nulls for a nullable column; null has a key of its own, and sorts first."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def line_up(rows: DataFrame, order: list[str], weight: str, place: str) -> DataFrame:
    """`rows` with `place`: the sum of `weight` over all rows before, in the order of the columns `order`, which must tell all rows apart.

    A range sort, whose sums are added up by range first (one row for each) and then within each range. A range holds
    about `RANGE_ROWS` rows whatever the values are, as long as few rows share them all.
    """
    ranges = max(1, -(-rows.count() // RANGE_ROWS), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = stored(rows.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    sums = ranged.groupBy("_range").agg(F.sum(weight).alias("_sum"))
    starts = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = measured_join(ranged, starts, "_range")
    return joined.withColumn(place, F.col("_start") + F.coalesce(F.sum(weight).over(inside), F.lit(0))).drop("_range", "_start")


def running_total(df: DataFrame, groups: list[str], bucket: str, order: list[Column], weight: str, total: str) -> DataFrame:
    """Add `total`: the sum of `weight` over the rows of the group before this one, in `bucket`, then `order`.

    No task holds a whole group: bucket sums are added up first (one row for each bucket), then every bucket
    adds its own rows. `groups` and `bucket` must not be null, and `bucket` must follow `order`.
    """
    sums = df.groupBy(*groups, bucket).agg(F.sum(weight).alias("_sum"))
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*groups, bucket, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*groups, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = df.join(starts, [*groups, bucket])
    return joined.withColumn(total, F.col("_start") + F.coalesce(F.sum(weight).over(inside), F.lit(0))).drop("_start")
