"""Replace the rows of some day-hours of a result, leave all others untouched."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from placelens.operators.observed import observed
from placelens.session import delete_folder

# The columns that identify a replaceable part, and the result columns in table order.
PART_KEYS = ["dt", "hour"]
RESULT_COLUMNS = ["dt", "hour", "urltype", "url", "title", "rate"]

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"


def result_rows(enriched: DataFrame) -> DataFrame:
    """The enriched scores under the column names of the result table."""
    return enriched.withColumnRenamed("type1", "urltype").select(*RESULT_COLUMNS)


def replace_parts(df: DataFrame, path: str, keys: list[str] = PART_KEYS) -> None:
    """Overwrite exactly the partitions present in `df`.

    Running it again gives the same table. The rebalance groups rows by partition for few files and
    lets adaptive execution cut a partition that is too large for one task.
    """
    balanced = df.hint("rebalance", *(F.col(key) for key in keys))
    (
        balanced.write.partitionBy(*keys)
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(path)
    )


def replace_one_part(df: DataFrame, path: str, part: dict[str, str]) -> int:
    """Replace one known partition, also when the new rows are none; how many they are.

    The old rows stay until the new ones are written; a write that fails leaves them. Rows are counted while they are written, so
    they are computed once; only if there were none is the partition deleted.
    """
    seen = Observation()
    rows = df.withColumns({key: F.lit(value) for key, value in part.items()}).observe(seen, F.count(F.lit(1)).alias("rows"))
    replace_parts(rows, path, list(part))
    count = observed(seen).get("rows", 0)
    if not count:
        delete_folder(df.sparkSession, "/".join([path, *(f"{key}={value}" for key, value in part.items())]))
    return count


def new_table(df: DataFrame, table: str, keys: list[str], buckets: int = 0, bucket_by: list[str] | None = None) -> str:
    """A catalogue table of the rows of `df`, partitioned by `keys`, which become its last columns; its name.

    With `buckets` its files are cut and sorted by `bucket_by`: joins and groupings on those columns need no shuffle of the table.
    """
    writer = df.write.partitionBy(*keys) if keys else df.write
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(table)
    return table


def replace_in_table(df: DataFrame, table: str) -> None:
    """The same for a partitioned catalogue table, columns matched by position.

    Inserts into a table take the overwrite mode from the session, so it is set for this write only.
    """
    conf = df.sparkSession.conf
    before = conf.get(OVERWRITE_MODE)
    conf.set(OVERWRITE_MODE, "dynamic")
    try:
        df.write.insertInto(table, overwrite=True)
    finally:
        conf.set(OVERWRITE_MODE, before)
