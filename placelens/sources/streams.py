"""Unbounded message sources."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def kafka_options(servers: str, topics: str, starting: str = "latest") -> dict[str, str]:
    """Options of the Kafka reader; `topics` is a comma-separated list."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topics, "startingOffsets": starting}


def kafka_rows(stream: DataFrame, positions: bool = False) -> DataFrame:
    """`key, value` as text of rows in the form the Kafka reader gives; with `positions` also `source` (topic and partition) and `position`."""
    where = [F.concat_ws("-", "topic", "partition").alias("source"), F.col("offset").alias("position")] if positions else []
    return stream.select(F.col("key").cast("string"), F.col("value").cast("string"), *where)


def kafka_messages(spark: SparkSession, servers: str, topics: str, starting: str = "latest", positions: bool = False) -> DataFrame:
    """The rows of `kafka_rows`. Needs the Kafka connector package on the session's class path."""
    return kafka_rows(spark.readStream.format("kafka").options(**kafka_options(servers, topics, starting)).load(), positions)


def file_messages(
    spark: SparkSession, path: str, schema: StructType | str, value: str, fmt: str = "parquet", positions: bool = False, **options: str
) -> DataFrame:
    """One message per row of the files that arrive below `path`; with `positions` also `source` (the file) and `position` (the row in it)."""
    stream = spark.readStream.format(fmt).schema(schema).options(**options).load(path)
    where = [F.col("_metadata.file_path").alias("source"), F.col("_metadata.row_index").alias("position")] if positions else []
    return stream.select(F.lit(None).cast("string").alias("key"), F.col(value).alias("value"), *where)
