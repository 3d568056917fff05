"""Text tables stored in one folder per day or hour."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from placelens.functions.dates import day_tags

LINES = "value string, dt string"


def partitions(spark: SparkSession, root: str, tags: list[str]) -> DataFrame:
    """Lines of the folders `dt=<tag>` that exist, with their tag.

    The tags go into the path pattern, so only these folders are listed however many the table has.
    No matching folder gives an empty result; a root that does not exist is an error.
    """
    pattern = f"{root.rstrip('/')}/dt={{{','.join(tags)}}}"
    try:
        return spark.read.schema(LINES).option("basePath", root).text(pattern)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        context = spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(root)
        if not place.getFileSystem(context._jsc.hadoopConfiguration()).exists(place):
            raise
        return spark.createDataFrame([], LINES)


def day_range(spark: SparkSession, root: str, day: str, back: int = 4) -> DataFrame:
    """Lines of `day` and the `back` days before it; missing days are skipped."""
    return partitions(spark, root, day_tags(day, back))


def one_hour(spark: SparkSession, root: str, run: str) -> DataFrame:
    """Lines of the hour yyyyMMddHH; a missing hour is an error."""
    return spark.read.schema(LINES).option("basePath", root).text(f"{root.rstrip('/')}/dt={run[:10]}")
