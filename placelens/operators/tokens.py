"""Token counts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.functions.text import java_split


def token_count(messages: DataFrame, value: str = "value") -> DataFrame:
    """Occurrences of every space-separated token; leading and inner empty tokens count."""
    tokens = messages.select(F.explode(java_split(F.col(value), " ")).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"))
