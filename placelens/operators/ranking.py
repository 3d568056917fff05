"""Largest values and display limits."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_m(df: DataFrame, value: str, m: int) -> DataFrame:
    """The `m` largest values in ascending order, duplicates kept."""
    return df.select(value).where(F.col(value).isNotNull()).orderBy(F.desc(value)).limit(m).orderBy(value)


def top_m_per_group(df: DataFrame, group: list[str], order: list[Column], m: int) -> DataFrame:
    """The first `m` rows of every group; each task cuts its groups to `m` rows before the shuffle."""
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("place", F.row_number().over(window)).where(F.col("place") <= m)


def first_rows(df: DataFrame, order: list[str], n: int = 1000) -> DataFrame:
    """A stable display limit."""
    return df.orderBy(*order).limit(n)
