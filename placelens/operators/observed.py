"""Counts taken in the pass that does the work, instead of by jobs of their own."""

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def kept_and_dropped(rows: DataFrame, keeps: Column, seen: Observation | None) -> DataFrame:
    """`rows`, counted while they are computed: how many meet `keeps` (`kept`) and how many don't (`dropped`)."""
    if seen is None:
        return rows
    keeps = F.coalesce(keeps, F.lit(False))
    return rows.observe(seen, F.count_if(keeps).alias("kept"), F.count_if(~keeps).alias("dropped"))


def observed(seen: Observation) -> dict[str, int]:
    """What was counted; ask after the action. Nothing where Spark knew without computing that there were no rows."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" not in error.java_exception.toString():
            raise
        return {}
