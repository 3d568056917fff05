"""Scores enriched from several catalogues in order of priority."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelens.operators.joins import fits_broadcast, repeat_rows, sized


def catalogue_winners(
    catalogues: list[DataFrame], dedup: bool = False, keep_empty: bool = False
) -> tuple[DataFrame, bool]:
    """Per `urlid`, the rows of the first catalogue that holds it, with the number of times each counts.

    Also tells whether all catalogues together, and so the winners, are small enough to broadcast.

    A left join of every catalogue in turn would repeat a winning row once for each combination of
    rows the other catalogues hold under that id. `repeats` is that number, from counts alone.

    All rows whose URL has no id share the empty one, and say nothing about each other. They are left out unless
    `keep_empty` is set, which repeats a score with an empty id for every combination of them.
    """
    known = F.lit(True) if keep_empty else F.col("urlid") != ""
    ranked = [
        catalogue.where(known).select("urlid", "title", "typepy", "url", F.lit(rank).alias("rank"))
        for rank, catalogue in enumerate(catalogues)
    ]
    if dedup:
        ranked = [
            part.groupBy("urlid", "rank").agg(F.min(F.struct("title", "typepy", "url")).alias("_row"))
            .select("urlid", "_row.*", "rank")
            for part in ranked
        ]
    stacked = reduce(DataFrame.unionByName, ranked)
    fits = fits_broadcast(stacked)
    counts = stacked.groupBy("urlid").agg(
        F.min("rank").alias("rank"),
        *(F.count_if(F.col("rank") == rank).alias(f"_n{rank}") for rank in range(len(catalogues))),
    )
    others = (
        F.when(F.col("rank") == rank, F.lit(1)).otherwise(F.greatest(F.lit(1), F.col(f"_n{rank}")))
        for rank in range(len(catalogues))
    )
    best = counts.select("urlid", "rank", reduce(Column.__mul__, others).alias("repeats"))
    return stacked.join(sized(best, fits), ["urlid", "rank"]), fits


def priority_enrich(
    scores: DataFrame, catalogues: list[DataFrame], dedup: bool = False, keep_empty: bool = False
) -> DataFrame:
    """Add title, type and URL to `dt, hour, url, rate`, where `url` is a content id.

    The first catalogue holding the id decides, even where its values are NULL. An id no catalogue
    knows keeps NULL title and type and stands in for its own URL; so does the empty id, unless `keep_empty` is set.
    """
    winners, fits = catalogue_winners(catalogues, dedup, keep_empty)
    winners = winners.withColumnRenamed("url", "_url")
    ids = scores.withColumnRenamed("url", "urlid")
    joined = ids.join(sized(winners, fits), "urlid", "left")
    repeated = repeat_rows(joined, F.coalesce("repeats", F.lit(1).cast("bigint")))
    known = F.col("rank").isNotNull()
    return repeated.select(
        "dt",
        "hour",
        "title",
        F.col("typepy").alias("type1"),
        F.when(known, F.col("_url")).otherwise(F.col("urlid")).alias("url"),
        "rate",
    )
