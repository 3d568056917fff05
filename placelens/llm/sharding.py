"""Shards that all match the mixture: proportional stratified interleaving.

Rows of each stratum are put in a seeded random order; a row's fractional rank is its place in there between 0 and 1.
Sorted by fractional rank, every stretch of the whole table holds each stratum in proportion, so equal cuts of it
are shards with the mixture of the whole. Row counts of shards differ by one at most (law `rows`).

No stratum is held by one task: rows stand in two range sorts, by (stratum, seeded order) for their ranks and by (fractional rank, stratum) for
their places, neither of which two rows share; see `common.line_up`. Texts never leave the scan; what is shuffled is id, size and checksum.

Defined results: a null text has no bytes; a null stratum is a stratum of its own, the last; rows that agree in id and
text are interchangeable; an empty table gives no rows; other columns are not looked at, whatever their names.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.llm.common import group_key, line_up, measured_join, stored


def interleave(
    docs: DataFrame, shards: int, stratum_col: str = "source", id_col: str = "doc_id", text_col: str = "text", seed: int = 7
) -> DataFrame:
    """One row per document: id, stratum, size, text_crc32, shard (from 0), slot (gapless from 0 in each shard)."""
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = stored(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(stratum_col).cast("string").alias("stratum"),
            (F.octet_length(text) + 1).cast("bigint").alias("size"),
            F.crc32(text).alias("text_crc32"),
        ).withColumns({"mixed": F.xxhash64(F.lit(seed), "id", "text_crc32", "size"), "row": F.monotonically_increasing_id()}),
        "shard-rows",
    )
    total = rows.count()
    # Null is the last stratum. Rows that agree in everything are told apart by where they stand.
    order = ["unnamed", "stratum", "mixed", "id", "text_crc32", "size", "row"]
    cells = rows.withColumns({"key": group_key(F.col("stratum")), "unnamed": F.col("stratum").isNull(), "one": F.lit(1).cast("bigint")})
    ranked = stored(line_up(cells, order, "one", "rank"), "ranked")
    strata = ranked.groupBy("key").agg(F.count("*").alias("n"), F.min("rank").alias("first"))
    fraction = (F.col("rank") - F.col("first") + 0.5) / F.col("n")
    placed = measured_join(ranked, strata, "key").withColumn("fraction", fraction).drop("rank", "n", "first", "row")
    lined = line_up(placed, ["fraction", "unnamed", "stratum"], "one", "place")
    shard = F.floor(F.col("place") * shards / F.lit(max(total, 1)))
    start = -F.floor(-F.col("shard") * F.lit(total) / F.lit(shards))
    return lined.withColumn("shard", shard.cast("int")).select(
        "id", "stratum", "size", "text_crc32", "shard", (F.col("place") - start).cast("bigint").alias("slot")
    )
