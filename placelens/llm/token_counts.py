"""Token counts by source, language and tokenizer version, kept up to date by signed changes.

A change is an insert (adds a document and its tokens to its group), a delete (takes both away from the group they were counted in) or a revision
(takes the old count away from its old group and adds the new one to the new group, which may be of another source, language or tokenizer version).
A batch of changes is summed to one signed row for each group and committed in one step (`sinks.snapshots`): readers see all
of a batch or nothing, a commit that fails leaves what was there, and committing the same batch again replaces it, so a batch counts once however
often it is delivered. Totals are the sum over all batches, and `compacted` folds batches that will not come again into one. No count
is ever taken from all documents again.

Defined results: a null text has no token; null sources, languages and versions are groups of their own; null counts are zero; changes of an unknown
kind are an error; repeated rows count each time; an empty batch commits nothing; groups without documents and tokens are left out; other
columns are not looked at, whatever their names, but for `counted`, which needs a free name for its column.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelens.llm.tokens import encoder
from placelens.sinks import snapshots

KINDS = ("insert", "delete", "revise")
GROUPS = ["source", "lang", "version"]
SCHEMA = "source string, lang string, version string, documents bigint, tokens bigint"


def counted(docs: DataFrame, tokenizer: str, text_col: str = "text", into: str = "tokens") -> DataFrame:
    """`docs` with the number of tokens of its whole text in place of the text, in a column `into` that `docs` must not have."""
    if into.lower() in (name.lower() for name in docs.columns if name != text_col):
        raise ValueError(f"there is a column {into} already")

    @F.pandas_udf("bigint")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoder(tokenizer).encode
        for batch in texts:
            yield pd.Series([len(encode(text or "")) // 2 for text in batch], dtype="int64")

    return docs.withColumn(into, count(F.col(text_col))).drop(text_col)


def signed(changes: DataFrame) -> DataFrame:
    """One signed row per group. `changes`: kind; source, lang, version, tokens (new); old_source, old_lang, old_version, old_tokens."""
    known = F.col("kind").isin(*KINDS)
    kind = F.when(known, F.col("kind")).otherwise(F.raise_error(F.concat(F.lit("unknown change: "), F.coalesce("kind", F.lit("null")))))

    def side(prefix: str, sign: int, without: str):
        groups = [F.col(prefix + name).cast("string").alias(name) for name in GROUPS]
        count = (sign * F.coalesce(F.col(f"{prefix}tokens"), F.lit(0))).cast("bigint").alias("tokens")
        return F.when(kind != without, F.struct(*groups, F.lit(sign).cast("bigint").alias("documents"), count))

    sides = F.array_compact(F.array(side("", 1, "delete"), side("old_", -1, "insert")))
    sums = changes.select(F.inline(sides)).groupBy(*GROUPS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    return sums.where("documents <> 0 OR tokens <> 0")


def commit(changes: DataFrame, rollup: str, batch: str) -> None:
    """Commit a batch in one step; a second delivery replaces the first."""
    snapshots.publish(signed(changes).withColumn("batch", F.lit(batch)), rollup, "batch", [batch])


def deltas(spark: SparkSession, rollup: str) -> DataFrame:
    """All committed rows, with their batch."""
    return snapshots.read(spark, rollup, SCHEMA, part_col="batch")


def totals(spark: SparkSession, rollup: str) -> DataFrame:
    """source, lang, version, documents, tokens over all committed batches."""
    sums = deltas(spark, rollup).groupBy(*GROUPS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
    return sums.where("documents <> 0 OR tokens <> 0")


def compacted(spark: SparkSession, rollup: str, into: str, batch: str = "base") -> None:
    """Commit the totals to another rollup as its first batch; batches folded in must not be delivered to it again."""
    snapshots.publish(totals(spark, rollup).withColumn("batch", F.lit(batch)), into, "batch", [batch])
