"""Exact duplicates: local, salted and global combining, with DataFrame functions only.

Texts are equal if they agree after lower-casing A-Z. Three stages combine them, and each one groups by the whole
normalised text next to its digest, so that equal digests alone never make two texts equal:

1. every task combines the equal texts it has read (the partial aggregation in front of the first shuffle);
2. groups meet by digest and salt, the salt being the reading task's number, so that a text that makes up a
   third of all rows is spread over `salts` tasks;
3. the at most `salts` winners of a text meet by digest.

Verdicts go back to the rows by digest. Should two texts ever share a digest, the join compares their texts too.

Defined results: a null text is the empty text; a null id is smaller than every other id, and a group of null ids
only has a null `keep_id`; repeated rows (equal id, equal text) get the same verdict each, and `survivors` leaves one
of them; an empty table gives no rows; other columns are not looked at, whatever their names.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.llm.common import fresh_name, measured_join, one_row_each, plain_lower, row_digest, stored

SALTS = 64


def _digested(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    content = docs.select(F.col(id_col).alias("id"), plain_lower(F.col(text_col)).alias("content"), *more)
    return content.withColumn("digest", F.sha2(F.col("content").cast("binary"), 256))


def groups(rows: DataFrame, best: list[str], salts: int = SALTS) -> DataFrame:
    """One row per text: digest, best (struct of the columns `best`, the largest), group_size; content where digests clash.

    `rows` has content and digest. The result is stored.
    """
    local = rows.select(
        "digest", "content", F.struct(*best).alias("best"), (F.spark_partition_id() % salts).alias("salt")
    )
    salted = local.groupBy("digest", "salt", "content").agg(F.max("best").alias("best"), F.count("*").alias("size"))
    # Rows that meet by digest also meet by digest and content: one shuffle serves both groupings.
    whole = salted.repartition("digest").groupBy("digest", "content").agg(F.max("best").alias("best"), F.sum("size").alias("group_size"))
    per_digest = whole.groupBy("digest").agg(
        F.collect_list(F.struct("best", "group_size", "content")).alias("found")  # one entry, unless digests clash
    )
    found = per_digest.select("digest", F.size("found").alias("rivals"), F.explode("found").alias("f"))
    slim = found.select("digest", "f.best", "f.group_size", F.when(F.col("rivals") > 1, F.col("f.content")).alias("content"))
    return stored(slim, "dedup")


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, keep_id, group_size, kept, text_sha256 (of the normalised text)."""
    rows = _digested(docs, id_col, text_col)
    found = groups(rows, ["id"]).select(
        F.col("digest").alias("_digest"), F.col("best.id").alias("keep_id"), "group_size", F.col("content").alias("_content")
    )
    same = F.col("digest") == F.col("_digest")
    if found.where(F.col("_content").isNotNull()).isEmpty():
        rows, found = rows.drop("content"), found.drop("_content")
    else:
        same = same & F.coalesce(F.col("content") == F.col("_content"), F.lit(True))
    return measured_join(rows, found, same).select(
        "id",
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def survivors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay: one for each text, that with the largest id (then the largest row digest)."""
    rows = _digested(docs, id_col, text_col, row_digest(docs).alias("row"))
    key = fresh_name(docs, "_row")
    wanted = groups(rows, ["id", "row"]).select(F.col("best.row").alias(key))
    return one_row_each(docs.withColumn(key, row_digest(docs)), wanted, key).drop(key)
