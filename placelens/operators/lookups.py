"""Left lookups that fall back to the looked-up value itself."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.functions.urls import SLOT_ID_DIGITS, url_id
from placelens.operators.joins import fits_broadcast, sized


def one_per_key(lookup: DataFrame, key: str) -> DataFrame:
    """Keep the least row of every key."""
    others = [name for name in lookup.columns if name != key]
    return lookup.groupBy(key).agg(F.min(F.struct(*others)).alias("_row")).select(key, "_row.*")


def lookup_fallback(
    df: DataFrame, lookup: DataFrame, key: str, name: str, into: str | None = None, dedup: bool = False
) -> DataFrame:
    """Add `into`: the lookup's `name` for `key`, or the key itself where the lookup has none.

    Repeated lookup keys repeat rows unless `dedup` is set. The lookup is measured when the join is built.
    """
    names = lookup.select(F.col(key), F.col(name).alias("_name"))
    if dedup:
        names = one_per_key(names, key)
    joined = df.join(sized(names, fits_broadcast(names)), key, "left")
    return joined.withColumn(into or name, F.coalesce("_name", key)).drop("_name")


def resolve_rooms(slots: DataFrame, rooms: DataFrame, digits: int = SLOT_ID_DIGITS, dedup: bool = False) -> DataFrame:
    """Replace live-room keys in `content` by their stream address, add `url`.

    `rooms` holds `roomkey, flvurl`, already filtered to the day and application. Other content is
    reduced to the id in its URL and keeps the full text in `url`.
    """
    streams = rooms.select(F.col("roomkey").alias("content"), F.col("flvurl").alias("_stream"))
    if dedup:
        streams = one_per_key(streams, "content")
    joined = slots.join(sized(streams, fits_broadcast(streams)), "content", "left")
    found = {
        "url": F.coalesce("_stream", "content"),
        "content": F.coalesce("_stream", url_id(F.col("content"), digits)),
    }
    return joined.withColumns(found).drop("_stream")
