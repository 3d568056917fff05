"""Near duplicates by SimHash fingerprints and multi-index hashing.

A fingerprint is made of a document's shingles, repeats included: a bit is 1 if it is set in over half of their 64-bit
hashes. Fingerprints link at `bits` or fewer differing bits; documents with linked fingerprints are one component.

Links are found among distinct fingerprints, so copies cost nothing. The 64 bits are cut into segments, one hash table
for each segment. If two fingerprints differ in at most `bits` = segments * a + b bits, then one of the
first b + 1 segments differs in at most a bits, or one of the others in at most a - 1. So every fingerprint is stored in each table
under its own segment, enumerates the small Hamming ball around that segment, fetches the matches and verifies
the complete distance. Of a ball only the segments above the own one are looked up: the pair is found from its other end.
How many segments are best hangs on the number of fingerprints alone; any number finds every link. The look-ups grow with it, slowly: 281 rows a
fingerprint at a thousand million fingerprints.

Buckets of more than `BUSY` fingerprints are not paired up. Two fingerprints at `bits` = 4 or fewer differing bits have a point
between them that is at most 2 bits from either, so each member of a busy bucket emits the ball around its other bits (radius 2,
less for fingerprints that looked the bucket up from a distance), and all that share a point are linked to the smallest of them.
Everything that shares a point is within `bits` of each other, so that is exact as well, and grows linearly with the bucket.

Defined results: null and empty texts (and texts of white space) have fingerprint zero and link like any other; texts with fewer
words than a shingle are one shingle; null ids are members of their component, whose id is the smallest id that is not null
(null if there is none); repeated rows have one result each; an empty table gives no rows; other columns are not looked at,
whatever their names.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from placelens.llm.common import fresh_name, measured_join, one_row_each, row_digest, stored
from placelens.llm.components import components

SHINGLE = 4
BITS = 4
SEED = 42
BUSY = 2000
CHUNK = 65_536


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as an unsigned number. Words are what ASCII white space separates; only A-Z is lower-cased."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    size = min(shingle, len(words))
    first = np.concatenate([[0], ends[: len(words) - size]]).tolist()
    last = (ends[size - 1 :] - 1).tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(first), CHUNK):
        hashes = [digest(line[i:j], SEED) for i, j in zip(first[at : at + CHUNK], last[at : at + CHUNK])]
        lanes = np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(lanes, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(first)).tobytes(), "big")


def _signed(number: int) -> int:
    return number - 2**64 if number >= 2**63 else number


def fingerprints(docs: DataFrame, columns: list, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """`columns` of `docs` and `print`, the fingerprint as a signed 64-bit number."""

    @F.pandas_udf("long")
    def prints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([_signed(fingerprint(text, shingle)) for text in batch], dtype="int64")

    return docs.select(*columns, prints(F.col(text_col)).alias("print"))


def segments(count: int, bits: int = BITS) -> list[tuple[int, int, int]]:
    """(first bit, width, radius) of each segment; as many as make the fewest look-ups and candidates for `count` fingerprints."""

    def plan(number):
        edges = [64 * i // number for i in range(number + 1)]
        a, b = divmod(bits, number)
        return [(edges[i], edges[i + 1] - edges[i], a if i <= b else a - 1) for i in range(number) if i <= b or a > 0]

    def cost(parts):
        balls = [(sum(len(list(combinations(range(width), r))) for r in range(radius + 1)), width) for _, width, radius in parts]
        return sum(count * ball / 2 + count**2 * ball / 2 / 2**width for ball, width in balls)

    return min((plan(number) for number in range(2, bits + 2)), key=cost)


def _masks(width: int, radius: int) -> np.ndarray:
    """All numbers of `width` bits with at most `radius` bits set, and how many are set."""
    found = [(sum(1 << bit for bit in some), r) for r in range(radius + 1) for some in combinations(range(width), r)]
    return np.array(found, dtype=np.int64).reshape(-1, 2)


def _looked_up(prints: DataFrame, parts: list[tuple[int, int, int]]) -> DataFrame:
    """Rows (part, key, print, far): far 0 for the bucket a print is stored in, else the bits it is away from the bucket."""
    masks = [_masks(width, radius) for _, width, radius in parts]

    def look_up(batches):
        for batch in batches:
            values = batch["print"].to_numpy().view(np.uint64)
            for part, ((first, width, _), mask) in enumerate(zip(parts, masks)):
                own = ((values >> np.uint64(first)) & np.uint64((1 << width) - 1)).astype(np.int64)
                step = max(1, CHUNK // len(mask))
                for at in range(0, len(own), step):
                    keys = own[at : at + step, None] ^ mask[None, :, 0]
                    row, column = np.nonzero(keys >= own[at : at + step, None])
                    yield pd.DataFrame(
                        {
                            "part": np.full(len(row), part, np.int32),
                            "key": keys[row, column],
                            "print": values[at + row].view(np.int64),
                            "far": mask[column, 1].astype(np.int32),
                        }
                    )

    return prints.mapInPandas(look_up, "part int, key bigint, print bigint, far int")


def _points(members: DataFrame, parts: list[tuple[int, int, int]], bits: int) -> DataFrame:
    """The balls of the members of busy buckets: part, key, point, print."""
    half = bits // 2
    rest = [[bit for bit in range(64) if not first <= bit < first + width] for first, width, _ in parts]

    def emit(batches):
        for batch in batches:
            for (part, far), some in batch.groupby(["part", "far"]):
                spread = np.array(
                    [sum(1 << bit for bit in c) for r in range(half - far + 1) for c in combinations(rest[part], r)] if far <= half else [],
                    dtype=np.uint64,
                )
                first, width, _ = parts[part]
                clear = np.uint64((2**64 - 1) ^ (((1 << width) - 1) << first))
                values = some["print"].to_numpy().view(np.uint64)
                step = max(1, CHUNK // max(1, len(spread)))
                for at in range(0, len(values), step):
                    points = ((values[at : at + step, None] & clear) ^ spread[None, :]).ravel()
                    yield pd.DataFrame(
                        {
                            "part": np.full(len(points), part, np.int32),
                            "key": np.repeat(some["key"].to_numpy()[at : at + step], len(spread)),
                            "point": points.view(np.int64),
                            "print": np.repeat(values[at : at + step].view(np.int64), len(spread)),
                        }
                    )

    return members.mapInPandas(emit, "part int, key bigint, point bigint, print bigint")


def links(prints: DataFrame, bits: int = BITS, busy: int = BUSY) -> DataFrame:
    """Edges (a, b) between distinct `print`s at `bits` or fewer differing bits; within busy buckets stars that connect the same."""
    if bits % 2:
        raise ValueError("an odd distance has no middle; busy buckets need an even one")
    parts = segments(prints.count(), bits)
    rows = stored(_looked_up(prints, parts), "lookups")
    sizes = rows.groupBy("part", "key").agg(F.count("*").alias("rows"), F.min("far").alias("near"))
    shared = stored(sizes.where("rows > 1 AND near = 0"), "buckets")
    pairs = measured_join(rows, shared.where(F.col("rows") <= busy).select("part", "key"), ["part", "key"])
    here = pairs.where("far = 0").select("part", "key", F.col("print").alias("b"))
    close = F.bit_count(F.col("print").bitwiseXOR(F.col("b"))) <= bits
    found = pairs.join(here, ["part", "key"]).where(((F.col("far") > 0) | (F.col("print") > F.col("b"))) & close)
    edges = found.select(F.greatest("print", "b").alias("a"), F.least("print", "b").alias("b"))
    crowded = shared.where(F.col("rows") > busy).select("part", "key")
    if crowded.isEmpty():
        return edges
    points = _points(measured_join(rows, crowded, ["part", "key"]), parts, bits)
    low = points.groupBy("part", "key", "point").agg(F.min("print").alias("low"), F.max("print").alias("high")).where("low < high")
    stars = points.join(low, ["part", "key", "point"]).where("print > low").select(F.col("print").alias("a"), F.col("low").alias("b"))
    return edges.unionByName(stars.distinct())


def _rooted(rows: DataFrame, bits: int, busy: int) -> DataFrame:
    """(print, root) for the prints of `rows` that have a link to another print."""
    distinct = stored(rows.select("print").distinct(), "prints")
    return components(links(distinct, bits, busy)).withColumnRenamed("node", "print")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS, busy: int = BUSY
) -> DataFrame:
    """One row per document: id, print (signed), component_id (the smallest id it can reach)."""
    rows = stored(fingerprints(docs, [F.col(id_col).alias("id")], text_col, shingle), "fingerprints")
    rooted = stored(_rooted(rows, bits, busy), "rooted")
    grouped = measured_join(rows, rooted, "print", "left").withColumn("root", F.coalesce("root", "print"))
    least = grouped.groupBy("root").agg(F.min("id").alias("component_id"))
    return measured_join(grouped, least, "root").select("id", "print", "component_id")


def survivors(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, bits: int = BITS, busy: int = BUSY
) -> DataFrame:
    """The rows of `docs` that stay: one for each component, that with the smallest id (null last, then the smallest row digest)."""
    key = fresh_name(docs, "_row")
    named = [F.col(id_col).alias("id"), row_digest(docs).alias("row")]
    rows = stored(fingerprints(docs, named, text_col, shingle), "fingerprints")
    rooted = stored(_rooted(rows, bits, busy), "rooted")
    grouped = measured_join(rows, rooted, "print", "left").withColumn("root", F.coalesce("root", "print"))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("row").alias("row")))
    wanted = stored(grouped.groupBy("root").agg(first.alias("first")).select(F.col("first.row").alias(key)), "wanted")
    return one_row_each(docs.withColumn(key, row_digest(docs)), wanted, key).drop(key)
