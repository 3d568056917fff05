"""Near-duplicate vectors of one label, by hashing to points of the lattice E8 and verifying cosines.

A random projection takes vectors of length one to `lattices` spaces of eight numbers; in each, the nearest point of the lattice E8 (in steps of `width`) is
the vector's cell. E8 packs eight dimensions as tightly as can be, so its cells are nearly round and a close pair is seldom parted.
A vector is entered in its own cell and in every neighbouring cell (one of 240) whose border is within `reach`; the cells of all lattices together are one
entry of a table, and there are `tables` such tables with projections of their own. Vectors of a label that share an entry are compared by
exact cosine, and a pair that shares several entries is counted in the smallest of them only.

What the shuffle carries: vectors equal in label and every component are one class first, counted. Entries of one class alone are
dropped before vectors are attached. Small entries meet in tasks of about `TASK_ROWS` rows; an entry of more than `BLOCK` classes is cut into blocks, and
every two blocks are a task. Tasks give back a count and the local component of each linked class, never pairs, so
the output is linear even where thousands of vectors are near each other. Rows times entries (about five a table) is the most that is shuffled.

On 6,000 random vectors of 64 numbers, the share of pairs found at a cosine of exactly 0.98, 0.985 and 0.99 is 0.9993, 0.9998 and 1.0 with two lattices
and two tables; a vector has ten entries on average and meets one in 340 of the others. More lattices (and tables) make entries smaller.

Defined results: vectors that are null, empty, zero or hold null or non-finite components and rows whose label is null have no links and are their own
component; vectors of different length are never compared; equal vectors are linked, also rows repeated as a whole, and count each; a row with a null id counts as a vector,
its component has the smallest id that is not null, and it is never kept; an empty table gives no rows; other columns are not looked at, whatever their names.
"""

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelens.llm.ann import scaled
from placelens.llm.common import measured_join, stored
from placelens.llm.components import components

COSINE = 0.98
LATTICES, TABLES = 2, 2
WIDTH, REACH = 0.8, 0.06
BLOCK, TASK_ROWS = 1024, 4096
SEED = 8
#: Rough cosines this close to the threshold are decided by the exact formula.
SLACK = 1e-9


@cache
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: two ones of either sign, or eight halves with an even number of minus signs."""
    ones = [
        [sign if at == i else other if at == j else 0 for at in range(8)]
        for i, j in itertools.combinations(range(8), 2)
        for sign, other in itertools.product((1, -1), repeat=2)
    ]
    halves = [half for half in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in half) % 2 == 0]
    return np.array(ones + halves)


def _nearest_even(points: np.ndarray) -> np.ndarray:
    """The nearest points of whole numbers with an even sum."""
    whole = np.rint(points)
    error = points - whole
    rows = np.flatnonzero(whole.sum(axis=1) % 2)
    worst = np.abs(error[rows]).argmax(axis=1)
    whole[rows, worst] += np.where(error[rows, worst] >= 0, 1, -1)  # the cheapest other rounding
    return whole


def nearest_e8(points: np.ndarray) -> np.ndarray:
    """The nearest point of E8 to each row of eight numbers: E8 is the even whole points and the same moved by a half."""
    whole, half = _nearest_even(points), _nearest_even(points - 0.5) + 0.5
    return np.where((((points - whole) ** 2).sum(axis=1) <= ((points - half) ** 2).sum(axis=1))[:, None], whole, half)


@cache
def _projections(size: int, count: int) -> list[np.ndarray]:
    """`count` projections to eight numbers that keep lengths on average."""
    random = np.random.default_rng([SEED, size])
    tall, flat = max(size, 8), min(size, 8)
    frames = (np.linalg.qr(random.standard_normal((tall, flat)))[0] for _ in range(count))
    return [(frame if size >= 8 else frame.T) * np.sqrt(tall / 8) for frame in frames]


@cache
def _factors() -> np.ndarray:
    return np.random.default_rng(SEED).integers(-(2**62), 2**62, 8) * 2 + 1


def _mixed(numbers: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all 64-bit numbers, one to one."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        numbers = (numbers ^ (numbers >> np.uint64(shift))) * np.uint64(factor)
    return numbers ^ (numbers >> np.uint64(31))


def _cells(points: np.ndarray, reach: float) -> list[np.ndarray]:
    """The keys of the cells that each row is entered in, its own first. Keys of neighbours are sums, as lattice points are."""
    own = nearest_e8(points)
    # The border to the neighbour at a root r is where the residual's product with r is one.
    near = (points - own) @ roots().T >= 1 - np.sqrt(2) * reach
    keys, steps = (2 * own).astype(np.int64) @ _factors(), (2 * roots()).astype(np.int64) @ _factors()
    rows, which = np.nonzero(near)
    splits = np.split(keys[rows] + steps[which], np.cumsum(near.sum(axis=1))[:-1])
    return [np.concatenate([keys[i : i + 1], more]).view(np.uint64) for i, more in enumerate(splits)]


def entries(vectors: np.ndarray, lattices: int = LATTICES, tables: int = TABLES, width: float = WIDTH, reach: float = REACH) -> list[np.ndarray]:
    """The keys that each vector is entered under, all tables in one."""
    even = scaled(vectors)
    unit = even / np.linalg.norm(even, axis=1)[:, None]
    found: list[list[np.ndarray]] = [[] for _ in unit]
    frames = _projections(unit.shape[1], lattices * tables)
    for number in range(tables):
        joint = [np.full(1, number, dtype=np.uint64) for _ in unit]
        for frame in frames[number * lattices : (number + 1) * lattices]:
            cells = _cells(unit @ frame / width, reach / width)
            joint = [_mixed(before[:, None] + own[None, :]).ravel() for before, own in zip(joint, cells)]
        for row, keys in zip(found, joint):
            row.append(keys)
    return [np.concatenate(row) for row in found]


def _entered(classes: DataFrame, **shape) -> DataFrame:
    """`classes` (node, stratum, width, vector) with the array `cells` of their entries."""
    schema = T.StructType([*classes.schema.fields, T.StructField("cells", T.ArrayType(T.LongType()))])

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells: list = [None] * batch.num_rows
            widths, strata = batch["width"].to_numpy(), batch["stratum"].to_numpy().view(np.uint64)
            for width in np.unique(widths):
                rows = np.flatnonzero(widths == width)
                vectors = np.array(batch["vector"].take(pa.array(rows)).to_pylist(), dtype=np.float64)
                for row, keys in zip(rows.tolist(), entries(vectors, **shape)):
                    cells[row] = np.unique(_mixed(keys ^ strata[row]).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells, pa.list_(pa.int64()))], names=schema.names)

    return classes.mapInArrow(enter, schema)


def _first_shared(cells: list, cell: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether two rows share no smaller entry than this one. Rows of like entries are looked at once."""
    before = [frozenset(keys[keys < cell].tolist()) for keys in cells]
    kinds: dict = {}
    kind = np.array([kinds.setdefault(some, len(kinds)) for some in before])
    some = list(kinds)
    codes, back = np.unique(kind[left] * len(some) + kind[right], return_inverse=True)
    return np.array([some[code // len(some)].isdisjoint(some[code % len(some)]) for code in codes.tolist()], dtype=bool)[back]


def _linked_pairs(vectors: np.ndarray, unit: np.ndarray, lengths: np.ndarray, left: slice, right: slice, least: float):
    """Numbers of the rows of two slices (or of one with itself) whose cosine is `least` or more."""
    rough = unit[left] @ unit[right].T
    i, j = np.nonzero(rough >= least - SLACK)
    if left == right:
        i, j = i[i < j], j[i < j]
    close = np.flatnonzero(rough[i, j] <= least + SLACK)
    i, j, keep = i + left.start, j + right.start, np.ones(len(i), dtype=bool)
    for some in np.array_split(close, max(1, len(close) // 65_536)):
        exact = np.einsum("ij,ij->i", vectors[i[some]], vectors[j[some]]) / (lengths[i[some]] * lengths[j[some]])
        keep[some] = exact >= least
    return i[keep], j[keep]


def _verified(rows: pd.DataFrame, least: float) -> pd.DataFrame:
    """node, links (copies linked to it here), root (smallest class it is connected with here), for the classes with links.

    `rows`: cell, first, second, side, node, label, copies, vector, cells. In a task of two blocks (`first`, and `second` less one)
    rows of side 1 are compared with those of side 0 only.
    """
    two = rows["second"].iat[0] > rows["first"].iat[0] + 1
    rows = rows.sort_values(["cell", "side"], kind="stable").reset_index(drop=True)
    cell, side, copies = (rows[name].to_numpy() for name in ("cell", "side", "copies"))
    labels, cells = pd.factorize(rows["label"])[0], list(rows["cells"])
    vectors = scaled(np.stack(rows["vector"]).astype(np.float64))
    lengths = np.linalg.norm(vectors, axis=1)
    unit = vectors / lengths[:, None]
    bounds = np.flatnonzero(np.diff(cell)) + 1
    lefts, rights = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for begin, end in zip([0, *bounds.tolist()], [*bounds.tolist(), len(rows)]):
        if end - begin < 2:
            continue
        middle = begin + int(np.searchsorted(side[begin:end], 1))
        left = slice(begin, middle)
        i, j = _linked_pairs(vectors, unit, lengths, left, slice(middle, end) if two else left, least)
        if len(i):
            keep = _first_shared(cells[begin:end], cell[begin], i - begin, j - begin) & (labels[i] == labels[j])
            lefts.append(i[keep])
            rights.append(j[keep])
    i, j = np.concatenate(lefts), np.concatenate(rights)
    # A class stands here once for each of its cells.
    node, of = np.unique(rows["node"].to_numpy(), return_inverse=True)
    links = np.bincount(of[i], copies[j], len(node)) + np.bincount(of[j], copies[i], len(node))
    root, i, j = np.arange(len(node)), of[i], of[j]
    while True:
        new = root.copy()
        np.minimum.at(new, i, root[j])
        np.minimum.at(new, j, root[i])
        new = new[new]
        if (new == root).all():
            break
        root = new
    some = np.flatnonzero(links)
    return pd.DataFrame({"node": node[some], "links": links[some].astype(np.int64), "root": node[root[some]]})


def _met(classes: DataFrame) -> DataFrame:
    """Every class once for each entry it shares, in the tasks that compare it: task, first, second, side and what `_verified` takes."""
    each = classes.select("width", "node", F.explode("cells").alias("cell"))
    shared = stored(each.groupBy("width", "cell").agg(F.count("*").alias("classes")).where("classes > 1"), "entries")
    total = shared.agg(F.sum(F.when(F.col("classes") <= BLOCK, F.col("classes")))).first()[0] or 0
    tasks = max(1, -(-total // TASK_ROWS))
    whole = classes.select("width", "node", "label", "copies", "vector", "cells", F.explode("cells").alias("cell"))
    rows = measured_join(whole, shared, ["width", "cell"])
    small = rows.where(F.col("classes") <= BLOCK).select(
        "*", F.pmod(F.xxhash64("cell"), F.lit(tasks)).alias("task"), *(F.lit(0).alias(name) for name in ("first", "second", "side"))
    )
    blocks = F.ceil(F.col("classes") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("_blocks")).cast("int")
    busy = rows.where(F.col("classes") > BLOCK).withColumn("_blocks", blocks).withColumn("_own", own)
    busy = busy.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    busy = busy.select(
        *rows.columns, F.col("cell").alias("task"), F.least("_own", "_other").alias("first"), (F.greatest("_own", "_other") + 1).alias("second"),
        F.when(F.col("_own") > F.col("_other"), 1).otherwise(0).alias("side"),
    )
    return small.unionByName(busy)


def linked(
    table: DataFrame, least: float = COSINE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", **shape
) -> DataFrame:
    """One row per row of `table`: id, n_links (other rows linked to it), component_id, kept (whether it is its component's row).

    `shape`: lattices, tables, width, reach.
    """
    kind = table.schema[id_col].dataType
    rows = table.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vector"))
    numbers = F.col("vector").cast("array<double>")
    finite = F.forall(numbers, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & finite & F.exists(numbers, lambda x: x != 0), F.lit(False))
    digest = F.when(usable, F.sha2(F.array_join(F.col("vector").cast("array<string>"), " ").cast("binary"), 256))
    rows = stored(rows.withColumn("digest", digest), "vectors")
    classes = rows.where("digest IS NOT NULL").groupBy("label", "digest").agg(
        F.min("id").alias("low"), F.count("*").alias("copies"), F.first("vector").alias("vector")
    )
    width = F.size("vector").alias("width")
    stratum = F.xxhash64("label").alias("stratum")
    numbered = classes.select("*", width, stratum, F.monotonically_increasing_id().alias("node"))
    entered = stored(_entered(stored(numbered, "classes"), **shape), "entered")
    keys = ("width", "task", "first", "second")
    found = stored(_met(entered).groupBy(*keys).applyInPandas(lambda part: _verified(part, least), "node bigint, links bigint, root bigint"), "links")
    known = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots_of = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    low = measured_join(roots_of, entered.select("node", "low"), "node")
    lowest = stored(low.groupBy("root").agg(F.min("low").alias("component")), "lowest")
    reached = measured_join(roots_of, lowest, "root").select("node", "component")
    nodes = entered.select("node", "label", "digest", "low", "copies")
    joined = measured_join(measured_join(nodes, known, "node", "left"), stored(reached, "reached"), "node", "left")
    told = joined.where("links IS NOT NULL OR copies > 1").select(
        "label", "digest", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "low").alias("component")
    )
    with_links = measured_join(rows.where("digest IS NOT NULL"), stored(told, "told"), ["label", "digest"], "left").select("id", "links", "component")
    alone = rows.where("digest IS NULL").select("id", F.lit(0).cast("bigint").alias("links"), F.lit(None).cast(kind).alias("component"))
    component = F.coalesce("component", "id")
    return with_links.unionByName(alone).select(
        "id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )
