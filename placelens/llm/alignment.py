"""Alignment of two tokenizers' tokens over whole texts, by products of sparse incidence matrices.

A tokenizer's tokens of a text and the text's bytes make an incidence matrix: a row for each token, a one in the column of every byte that it covers. With
A for one tokenizer and B for the other, the product A·Bᵀ has an entry for every two tokens that share bytes, and its value is how many:
the overlap links. Overlap links of tokens that end at the same byte cut the text into groups, the smallest stretches that both tokenizers
keep whole; a second product, of the (token, group) incidence matrices, gives the links of tokens that share a group. Matrices are
compressed rows built by hand, and the product is Gustavson's: each row of A adds up the rows of Bᵀ that its entries name. Rows
are multiplied in blocks, so what is in memory at once is bounded by `ENTRIES` beside the text's own tokens.

Counting how often two ids are linked in the whole corpus needs every link, and the documents need the counts back. Links don't cross a
shuffle for that: documents are taken in chunks of at most `CHUNK` links (longer texts in several), each chunk's distinct pairs of ids are counted and
summed over the corpus, and only those rows get the sums back; then every chunk meets its own pairs. A pair that is in every text is one row for
each chunk. What is broadcast is the highest count of each id (at most 65,536 rows), and the pairs' counts where their measured size allows it.

Defined results: null and empty texts have no tokens, nor do texts that a tokenizer does not give back byte by byte; strings of special tokens are ordinary
text; repeated rows are rows of their own and count each; a null id stays null; texts of any length are aligned whole; an empty table gives no rows;
other columns are not looked at, whatever their names.
"""

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelens.llm.common import measured_join, stored
from placelens.llm.tokens import byte_level, encoder

CHUNK = 1 << 20
ENTRIES = 1 << 20
#: Rows a task holds as Python objects at a time.
ROWS_AT_ONCE = 500
SPACE = "▁"


class Csr(NamedTuple):
    """Compressed rows: the entries of row i are columns[starts[i]:starts[i + 1]], all of them ones."""

    starts: np.ndarray
    columns: np.ndarray
    width: int

    def transposed(self) -> "Csr":
        rows = np.repeat(np.arange(len(self.starts) - 1, dtype=np.int32), np.diff(self.starts))
        order = np.argsort(self.columns, kind="stable")
        starts = np.concatenate([[0], np.cumsum(np.bincount(self.columns, minlength=self.width))])
        return Csr(starts, rows[order], len(self.starts) - 1)


class Links(NamedTuple):
    """The entries of a product: token of the one side, token of the other, how many columns they share. In order."""

    a: np.ndarray
    b: np.ndarray
    shared: np.ndarray


def _rows_product(left: Csr, right: Csr, begin: int, end: int) -> Links:
    first, last = left.starts[begin], left.starts[end]
    inner = left.columns[first:last]
    rows = np.repeat(np.arange(begin, end), np.diff(left.starts[begin : end + 1]))
    sizes = right.starts[inner + 1] - right.starts[inner]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    at = np.arange(total) + np.repeat(right.starts[inner] - ends + sizes, sizes)
    keys = np.repeat(rows, sizes) * right.width + right.columns[at]
    if (np.diff(keys) < 0).any():
        keys.sort()
    heads = np.flatnonzero(np.diff(keys, prepend=-1))
    a, b = np.divmod(keys[heads], max(right.width, 1))
    return Links(a, b, np.diff(heads, append=total))


def product(left: Csr, right: Csr) -> Links:
    """left · right, whose columns and rows are the same things; blocks of rows that hold at most `ENTRIES` entries or are one row."""
    blocks, begin, rows = [], 0, len(left.starts) - 1
    while begin < rows:
        end = max(begin + 1, int(np.searchsorted(left.starts, left.starts[begin] + ENTRIES, "right")) - 1)
        blocks.append(_rows_product(left, right, begin, end))
        begin = end
    return Links(*(np.concatenate(parts) for parts in zip(*blocks))) if blocks else Links(*[np.empty(0, np.int64)] * 3)


def covered(ends: np.ndarray) -> Csr:
    """(token, byte) incidence of tokens that follow each other; `ends` are the bytes up to and with each."""
    total = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(total), total)


def grouped(groups: np.ndarray, count: int) -> Csr:
    """(token, group) incidence: each token is in one group."""
    return Csr(np.arange(len(groups) + 1), groups, count)


class Side(NamedTuple):
    """A tokenizer: ids of a text, and every id's bytes and their number."""

    encode: Callable[[str], np.ndarray]
    entries: np.ndarray
    sizes: np.ndarray


@cache
def side(file: str) -> Side:
    """A byte-level file (which gets a space in front of the text) or a sentencepiece model (which puts one there); ids must fit 16 bits."""
    if file.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=file)
        entries = [
            bytes([int(piece[3:5], 16)]) if model.is_byte(number) else piece.replace(SPACE, " ").encode()
            for number, piece in enumerate(map(model.id_to_piece, range(model.get_piece_size())))
        ]

        def encode(text: str) -> np.ndarray:
            return np.array(model.encode(text, num_threads=1), dtype=np.int64)

    else:
        table, ranks = byte_level(file), encoder(file, plain=True)
        if not table:
            raise ValueError(f"no byte-level vocabulary: {file}")
        entries = [table.get(number, b"") for number in range(max(table) + 1)]

        def encode(text: str) -> np.ndarray:
            return ranks.ids(" " + text).astype(np.int64)

    if len(entries) > 65_536:
        raise ValueError("ids must fit 16 bits")
    return Side(encode, np.array(entries, dtype=object), np.array([len(entry) for entry in entries]))


def _joined(entries: np.ndarray, numbers: np.ndarray) -> bytes:
    """The entries (byte strings) of these numbers in a row."""
    return b"".join(entries[numbers].tolist())


class Alignment:
    """The tokens of one text by both tokenizers. `whole` is false if a tokenizer loses or changes bytes; then there are no tokens."""

    def __init__(self, text: str | None, one: Side, other: Side):
        self.a = self.b = np.empty(0, np.int64)
        if text:
            found, expected = (one.encode(text), other.encode(text)), b" " + text.encode()
            if all(_joined(s.entries, ids) == expected for s, ids in zip((one, other), found)):
                self.a, self.b = found
        self.a_ends, self.b_ends = np.cumsum(one.sizes[self.a]), np.cumsum(other.sizes[self.b])

    def overlaps(self) -> Links:
        return product(covered(self.a_ends), covered(self.b_ends).transposed())

    def together(self) -> Links:
        """The overlap links whose tokens end at the same byte."""
        links = self.overlaps()
        return Links(*(part[self.a_ends[links.a] == self.b_ends[links.b]] for part in links))

    def groups(self, together: Links) -> tuple[np.ndarray, np.ndarray, int]:
        """The group of every token of either side, and how many groups there are. A linked token is the last of its group."""
        ends_group = (np.zeros(len(self.a), dtype=np.int64), np.zeros(len(self.b), dtype=np.int64))
        for ends, linked in zip(ends_group, together):
            ends[linked] = 1
        one, other = (np.cumsum(ends) - ends for ends in ends_group)
        return one, other, int(ends_group[0].sum())

    def sharing(self) -> Links:
        """Links of tokens that share a group; every pair shares one group, or none."""
        one, other, count = self.groups(self.together())
        return product(grouped(one, count), grouped(other, count).transposed())


@cache
def _endings() -> np.ndarray:
    """Every id followed by a comma, a bar or a semicolon."""
    return np.array([b"%d%c" % (number, mark) for number in range(65_536) for mark in b",|;"], dtype=object)


def group_line(found: Alignment, one: np.ndarray, other: np.ndarray, count: int) -> bytes:
    """The groups of a text as `a1,a2|b1;a3|b2,b3`."""
    if not count:
        return b""
    a_sizes, b_sizes = np.bincount(one, minlength=count), np.bincount(other, minlength=count)
    marks = np.empty(len(one) + len(other), dtype=np.int64)
    a_codes, b_codes = 3 * found.a, 3 * found.b
    a_codes[np.cumsum(a_sizes) - 1] += 1
    b_codes[np.cumsum(b_sizes) - 1] += 2
    # The tokens of either side keep their order, and a group's a's come before its b's.
    is_a = np.repeat(np.tile([True, False], count), np.stack([a_sizes, b_sizes], axis=1).ravel())
    marks[is_a], marks[~is_a] = a_codes, b_codes
    return _joined(_endings(), marks)[:-1]


def links(docs: DataFrame, a_file: str, b_file: str, kind: str = "overlap", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per link: id, a, b (token numbers), a_id, b_id, shared. `kind`: overlap (shared bytes), together (they also end together) or group."""
    find = {"overlap": Alignment.overlaps, "together": Alignment.together, "group": Alignment.sharing}[kind]
    names = ["a", "b", "a_id", "b_id", "shared"]
    schema = T.StructType([T.StructField("id", docs.schema[id_col].dataType), *(T.StructField(name, T.LongType()) for name in names)])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = side(a_file), side(b_file)
        for batch in batches:
            for row, text in enumerate(batch["text"]):
                found = Alignment(text.as_py(), one, other)
                a, b, shared = find(found)
                for at in range(0, len(a), ENTRIES):
                    part = slice(at, at + ENTRIES)
                    columns = [a[part], b[part], found.a[a[part]], found.b[b[part]], shared[part]]
                    ids = batch["id"].take(pa.array(np.full(len(columns[0]), row)))
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in columns)], names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(emit, schema)


DIGESTS = ["n_a", "n_b", "n_groups", "n_links"]


def _parts(docs: DataFrame, a_file: str, b_file: str, id_col: str, text_col: str) -> DataFrame:
    """Every text's digests, and its linked pairs of ids (a * 65,536 + b, four bytes each) in parts of at most `CHUNK`; stored.

    Only a text's first part has the digests.
    """
    kinds = [("row", T.LongType()), ("chunk", T.LongType()), ("id", docs.schema[id_col].dataType)]
    kinds += [*((name, T.LongType()) for name in DIGESTS), ("groups_sha256", T.StringType()), ("pairs", T.BinaryType())]
    schema = T.StructType([T.StructField(name, kind) for name, kind in kinds])

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = side(a_file), side(b_file)
        row = chunk = TaskContext.get().partitionId() << 33  # below it, room for the rows and chunks of one task
        held = 0
        for whole in batches:
            for batch in (whole.slice(at, ROWS_AT_ONCE) for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
                out, which = [], []
                for number, text in enumerate(batch["text"].to_pylist()):
                    found = Alignment(text, one, other)
                    together = found.together()
                    a_groups, b_groups, count = found.groups(together)
                    line = group_line(found, a_groups, b_groups, count)
                    digests = [len(found.a), len(found.b), count, len(together.a), hashlib.sha256(line).hexdigest() if line else ""]
                    pairs = (found.a[together.a] << 16 | found.b[together.b]).astype("<u4")
                    for at in range(0, max(1, len(pairs)), CHUNK):
                        part = pairs[at : at + CHUNK]
                        if held + len(part) > CHUNK:
                            chunk, held = chunk + 1, 0
                        held += len(part)
                        out.append((row, chunk, *(digests if at == 0 else [None] * 5), part.tobytes()))
                        which.append(number)
                    row += 1
                columns = [pa.array(column, pa.int64()) for column in list(zip(*out))[:6]]
                columns += [pa.array([line[6] for line in out], pa.string()), pa.array([line[7] for line in out], pa.binary())]
                columns.insert(2, batch["id"].take(pa.array(which, pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return stored(texts.mapInArrow(align, schema), "aligned")


def _distinct(parts: DataFrame) -> DataFrame:
    """chunk, pair, times: how often each pair of ids is linked in the parts of a chunk; a chunk read in two batches has two rows for a pair."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch["chunk"].to_numpy()
            for chunk in np.unique(chunks):
                rows = batch["pairs"].take(pa.array(np.flatnonzero(chunks == chunk)))
                pairs, times = np.unique(np.frombuffer(b"".join(rows.to_pylist()), "<u4"), return_counts=True)
                columns = [np.full(len(pairs), chunk), pairs.astype(np.int64), times]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["chunk", "pair", "times"])

    return parts.select("chunk", "pairs").mapInArrow(count, "chunk bigint, pair bigint, times bigint")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """pair, links (how many in the corpus), best (whether no other pair of its second id has more). `pairs`: pair, times."""
    counts = stored(pairs.groupBy("pair").agg(F.sum("times").alias("links")), "pair-counts")
    second = F.col("pair").bitwiseAND(65_535).alias("second")
    highest = counts.groupBy(second).agg(F.max("links").alias("highest"))  # at most 65,536 rows
    return counts.withColumn("second", second).join(F.broadcast(highest), "second").select("pair", "links", (F.col("links") == F.col("highest")).alias("best"))


def aligned(docs: DataFrame, a_file: str, b_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    n_best are the links whose pair of ids is linked as often in the corpus as any pair of its second id, count_sum adds up how often
    each link's pair is linked there; groups_sha256 is the digest of `group_line`, empty without tokens.
    """
    parts = _parts(docs, a_file, b_file, id_col, text_col)
    pairs = stored(_distinct(parts), "chunk-pairs")
    known = measured_join(pairs.select("chunk", "pair"), pair_counts(pairs), "pair")
    names = ["row", "id", *DIGESTS, "groups_sha256", "n_best", "count_sum"]
    kinds = {field.name: field.dataType for field in parts.schema} | {"n_best": T.LongType(), "count_sum": T.LongType()}
    schema = T.StructType([T.StructField(name, kinds[name]) for name in names])

    def look_up(texts: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        order = np.argsort(table["pair"].to_numpy())
        numbers, counts, best = (table[name].to_numpy()[order] for name in ("pair", "links", "best"))
        n_best, count_sum = [], []
        for raw in texts["pairs"]:
            at = np.searchsorted(numbers, np.frombuffer(raw, "<u4"))
            n_best.append(int(best[at].sum()) if len(at) else 0)
            count_sum.append(int(counts[at].sum()) if len(at) else 0)
        return texts.assign(n_best=n_best, count_sum=count_sum)[names]

    met = parts.groupBy("chunk").cogroup(known.groupBy("chunk")).applyInPandas(look_up, schema)
    firsts = [F.first(name, ignorenulls=True).alias(name) for name in ("id", *DIGESTS)]
    sums = [F.sum(name).alias(name) for name in ("n_best", "count_sum")]
    return met.groupBy("row").agg(*firsts, *sums, F.first("groups_sha256", ignorenulls=True).alias("groups_sha256")).drop("row")
