"""Packing documents into fixed-length sequences along a space-filling curve.

Every document is a bag of token ids hashed to `HASHED` counts; a seeded random projection takes that vector to `DIMENSIONS`
numbers, and their cell's place on the Hilbert curve through that space is the document's key. Sorted by key, documents with
like words stand next to each other, and sequences are cut from the line of all their tokens, so only the very last one needs padding.

Tokenizing is done once; ids are stored two bytes each. What is sorted is (key, row number, token count): a range sort
whose ties are broken by the row number, so copies (equal keys) spread over tasks. Token counts are added up by range first, then
within each range. The places go back to the ids by row number.

Defined results: a null text is the empty text, which has only the closing id; repeated rows are packed each; a null id stays
null; texts of any length are tokenized whole and cut at sequence ends only; an empty table gives no rows; other columns are not
looked at, whatever their names.
"""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelens.llm.common import line_up, measured_join, stored
from placelens.llm.tokens import encoder

LENGTH = 1024
CLOSING = 0
HASHED = 512
DIMENSIONS = 3
LEVELS = 16
SEED = 5
#: Rows a task holds as Python objects at a time.
ROWS_AT_ONCE = 500


def _hilbert(cells: np.ndarray, levels: int) -> np.ndarray:
    """The place of each cell (row of unsigned numbers below 2**levels) on the Hilbert curve.

    The cube is halved along every axis again and again. At each level the octant's bits are read in Gray-code order, after
    undoing the turn that the levels above gave this part of the curve (`flip` reflects axes, `turn` rotates them).
    """
    count, axes = cells.shape
    full = (1 << axes) - 1
    flip, turn, key = (np.zeros(count, dtype=np.int64) for _ in range(3))
    for level in range(levels - 1, -1, -1):
        octant = np.zeros(count, dtype=np.int64)
        for axis in range(axes):
            octant |= ((cells[:, axis] >> level) & 1) << axis
        octant ^= flip
        octant = ((octant >> turn) | (octant << (axes - turn))) & full
        place = octant.copy()
        for shift in (1, 2, 4, 8):
            place ^= place >> shift
        key = (key << axes) | place
        # Where the curve enters the octant, and along which axis it crosses it.
        low = np.maximum(0, 2 * ((place - 1) // 2))
        enter = np.where(place == 0, 0, low ^ (low >> 1))
        odd = np.where(place % 2 == 0, place - 1, place)
        trailing = np.zeros(count, dtype=np.int64)
        rest = np.maximum(odd, 0)
        for _ in range(axes):
            more = (rest & 1) == 1
            trailing += more
            rest = np.where(more, rest >> 1, 0)
        axis = np.where(place == 0, 0, trailing % axes)
        flip = flip ^ (((enter << turn) | (enter >> (axes - turn))) & full)
        turn = (turn + axis + 1) % axes
    return key


def _projection() -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((HASHED, DIMENSIONS))


def _direction(raw: bytes) -> np.ndarray:
    """The hashed token counts of a document as a vector of length one; the closing id keeps it from being zero."""
    hashed = (np.frombuffer(raw, dtype="<u2").astype(np.uint32) * np.uint32(40503) >> np.uint32(7)) % HASHED
    vector = np.sqrt(np.bincount(hashed, minlength=HASHED))
    return vector / np.linalg.norm(vector)


def _tokenized(docs: DataFrame, id_col: str, text_col: str, tokenizer: str) -> DataFrame:
    """row, id, ids (two bytes each, closing id last), tokens, curve; stored."""
    kind = docs.schema[id_col].dataType
    schema = T.StructType(
        [T.StructField("id", kind), T.StructField("ids", T.BinaryType()), T.StructField("tokens", T.LongType()), T.StructField("curve", T.LongType())]
    )

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, axes = encoder(tokenizer).encode, _projection()
        closing = np.array([CLOSING], dtype="<u2").tobytes()
        for whole in batches:
            for batch in (whole.slice(at, ROWS_AT_ONCE) for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
                ids = [encode(text or "") + closing for text in batch["text"].to_pylist()]
                spread = np.array([np.tanh(_direction(raw) @ axes) for raw in ids])  # -1 to 1 whatever the corpus
                cells = np.minimum((spread + 1) / 2 * 2**LEVELS, 2**LEVELS - 1).astype(np.int64)
                tokens = pa.array([len(raw) // 2 for raw in ids], pa.int64())
                columns = [batch["id"], pa.array(ids, pa.binary()), tokens, pa.array(_hilbert(cells, LEVELS))]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "tokens", "curve"])

    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    done = pairs.mapInArrow(tokenize, schema)
    return stored(done.withColumn("row", F.monotonically_increasing_id()), "tokens")


def pack(
    docs: DataFrame, tokenizer: str, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset; `with_ids` adds the piece's ids.

    Tokens stand in sequence `sequence_id` at `offset`; every sequence but the last has exactly `length` of them.
    """
    rows = _tokenized(docs, id_col, text_col, tokenizer)
    found = stored(line_up(rows.select("row", "tokens", "curve"), ["curve", "row"], "tokens", "place").select("row", "place"), "places")
    kind = docs.schema[id_col].dataType
    names = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = T.StructType([T.StructField("id", kind), *(T.StructField(name, T.LongType()) for name in names)])
    if with_ids:
        schema.add("ids", T.ArrayType(T.IntegerType()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, ROWS_AT_ONCE) for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
                out, which, pieces = [], [], []
                for number, (raw, place) in enumerate(zip(batch["ids"].to_pylist(), batch["place"].to_pylist())):
                    ids = np.frombuffer(raw, dtype="<u2")
                    wide = memoryview(ids.astype("<u4").tobytes())
                    at, total = 0, len(ids)
                    while at < total:
                        sequence, offset = divmod(place + at, length)
                        size = min(length - offset, total - at)
                        out.append((at, size, zlib.crc32(wide[4 * at : 4 * (at + size)]), total, sequence, offset))
                        which.append(number)
                        if with_ids:
                            pieces.append(ids[at : at + size].astype(np.int32))
                        at += size
                columns = [batch["id"].take(pa.array(which, pa.int64()))]
                columns += [pa.array(column) for column in np.array(out, dtype=np.int64).reshape(-1, len(names)).T.copy()]
                if with_ids:
                    columns.append(pa.array(pieces, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    placed = measured_join(rows.select("row", "id", "ids"), found, "row")
    return placed.select("id", "ids", "place").mapInArrow(cut, schema)
