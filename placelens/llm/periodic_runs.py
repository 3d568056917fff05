"""Periodic runs of words in whole texts, and texts with every run cut back to its first period.

A run is a stretch of words that is the same as itself some words further on (its period), that no neighbouring word extends, and
that holds at least `times` periods and `least` words. Runs are found by a suffix automaton with link-cut access. The
automaton's suffix links make a tree of all substrings; every substring is coloured by where it ended last. Appending a word accesses
the path from the new prefix to the root: its segments of one colour are the longest substrings that end here and ended at that colour
before. Where the distance of the two ends is within the segment's length, a square stands in the text; it is extended to its run: to the left it is
already as long as can be, to the right it is where the next word breaks the period. Then the whole path takes the new end as its colour. A splay tree
holds each segment, so n words recolour O(n log n) segments at most; no pair of equal words is ever listed.

In a run of at least three periods every short sequence of words stands once more in the text. So texts are first
cut to the stretches all of whose `grams` (sequences of that many words) are repeated, by hash; runs lie whole in them, and a hash
collision only makes a stretch longer. Most texts have none.

Every row is one task's work of its own: nothing is shuffled, the automaton's size is linear in the stretch.

Defined results: words are runs of characters other than space and \\x09-\\x0D; a null text has no words, no runs and an empty collapsed text; runs
may overlap, and a word that any run repeats is dropped; repeated rows are rows of their own; a null id stays null; texts of any length are
searched whole; an empty table gives no rows; other columns are not looked at, whatever their names.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST, TIMES = 24, 3
#: Rows a task holds as Python objects at a time.
ROWS_AT_ONCE = 500
MIX = 0x9E3779B97F4A7C15
RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])


def suffix_automaton(words: list) -> tuple[list[int], list[int], list[int]]:
    """The suffix link and the longest length of every state, and the state of every prefix. State 0 is the empty text."""
    follow, link, length, prefixes, last = [{}], [-1], [0], [], 0
    for word in words:
        new = len(follow)
        follow.append({})
        link.append(0)
        length.append(length[last] + 1)
        at = last
        while at >= 0 and word not in follow[at]:
            follow[at][word] = new
            at = link[at]
        if at >= 0:
            known = follow[at][word]
            if length[known] > length[at] + 1:  # only the shorter strings of that state end here too: they get a state of their own
                part = len(follow)
                follow.append(follow[known].copy())
                link.append(link[known])
                length.append(length[at] + 1)
                link[known] = part
                while at >= 0 and follow[at].get(word) == known:
                    follow[at][word] = part
                    at = link[at]
                known = part
            link[new] = known
        prefixes.append(new)
        last = new
    return link, length, prefixes


class ColouredPaths:
    """A rooted tree whose paths to the root are recoloured as wholes; every path of one colour is a splay tree ordered by depth.

    Nodes are numbered from 1 here, 0 is none. `up` is the parent in the splay tree, or for its root the tree node above the path.
    """

    def __init__(self, parents: list[int]):
        size = len(parents) + 1
        self.up = [0] + [parent + 1 for parent in parents]
        self.above, self.below = [0] * size, [0] * size
        self.colour, self.pending = [-1] * size, [-1] * size

    def _rotate(self, node: int) -> None:
        up, above, below = self.up, self.above, self.below
        parent = up[node]
        grand = up[parent]
        if above[grand] == parent:
            above[grand] = node
        elif below[grand] == parent:
            below[grand] = node
        if above[parent] == node:
            inner = above[parent] = below[node]
            below[node] = parent
        else:
            inner = below[parent] = above[node]
            above[node] = parent
        if inner:
            up[inner] = parent
        up[parent], up[node] = node, grand

    def _settle(self, node: int) -> None:
        colour = self.pending[node]
        if colour >= 0:
            for child in (self.above[node], self.below[node]):
                self.colour[child] = self.pending[child] = colour
            self.pending[node] = -1

    def _splay(self, node: int) -> None:
        up, above, below = self.up, self.above, self.below
        way, at = [node], node
        while (parent := up[at]) and (above[parent] == at or below[parent] == at):
            way.append(parent)
            at = parent
        for at in reversed(way):
            if self.pending[at] >= 0:
                self._settle(at)
        end = up[way[-1]]
        while (parent := up[node]) != end:
            grand = up[parent]
            if grand != end:
                self._rotate(parent if (above[parent] == node) == (above[grand] == parent) else node)
            self._rotate(node)

    def recolour(self, node: int, colour: int) -> list[tuple[int, int]]:
        """Give the path from `node` to the root a colour; (deepest node, colour before) of each segment it had, deepest first."""
        segments, at, under = [], node + 1, 0
        while at:
            self._splay(at)
            if self.colour[at] >= 0:
                segments.append((at - 1, self.colour[at]))
            self.below[at] = under
            under, at = at, self.up[at]
        self.colour[under] = self.pending[under] = colour
        self.colour[0] = self.pending[0] = -1
        return segments


def _runs_of(words: list, least: int, times: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, period) of every run, in the order of their ends."""
    link, length, prefixes = suffix_automaton(words)
    paths, last = ColouredPaths(link), len(words) - 1
    for end, state in enumerate(prefixes):
        for deepest, before in paths.recolour(state, end):
            period, common = end - before, length[deepest]
            if common >= (times - 1) * period and common + period >= least:
                if end == last or words[end + 1] != words[end + 1 - period]:
                    yield end - period - common + 1, common + period, period


def _gram(least: int, times: int) -> int:
    """A power of two so that every sequence of as many words of a run stands in the run a second time, one period on or back.

    That holds for sequences of up to length - 2 * period + 1 words.
    """
    return 1 << max(0, ((least - 2 * (least // times) + 1) if times > 2 else 1).bit_length() - 1)


def _stretches(words: list, least: int, gram: int) -> list[tuple[int, int]]:
    """(begin, end) of the longest stretches of at least `least` words all of whose grams are repeated."""
    if len(words) < least:
        return []
    hashed, factor, span = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64), MIX, 1
    while span < gram:
        hashed = hashed[:-span] * np.uint64(factor) + hashed[span:]
        factor, span = factor * factor % 2**64, 2 * span
    ordered = np.sort(hashed)
    if not (ordered[1:] == ordered[:-1]).any():
        return []
    order = np.argsort(hashed, kind="stable")
    same = hashed[order[1:]] == hashed[order[:-1]]
    repeated = np.zeros(len(hashed) + 2, dtype=np.int8)
    repeated[order[1:][same] + 1] = repeated[order[:-1][same] + 1] = 1
    edges = np.flatnonzero(np.diff(repeated)).reshape(-1, 2) + [0, gram - 1]
    return [(begin, end) for begin, end in edges.tolist() if end - begin >= least]


def runs(words: list, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of at least `times` (2 or more) periods and `least` words, by start, then period."""
    found = []
    for begin, end in _stretches(words, least, _gram(least, times)):
        found += [(begin + start, length, period) for start, length, period in _runs_of(words[begin:end], least, times)]
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapsed(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    if not found:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[at] for at in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def periodic_runs(
    docs: DataFrame,
    least: int = LEAST,
    times: int = TIMES,
    id_col: str = "doc_id",
    text_col: str = "text",
    reworded: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """One row per document: id, words (how many), runs (array of start, length, period), collapsed (its kept words joined by a space).

    `reworded` takes a document's id and words and gives the words to search instead; it runs in the tasks.
    """
    fields = [("id", docs.schema[id_col].dataType), ("words", T.LongType()), ("runs", T.ArrayType(RUN)), ("collapsed", T.StringType())]
    schema = T.StructType([T.StructField(name, kind) for name, kind in fields])
    struct = pa.list_(pa.struct([(name, pa.int64()) for name in RUN.names]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in (whole.slice(at, ROWS_AT_ONCE) for at in range(0, whole.num_rows, ROWS_AT_ONCE)):
                sizes, lists, texts = [], [], []
                for number, text in zip(batch["id"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist()):
                    words = (text or b"").split()  # bytes are split at exactly these six characters
                    words = reworded(number, words) if reworded else words
                    found = runs(words, least, times)
                    sizes.append(len(words))
                    lists.append([dict(zip(RUN.names, run)) for run in found])
                    texts.append(b" ".join(collapsed(words, found)))
                columns = [batch["id"], pa.array(sizes, pa.int64()), pa.array(lists, struct), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(search, schema)
