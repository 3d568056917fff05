"""Toxic spans and document scores by a linear-chain conditional random field.

1. Every word and every word beginning of 4 to 6 letters is counted over all labelled training documents: in how many toxic and
   how many clean ones it occurs. Its evidence is the lower bound of its log-odds, so that rare words prove little.
2. Words of training documents become labelled tokens: toxic if the document is and the word has evidence. The evidence used here
   comes from the other half of the training documents (halves by the longest word, so that exact and near copies mostly stay
   together); words that are toxic by chance only are therefore seen in clean documents too.
3. A chain with two states is fitted to a bounded sample of stretches of such tokens (`CHAINS` kinds of stretches of `STRETCH` words): a kind's
   chance to be in it grows with how often it comes, the commonest are in it for certain, and each has the weight that makes the sample
   as much as all of them (priority sampling). With fewer kinds all are in it. Its features say which evidence classes a word and its two neighbours reach; weights of the word itself are not negative, so
   more evidence never counts for less.
4. Every document's whole text is one chain. Forward-backward gives each word's marginal probability; the largest is the
   document's score, and words of at least `TOXIC` join to spans with offsets.

Counting is done per task first, then summed by word, so a word of every document is no single task's work. Every word of enough evidence
counts: they go to the tasks as a whole where they measure at most `LEXICON_BYTES`, else each document gets the classes of its own
words by a join. To the driver come such a small lexicon and the sample.

Defined results: null and empty texts, and texts without a word, score 0 and have no span; a document with several labels is
toxic if one of them says so; null labels are left out; without a toxic and a clean training document every score is 0; repeated
rows have one result each; an empty table gives no rows; other columns are not looked at, whatever their names.
"""

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from placelens.llm.common import measured_join, stored
from placelens.operators.joins import fits_broadcast

BEGINNINGS = (4, 5, 6)
LEXICON_BYTES = 32 * 1024 * 1024
#: Training rows of a task.
TASK_ROWS = 4_096
CHAINS = 20_000
STRETCH = 64
TOXIC = 0.5
CLASSES = 8
LEAST = 2.0
DEVIATIONS = 1.5
STEPS = 250
PENALTY = 1e-3
CELLS = 2_000_000
KEPT = 300_000
_WORDS = re.compile(r"\w+")


def _features(word: str) -> list[str]:
    low = word.lower()
    return [low + "$", *(low[:n] for n in BEGINNINGS if len(low) >= n)]


def labelled(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """text, toxic, half of the training rows in `docs` that have a label."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic")).dropna()
    one = known.groupBy("id").agg(F.max("toxic").alias("toxic"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    words = F.transform(F.split("text", r"\s+"), lambda word: F.struct(F.length(word), word))
    half = F.xxhash64(F.array_max(words)).bitwiseAND(1).cast("int")  # by the longest word, which copies share
    return measured_join(rows, one, "id").select("text", "toxic", half.alias("half"))


def word_counts(rows: DataFrame) -> DataFrame:
    """feature, half, toxic, clean: documents with the feature. `rows` as of `labelled`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], list[int]] = {}

        def flushed():
            columns = [[k[0] for k in sums], [k[1] for k in sums], [v[0] for v in sums.values()], [v[1] for v in sums.values()]]
            sums.clear()
            kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["feature", "half", "toxic", "clean"]
            )

        for batch in batches:
            for text, toxic, half in zip(*(batch[name].to_pylist() for name in ("text", "toxic", "half"))):
                for feature in {f for word in set(_WORDS.findall(text)) for f in _features(word)}:
                    sums.setdefault((feature, half), [0, 0])[0 if toxic else 1] += 1
                if len(sums) > KEPT:
                    yield flushed()
        yield flushed()

    counted = rows.mapInArrow(count, "feature string, half int, toxic bigint, clean bigint")
    return counted.groupBy("feature", "half").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _evidence(toxic: Column, clean: Column, all_toxic: int, all_clean: int) -> Column:
    odds = F.log((toxic + 0.5) / (all_toxic + 1)) - F.log((clean + 0.5) / (all_clean + 1))
    return odds - DEVIATIONS * F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def _lexicon(counts: DataFrame, totals: tuple[int, int]) -> DataFrame:
    """feature, class (1 to CLASSES - 1) of every feature with evidence; stored. `counts`: feature, toxic, clean."""
    scored = counts.where("toxic > 1").withColumn("evidence", _evidence(F.col("toxic"), F.col("clean"), *totals))
    level = F.least(F.lit(CLASSES - 1), F.floor("evidence").cast("int")).alias("class")
    return stored(scored.where(F.col("evidence") >= LEAST).select("feature", level), "lexicon")


def _held(lexicon: DataFrame) -> dict[str, int] | None:
    """The lexicon as a table for every task, None if that would be too large."""
    return {row["feature"]: row["class"] for row in lexicon.collect()} if fits_broadcast(lexicon, limit=LEXICON_BYTES) else None


def _joined(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """`rows` (row, text, ...) with `known`: the features of its own words that the lexicon has, and their classes."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list({f for word in set(_WORDS.findall(text or "")) for f in _features(word)}) for text in batch["text"].to_pylist()]
            which = np.repeat(np.arange(batch.num_rows), [len(some) for some in found])
            features = pa.array([f for some in found for f in some], pa.string())
            yield pa.RecordBatch.from_arrays([batch["row"].take(pa.array(which)), features], names=["row", "feature"])

    each = rows.select("row", "text").mapInArrow(words, "row bigint, feature string")
    hits = measured_join(each, lexicon, "feature").groupBy("row").agg(F.collect_list(F.struct("feature", "class")).alias("known"))
    return rows.join(hits, "row", "left")


class Classes:
    """The evidence class of words: that of their strongest feature, 0 for none."""

    def __init__(self, lexicon: dict[str, int]):
        self.lexicon = lexicon
        self.known: dict[str, int] = {}

    def of(self, words: list[str]) -> np.ndarray:
        known, get = self.known, self.lexicon.get
        if len(known) > KEPT:
            known.clear()
        for word in set(words).difference(known):
            known[word] = max(get(feature, 0) for feature in _features(word))
        return np.fromiter(map(known.__getitem__, words), np.int8, len(words))


def _classes_of(batch: pa.RecordBatch, texts: list[str | None], classes: Classes | None) -> Iterator[np.ndarray]:
    """The classes of every text's words, by `classes` or, without it, by the row's own `known`."""
    own = batch["known"].to_pylist() if classes is None else [None] * len(texts)
    for text, known in zip(texts, own):
        table = classes or Classes({entry["feature"]: entry["class"] for entry in known or ()})
        yield table.of(_WORDS.findall(text or ""))


def _inputs(classes: np.ndarray) -> np.ndarray:
    """One number for the classes of a word and its neighbours; `classes`: positions along the first axis."""
    wide = classes.astype(np.int16)
    before, after = np.zeros_like(wide), np.zeros_like(wide)
    before[1:], after[:-1] = wide[:-1], wide[1:]
    return wide + CLASSES * before + CLASSES**2 * after


def marginals(emission: np.ndarray, moves: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """P(toxic) of each word by forward-backward, many chains at a time.

    `emission`: (positions, chains), the odds of the toxic state; chains in descending order of `lengths`. `moves`: weights
    [[clean-clean, clean-toxic], [toxic-clean, toxic-toxic]].
    """
    positions, chains = emission.shape
    forward = np.zeros((positions, chains))
    result = np.zeros((positions, chains))
    active = np.searchsorted(-lengths, -np.arange(positions), side="left")  # chains longer than the position
    (cc, ct), (tc, tt) = moves
    p = np.full(chains, 0.5)
    for at in range(positions):
        n = active[at]
        q = p[:n]
        into_toxic = (q * tt + (1 - q) * ct) * emission[at, :n] if at else emission[at, :n].copy()
        into_clean = q * tc + (1 - q) * cc if at else np.ones(n)
        p = into_toxic / (into_toxic + into_clean)
        forward[at, :n] = p
    back = np.full(chains, 0.5)  # share of the toxic state in what follows
    for at in range(positions - 1, -1, -1):
        n = active[at]
        b = back[:n]
        toxic = forward[at, :n] * b
        result[at, :n] = toxic / (toxic + (1 - forward[at, :n]) * (1 - b))
        if at:
            e = emission[at, :n]
            from_toxic = tt * e * b + tc * (1 - b)
            from_clean = ct * e * b + cc * (1 - b)
            back[:n] = from_toxic / (from_toxic + from_clean)
    return result


class Chain:
    """A fitted chain: emission weights of every class that the word, the one before and the one after reach; move weights."""

    def __init__(self):
        self.bias = -3.0
        self.weights = np.zeros((3, CLASSES))
        self.moves = np.zeros((2, 2))

    def table(self) -> np.ndarray:
        """Emission odds for every number that `_inputs` makes."""
        number = np.arange(CLASSES**3)
        own, before, after = number % CLASSES, number // CLASSES % CLASSES, number // CLASSES**2
        own_sum, before_sum, after_sum = np.cumsum(self.weights, axis=1)
        score = self.bias + own_sum[own] + before_sum[before] + after_sum[after]
        return np.exp(np.clip(score, -30, 30))

    def fit(self, stretches: np.ndarray, labels: np.ndarray, times: np.ndarray) -> None:
        """Raise the likelihood of the labels by Adam steps; all stretches (rows) are equally long."""
        inputs = _inputs(stretches.T)
        truth, weight = labels.T.astype(float), times / times.sum()
        parts = [inputs % CLASSES, inputs // CLASSES % CLASSES, inputs // CLASSES**2]
        lengths = np.full(inputs.shape[1], inputs.shape[0])
        params = np.concatenate([[self.bias], self.weights.ravel(), self.moves.ravel()])
        mean, square = np.zeros_like(params), np.zeros_like(params)
        pairs = np.zeros((2, 2))
        for a in (0, 1):
            for b in (0, 1):
                pairs[a, b] = (((truth[:-1] == a) & (truth[1:] == b)) * weight).sum()
        for step in range(1, STEPS + 1):
            self._set(params)
            emission, moves = self.table()[inputs], np.exp(self.moves)
            likely = marginals(emission, moves, lengths)
            gap = (truth - likely) * weight
            by_class = (np.bincount(part.ravel(), gap.ravel(), CLASSES) for part in parts)
            slope = [[gap.sum()], *(np.cumsum(sums[::-1])[::-1] for sums in by_class)]
            slope.append((pairs - self._pairs(emission, moves, weight)).ravel())
            gradient = np.concatenate(slope) - PENALTY * params
            mean = 0.9 * mean + 0.1 * gradient
            square = 0.99 * square + 0.01 * gradient**2
            params = params + 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
            params[1 : 1 + CLASSES] = np.maximum(params[1 : 1 + CLASSES], 0)
        self._set(params)

    def _set(self, params: np.ndarray) -> None:
        self.bias, self.weights, self.moves = params[0], params[1:-4].reshape(3, CLASSES), params[-4:].reshape(2, 2)

    @staticmethod
    def _pairs(emission: np.ndarray, moves: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Expected number of each move, from scaled forward and backward vectors."""
        positions, chains = emission.shape
        state = np.stack([np.ones_like(emission), emission])  # state, position, chain
        forward = np.empty_like(state)
        forward[:, 0] = state[:, 0] / state[:, 0].sum(axis=0)
        for at in range(1, positions):
            now = np.einsum("ac,ab->bc", forward[:, at - 1], moves) * state[:, at]
            forward[:, at] = now / now.sum(axis=0)
        back, total = np.full((2, chains), 0.5), np.zeros((2, 2))
        for at in range(positions - 1, 0, -1):
            ahead = state[:, at] * back
            joint = forward[:, at - 1][:, None] * moves[:, :, None] * ahead[None]
            total += ((joint / joint.sum(axis=(0, 1))) * weight).sum(axis=2)
            back = np.einsum("bc,ab->ac", ahead, moves)
            back /= back.sum(axis=0)
        return total


def _stretches(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """classes, labels (bytes, STRETCH each) of all stretches of `rows`."""
    held = _held(lexicon)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if held is None else Classes(held)
        for batch in batches:
            found, marked = [], []
            for classes, toxic in zip(_classes_of(batch, batch["text"].to_pylist(), table), batch["toxic"].to_pylist()):
                classes = np.concatenate([classes, np.zeros(-len(classes) % STRETCH, np.int8)])
                marks = ((classes > 0) & bool(toxic)).astype(np.int8)
                for at in range(0, len(classes), STRETCH):
                    found.append(classes[at : at + STRETCH].tobytes())
                    marked.append(marks[at : at + STRETCH].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(marked, pa.binary())], names=["classes", "labels"])

    known = rows if held is not None else _joined(rows, lexicon)
    return known.mapInArrow(cut, "classes binary, labels binary")


def sampled(kinds: DataFrame, size: int) -> pd.DataFrame:
    """At most `size` kinds, with `weight`. `kinds`: classes, labels, times.

    A kind's priority is its times over a uniform number of its own. The kinds of the highest priorities are taken, and each stands for its
    times or the first priority that was not taken, whichever is more; sums over the sample are right on average.
    """
    uniform = (F.shiftright(F.xxhash64("classes", "labels"), 11) + 2**52 + 1) / F.lit(float(2**53))
    ranked = kinds.withColumn("priority", F.col("times") / uniform).orderBy(F.desc("priority"), "classes", "labels")
    found = ranked.limit(size + 1).toPandas().sort_values("priority", ascending=False, kind="stable")
    least = found["priority"].iloc[size] if len(found) > size else 0.0
    return found.iloc[:size].assign(weight=lambda some: np.maximum(some["times"].to_numpy(float), least))


def train(rows: DataFrame) -> tuple[DataFrame, Chain] | None:
    """The lexicon of all training rows and the fitted chain; None if there is nothing to tell apart. `rows`: stored."""
    totals = {row["half"]: (row["toxic"], row["clean"]) for row in rows.groupBy("half").agg(
        F.count_if(F.col("toxic") > 0).alias("toxic"), F.count_if(F.col("toxic") <= 0).alias("clean")).collect()}
    toxic, clean = (sum(pair[i] for pair in totals.values()) for i in (0, 1))
    if not toxic or not clean:
        return None
    rows = rows.withColumn("row", F.monotonically_increasing_id()).repartition(-(-(toxic + clean) // TASK_ROWS), "row")
    counts = stored(word_counts(rows.select("text", "toxic", "half")), "words")
    halves = {half: _lexicon(counts.where(F.col("half") == half), totals.get(half, (0, 0))) for half in (0, 1)}
    whole = counts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # A row's classes come from the other half's lexicon.
    parts = (_stretches(rows.where(F.col("half") == half), halves[1 - half]) for half in (0, 1))
    kinds = next(parts).unionByName(next(parts)).groupBy("classes", "labels").agg(F.count("*").alias("times"))
    sample = sampled(stored(kinds, "stretches"), CHAINS)
    chain = Chain()
    if len(sample):
        stack = [np.frombuffer(b"".join(sample[name].map(bytes)), np.int8).reshape(-1, STRETCH) for name in ("classes", "labels")]
        chain.fit(*stack, sample["weight"].to_numpy(float))
    return _lexicon(whole, (toxic, clean)), chain


def _groups(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Numbers of chains in descending order of length, so many at a time that their table stays small."""
    order = np.argsort(-lengths, kind="stable")
    order = order[lengths[order] > 0]
    at = 0
    while at < len(order):
        size = max(1, CELLS // int(lengths[order[at]]))
        yield order[at : at + size]
        at += size


def score(docs: DataFrame, model: tuple[DataFrame, Chain] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, score, spans (array of start, end, score; offsets in characters)."""
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())])
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_col].dataType), T.StructField("score", T.DoubleType()), T.StructField("spans", T.ArrayType(span))]
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    if model is None:
        return rows.select("id", F.lit(0.0).alias("score"), F.array().cast(T.ArrayType(span)).alias("spans"))
    lexicon, chain = model
    odds, moves, held = chain.table(), np.exp(chain.moves), _held(lexicon)

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if held is None else Classes(held)
        for batch in batches:
            texts = batch["text"].to_pylist()
            found = [_inputs(classes) for classes in _classes_of(batch, texts, table)]
            lengths = np.array([len(one) for one in found], np.int64)
            scores, spans = np.zeros(len(texts)), [[] for _ in texts]
            for group in _groups(lengths):
                emission = np.ones((lengths[group[0]], len(group)))
                for column, number in enumerate(group):
                    emission[: lengths[number], column] = odds[found[number]]
                likely = marginals(emission, moves, lengths[group])
                scores[group] = likely.max(axis=0)
                for column in np.flatnonzero(scores[group] >= TOXIC):
                    number = group[column]
                    spans[number] = _spans(texts[number], likely[: lengths[number], column])
            columns = [batch["id"], pa.array(scores), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "score", "spans"])

    if held is None:
        rows = _joined(stored(rows.withColumn("row", F.monotonically_increasing_id()), "scored"), lexicon)
    return rows.mapInArrow(tag, schema)


def _spans(text: str, likely: np.ndarray) -> list[dict]:
    """Neighbouring words of at least TOXIC, as one span each."""
    found, last = [], -2
    for place, (match, p) in enumerate(zip(_WORDS.finditer(text), likely)):
        if p >= TOXIC:
            if place == last + 1:
                found[-1]["end"] = match.end()
                found[-1]["score"] = max(found[-1]["score"], float(p))
            else:
                found.append({"start": match.start(), "end": match.end(), "score": float(p)})
            last = place
    return found
