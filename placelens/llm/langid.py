"""Language ID by rank-order profiles.

A language's profile is the list of its `PROFILE` most frequent n-grams (1 to 3 characters of lower-cased words, with word ends
marked) in order of frequency (equally frequent ones by code point), counted over all training rows. A document's own most frequent n-grams are ranked the same way over its
whole text; its distance to a language is the sum of how far out of place each of them is there, `PROFILE` for one that the profile
lacks. The nearest language is predicted, with a score of 1 minus its distance over the largest possible distance.

An n-gram is kept as one number of 21 bits for each character, so a document's n-grams are counted by sorting numbers. Counting is done
per task first, then summed by (language, n-gram). Only profiles reach the driver: `PROFILE` rows for each language, however many
there are. All of them are predicted with: a worker holds an index from each profile n-gram to the languages that rank it, `PROFILE` entries for each
language, and a document adds up what its n-grams save each language against lacking them.

A filter can go by the prediction (`accepted`): documents whose score is below `RESEMBLES` look like no language there is a profile of, and with `keep` only
documents predicted to be of those languages stay.

Defined results: `und` with score 0 for a text that is null or has no letter, and for every text if there is nothing to learn from;
training rows with a null language or text are left out; equal distances go to the language that sorts first; repeated
rows count as often as they come; an empty table gives no rows; other columns are not looked at, whatever their names.
"""

from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

PROFILE = 400
UNKNOWN = "und"
#: Least score of a document that resembles a learned language.
RESEMBLES = 0.1
#: Marks the ends of words. Bits of a character in an n-gram's number.
END, WIDTH = ord("_"), 21
#: Counted n-grams that a task holds before it sums them up, and summed ones before it hands them on.
HELD = 2_000_000


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(code).isalpha() for code in range(0x110000)), bool, 0x110000)


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of all words of a text, in ascending order, and how often each occurs."""
    codes = np.frombuffer(f"_{(text or '').lower()}_".encode("utf-32-le", "surrogatepass"), "<u4")
    letter = _letters()[codes]
    marked = np.where(letter, codes, END).astype(np.int64)
    one, two = marked[letter], (marked[:-1] << WIDTH | marked[1:])[letter[:-1] | letter[1:]]
    three = (marked[:-2] << 2 * WIDTH | marked[1:-1] << WIDTH | marked[2:])[letter[1:-1]]
    return _summed(np.concatenate([one, two, three]))


def _summed(numbers: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, ascending, and the sum of their counts (one each without `counts`)."""
    if counts is None:
        numbers = np.sort(numbers)
        first = np.flatnonzero(np.diff(numbers, prepend=-1))
        return numbers[first], np.diff(first, append=len(numbers))
    order = np.argsort(numbers, kind="stable")
    numbers, first = numbers[order], np.flatnonzero(np.diff(numbers[order], prepend=-1))
    return numbers[first], np.add.reduceat(counts[order], first) if len(first) else counts[:0]


def spelled(gram: int) -> str:
    """An n-gram's characters."""
    codes = [gram >> 2 * WIDTH, gram >> WIDTH & (1 << WIDTH) - 1, gram & (1 << WIDTH) - 1]
    return "".join(chr(code) for code in codes if code)


def profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, list[int]]:
    """Language -> its n-grams, most frequent first. `docs`: the training rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def sum_up():
            nonlocal size
            for lang, parts in held.items():
                held[lang] = [_summed(*map(np.concatenate, zip(*parts)))]
            size = sum(len(parts[0][0]) for parts in held.values())

        def handed_on():
            sum_up()
            langs = [lang for lang, parts in held.items() for _ in range(len(parts[0][0]))]
            numbers, counts = (np.concatenate([np.empty(0, np.int64), *(parts[0][i] for parts in held.values())]) for i in (0, 1))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(numbers), pa.array(counts)], names=["lang", "gram", "n"]
            )

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"]):
                found = grams(text.as_py())
                held.setdefault(lang.as_py(), []).append(found)
                size += len(found[0])
                if size > HELD:
                    sum_up()
                    if size > HELD // 2:
                        yield handed_on()
                        size = 0
        yield handed_on()

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).dropna()
    counted = rows.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counted.withColumn("place", place).where(F.col("place") <= PROFILE)
    found: dict[str, list[tuple[int, int, int]]] = {}
    for row in top.collect():  # PROFILE rows a language
        found.setdefault(row["lang"], []).append((row["place"], row["gram"], row["n"]))
    return {lang: [gram for _, gram, _ in sorted(found[lang])] for lang in sorted(found)}


class RankOrder:
    """Predicts with given profiles."""

    def __init__(self, learned: dict[str, list[int]]):
        self.languages = list(learned)
        sizes = [len(ranked) for ranked in learned.values()]
        ranked = np.fromiter((gram for grams_ in learned.values() for gram in grams_), np.int64, sum(sizes))
        order = np.argsort(ranked, kind="stable")
        self.known, starts = np.unique(ranked[order], return_index=True)
        self.starts = np.append(starts, len(ranked))
        self.speakers = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)[order]
        self.places = np.concatenate([np.empty(0, np.int32), *(np.arange(size, dtype=np.int32) for size in sizes)])[order]

    def predict(self, text: str | None) -> tuple[str, float]:
        found, counts = grams(text)
        if not len(found) or not len(self.languages):
            return UNKNOWN, 0.0
        if len(found) > PROFILE:
            often = counts >= -np.partition(-counts, PROFILE - 1)[PROFILE - 1]
            found, counts = found[often], counts[often]
        here = found[np.argsort(-counts, kind="stable")][:PROFILE]
        at = np.minimum(np.searchsorted(self.known, here), len(self.known) - 1)
        ranks = np.flatnonzero(self.known[at] == here)
        begins = self.starts[at[ranks]]
        sizes = self.starts[at[ranks] + 1] - begins
        entries = np.arange(sizes.sum()) + np.repeat(begins - np.cumsum(sizes) + sizes, sizes)
        saved = PROFILE - np.abs(self.places[entries] - np.repeat(ranks, sizes))
        by_language = np.bincount(self.speakers[entries], saved, len(self.languages))
        best = int(by_language.argmax())
        return self.languages[best], float(by_language[best]) / (PROFILE * len(here))


def _guessed(docs: DataFrame, learned: dict[str, list[int]], columns: list, text_col: str) -> DataFrame:
    """`columns` of `docs`, _guess (lang_pred, score, lettered). Profiles go to the tasks with the function: PROFILE n-grams a language."""

    @F.pandas_udf("lang_pred string, score double, lettered boolean")
    def guess(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = RankOrder(learned)
        for batch in texts:
            found = [(*model.predict(text), any(map(str.isalpha, (text or "").lower()))) for text in batch]
            yield pd.DataFrame(found, columns=["lang_pred", "score", "lettered"])

    return docs.select(*columns, guess(F.col(text_col)).alias("_guess"))


def predict(docs: DataFrame, learned: dict[str, list[int]], columns: list, text_col: str = "text") -> DataFrame:
    """`columns` of `docs`, lang_pred, score."""
    guessed = _guessed(docs, learned, columns, text_col)
    return guessed.select(*guessed.columns[:-1], "_guess.lang_pred", "_guess.score")


def accepted(
    docs: DataFrame, learned: dict[str, list[int]], keep: set[str] | None = None, least: float = RESEMBLES, text_col: str = "text"
) -> DataFrame:
    """The rows of `docs` with a letter whose prediction scores at least `least` and is in `keep` (any language without it).

    If nothing was learned, no prediction can tell, and all rows with a letter stay.
    """
    whole = docs.select(F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"))
    told = F.col("_guess.score") >= least
    if keep is not None:
        told = told & F.col("_guess.lang_pred").isin(sorted(keep))
    fits = F.col("_guess.lettered") & told if learned else F.col("_guess.lettered")
    return _guessed(whole, learned, ["row"], f"row.{text_col}").where(fits).select("row.*")
