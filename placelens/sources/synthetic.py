"""Pseudo-random messages for feeding the token stream."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters messages are made of and the greatest message length.
ALPHABET = ("a", "b", " ")
LONGEST = 9


def _draw(seed: Column, turn: int, choices: int) -> Column:
    """A number below `choices` from the digest of seed and turn; the same on every attempt."""
    digest = F.md5(F.concat_ws("-", seed.cast("string"), F.lit(str(turn))))
    return F.conv(F.substring(digest, 1, 6), 16, 10).cast("int") % choices


def token_messages(rows: DataFrame, seed: str) -> DataFrame:
    """One message of 1 to 9 characters per row, fixed by the row's seed.

    Works on any table, `spark.range` or the streaming `rate` source.
    """
    length = _draw(F.col(seed), 0, LONGEST) + 1
    letters = F.array(*(F.lit(letter) for letter in ALPHABET))
    drawn = [
        F.when(length >= turn, F.get(letters, _draw(F.col(seed), turn, len(ALPHABET))))
        for turn in range(1, LONGEST + 1)
    ]
    return rows.select(F.col(seed), F.concat_ws("", *drawn).alias("value"))
