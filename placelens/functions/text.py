"""Text, number and null expressions."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns that decide which texts count as integers, clean tokens or date suffixes.
INTEGER_PATTERN = r"^[-+]?[0-9]*\z"
CLEAN_TOKEN_PATTERN = r"^[a-zA-Z0-9|_-]*\z"
DATE_SUFFIX_PATTERN = r"(?:[0-9]{2}|\+[0-9]|-0)(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])"

# Fixed value: the text that log writers put in place of a missing visitor.
MISSING_TEXT = "null"


def java_split(text: Column, separator: str) -> Column:
    """Split on one literal character as the JDK does: trailing empty parts are dropped.

    Text made only of separators has no parts; empty text has one empty part.
    """
    trimmed = F.rtrim(text, F.lit(separator))
    no_parts = F.array().cast("array<string>")
    return F.when((text != "") & (trimmed == ""), no_parts).otherwise(F.split(trimmed, re.escape(separator)))


def is_integer(text: Column) -> Column:
    """Optional sign and digits; the empty text and a bare sign also pass."""
    return text.rlike(INTEGER_PATTERN)


def is_clean_token(text: Column) -> Column:
    return text.rlike(CLEAN_TOKEN_PATTERN)


def trim_date_suffix(text: Column, times: int = 1) -> Column:
    """Drop a trailing yyMMdd, up to `times` times; something must remain in front of it."""
    return F.regexp_replace(text, rf"^(?s)(.+?)(?:{DATE_SUFFIX_PATTERN}){{1,{times}}}\z", "$1")


def trim_special(text: Column) -> Column:
    """Remove backslashes and single quotes."""
    return F.replace(F.replace(text, F.lit("\\")), F.lit("'"))


def null_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def parse_double(text: Column) -> Column:
    """JDK-style decimal parse, NULL where it fails.

    Spark also takes `inf` and any letter case of the special words, the JDK does not.
    """
    lowered = F.lower(text)
    special = lowered.contains("inf") | lowered.contains("nan")
    exact = text.contains("Infinity") | text.contains("NaN")
    return F.when(~special | exact, text.try_cast("double"))


def is_present(visitor: Column) -> Column:
    """Visitor ids count as missing when NULL, empty or the text `null`."""
    return visitor.isNotNull() & ~visitor.isin("", MISSING_TEXT)


def attributable(url_from: Column, url_to: Column) -> Column:
    """A click from a page slot to an article: the target is a URL, the origin is not."""
    return url_to.startswith("http") & ~url_from.startswith("http")
