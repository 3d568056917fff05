"""Keys that tie a log URL to a piece of content."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fewest digits of a content id on the slot side and on the log side.
SLOT_ID_DIGITS = 15
LOG_ID_DIGITS = 1

# Fixed value: the log-side id search starts after this many characters.
SEARCH_OFFSET = 2


def _id_pattern(digits: int) -> str:
    return rf"([a-zA-Z]?[0-9]{{{digits},}}).html"


def url_id(url: Column, digits: int) -> Column:
    """The first id in front of `.html`: one optional letter and at least `digits` digits, else ''."""
    return F.regexp_extract(url, _id_pattern(digits), 1)


def strip_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def url_key(url: Column, digits: int = LOG_ID_DIGITS) -> Column:
    """The id, or the URL without its query string where there is none."""
    return F.coalesce(F.nullif(url_id(url, digits), F.lit("")), strip_query(url))


def url_key_offset(url: Column, digits: int = LOG_ID_DIGITS) -> Column:
    """The id found from the search offset on; '' (never NULL) where there is none."""
    return F.coalesce(url_id(F.substr(url, F.lit(SEARCH_OFFSET + 1)), digits), F.lit(""))
