"""Tab-separated lines read by position; unusable lines are dropped."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from placelens.functions.text import java_split, parse_double
from placelens.functions.urls import url_key_offset
from placelens.operators.observed import kept_and_dropped


@dataclass(frozen=True)
class Layout:
    """0-based positions of the columns a catalogue needs."""

    url: int
    title: int
    typepy: int

    @property
    def parts(self) -> int:
        return max(self.url, self.title, self.typepy) + 1


# The column positions of the three catalogues.
VIDEO = Layout(url=23, title=12, typepy=7)
CRAWLER = Layout(url=1, title=2, typepy=9)
SHORT_VIDEO = Layout(url=6, title=4, typepy=9)


def _cells(lines: DataFrame) -> DataFrame:
    """Split every line once: filters on the cells do not move below the generator and split again."""
    return lines.withColumn("_cells", F.explode(F.array(java_split(F.col("value"), "\t"))))


def _cell(position: int) -> Column:
    return F.get("_cells", F.lit(position))


def catalogue_lines(lines: DataFrame, layout: Layout, seen: Observation | None = None) -> DataFrame:
    """`title, typepy, url, urlid` of every line that reaches the last needed column.

    Trailing empty columns count as absent. A URL of one character is too short for the id search and
    drops the line; an empty URL stays and has the empty id. `seen` counts the lines kept and dropped.
    """
    url = _cell(layout.url)
    usable = (F.size("_cells") >= layout.parts) & (F.length(url) != 1)
    return kept_and_dropped(_cells(lines), usable, seen).where(usable).select(
        _cell(layout.title).alias("title"),
        _cell(layout.typepy).alias("typepy"),
        url.alias("url"),
        url_key_offset(url).alias("urlid"),
    )


def score_lines(lines: DataFrame, run: str | None = None, seen: Observation | None = None) -> DataFrame:
    """`dt, hour, url, rate` from lines `id <tab> number`; bad numbers drop the line.

    Day and hour come from the run argument yyyyMMddHH or, without one, from the tag of the line. `seen` counts the lines kept and dropped.
    """
    tag = F.lit(run) if run else F.col("dt")
    parsed = _cells(lines).select(
        F.substring(tag, 1, 8).alias("dt"),
        F.substring(tag, 9, 2).alias("hour"),
        _cell(0).alias("url"),
        parse_double(_cell(1)).alias("rate"),
    )
    usable = F.col("rate").isNotNull()
    return kept_and_dropped(parsed, usable, seen).where(usable)
