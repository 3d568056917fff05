"""From hourly scores and content catalogues to the enriched result."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from placelens.operators.enrichment import priority_enrich
from placelens.session import written
from placelens.sources.partitions import day_range, one_hour
from placelens.sources.tsv import CRAWLER, SHORT_VIDEO, VIDEO, catalogue_lines, score_lines

# Fixed value: a catalogue covers the day of the run and this many days before it.
DAYS_BACK = 4


@dataclass(frozen=True)
class ScoreInputs:
    """Root folders of the text tables."""

    scores: str
    crawler: str
    video: str
    short_video: str


def score_enrichment(
    spark: SparkSession,
    run: str,
    inputs: ScoreInputs,
    dedup: bool = False,
    keep_empty: bool = False,
    seen: dict[str, Observation] | None = None,
) -> DataFrame:
    """Scores of the hour `run` (yyyyMMddHH) with title, type and URL; crawler wins over video over short video.

    Each catalogue is parsed once and kept as a table, because picking the winners reads it twice. `seen` counts the lines of each
    input (named like the fields of `ScoreInputs`) that were kept and dropped, in the passes that read them.
    """
    day, seen = run[:8], seen or {}
    layouts = {"crawler": CRAWLER, "video": VIDEO, "short_video": SHORT_VIDEO}
    catalogues = [
        written(catalogue_lines(day_range(spark, getattr(inputs, name), day, DAYS_BACK), layout, seen.get(name)), "catalogue")
        for name, layout in layouts.items()
    ]
    scores = score_lines(one_hour(spark, inputs.scores, run), run, seen.get("scores"))
    return priority_enrich(scores, catalogues, dedup, keep_empty)
