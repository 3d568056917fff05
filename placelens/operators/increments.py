"""Page views and unique visitors of a day, kept up to date by the report's ten-minute runs.

A run counts only the log rows of its own ten minutes, per slot and visitor, and publishes them as one part. Such an increment is an exact, mergeable set:
the visitors of a slot with how often each came. The day's unique visitors are those of the union of its increments, so no run reads what an earlier one has
counted, and the log of the day is read once in all. A run that is delivered again replaces its own part, and changes nothing.

Intervals are taken as they are when a run is delivered. Where an edit has changed a slot's interval since, the runs that counted it as it was are delivered again.

An increment has at most as many rows as its minutes have log rows; increments of a busy slot are spread over tasks by visitor when they are merged.
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placelens.functions.dates import RUN_SECONDS, run_bounds
from placelens.operators.attribution import INTERVAL, SLOT_KEYS, traffic, visitor_views
from placelens.sinks import snapshots


def run_window(run: str, seconds: int = RUN_SECONDS) -> tuple[int, int, str]:
    """Epoch bounds [from, to) and day tag of the log rows that a run counts: its last `seconds`, from midnight on at the earliest."""
    begin, end, day = run_bounds(run)
    return max(begin, end - seconds), end, day


def part_name(run: str) -> str:
    """The part a run publishes: its day and the second it ends at. Runs that round to the same report time are the same run."""
    _, end, day = run_bounds(run)
    return f"{day}-{end}"


def runs_of(day: str, seconds: int = RUN_SECONDS) -> list[str]:
    """The runs of a day, first to last; the last one is at the next midnight."""
    start = dt.datetime.strptime(day, "%Y%m%d")
    return [(start + dt.timedelta(seconds=after)).strftime("%Y%m%d%H%M%S") for after in range(seconds, 86_401, seconds)]


def increment(
    slots: DataFrame, logs: dict[str, DataFrame], run: str, keys: list[str] = SLOT_KEYS, seconds: int = RUN_SECONDS, right_open: bool = False
) -> DataFrame:
    """keys, interval, log, visitor, views (how often) of the rows that `run` counts. `logs` as of `slot_traffic`."""
    begin, end, _ = run_window(run, seconds)
    own = (F.col("dateline") >= begin) & (F.col("dateline") < end)
    return visitor_views(slots, {name: log.where(own) for name, log in logs.items()}, keys, (begin, end - 1), right_open)


def deliver(
    path: str, slots: DataFrame, logs: dict[str, DataFrame], run: str, keys: list[str] = SLOT_KEYS, seconds: int = RUN_SECONDS, right_open: bool = False
) -> None:
    """Publish the increment of a run, in place of an earlier delivery."""
    rows = increment(slots, logs, run, keys, seconds, right_open)
    snapshots.publish(rows.withColumn("run", F.lit(part_name(run))), path, "run", [part_name(run)])


def _schema(keys: list[str]) -> str:
    columns = [f"{key} string" for key in keys] + [f"{name} bigint" for name in INTERVAL]
    return ", ".join([*columns, "log string", "visitor string", "views bigint"])


def day_increments(spark: SparkSession, path: str, day: str, keys: list[str] = SLOT_KEYS) -> DataFrame:
    """All increments of a day as they are now, with their run."""
    runs = [part for part in snapshots.versions(spark, path) if part.startswith(f"{day}-")]
    return snapshots.read(spark, path, _schema(keys), runs, part_col="run")


def day_traffic(spark: SparkSession, path: str, day: str, names: list[str], keys: list[str] = SLOT_KEYS) -> DataFrame:
    """PV and UV of every slot interval of a day, merged from its increments; `names` are those of the logs."""
    merged = day_increments(spark, path, day, keys).groupBy(*keys, *INTERVAL, "log", "visitor").agg(F.sum("views").alias("views"))
    return traffic(merged, names, keys)
