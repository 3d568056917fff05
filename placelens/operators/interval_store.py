"""Version intervals kept in a table and brought up to date by the edits that arrive, instead of being built anew.

The table has a part for each day of edits (`sinks.snapshots`). An edit ends the version before it, and one that arrives late is ended by the version
after it. So the times of the edits of every entry that has new ones are put in order again, without their versions; where the
next edit of a time has become another one, its versions are reopened. Only parts with such a version or a new one are
written again, all in one step: a reader never sees a version that is still in force next to its successor. Edits that are in the table
already change nothing.

Of the table only keys and times are read, and the parts that change. A busy entry's times are sorted by many tasks (`next_times`).
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placelens.functions.dates import day_tag
from placelens.operators.joins import fits_broadcast, sized
from placelens.operators.versions import next_times, version_bounds
from placelens.session import written
from placelens.sinks import snapshots

PART = "edit_day"


def _without(rows: DataFrame, known: DataFrame) -> DataFrame:
    """The rows whose columns that `known` has too are no row of it; NULL is a value like others."""
    named = known.select(*(F.col(name).alias(f"_{name}") for name in known.columns))
    equal = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in known.columns]
    return rows.join(sized(named, fits_broadcast(named)), equal, "left_anti")


class IntervalStore:
    """A table of version intervals below `path`. `history` is the schema of edits; the other arguments are those of `version_intervals`."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        history: StructType | str,
        key: str | list[str] = "id",
        order: str = "modifydate",
        start: str = "starttime",
        end: str = "endtime",
        tie: str = "seq",
    ):
        self.spark, self.path, self.order, self.start, self.end, self.tie = spark, path, order, start, end, tie
        self.key = [key] if isinstance(key, str) else key
        empty = spark.createDataFrame([], history)
        self.columns = empty.columns
        self.schema = self._bounded(empty.withColumns({"_last": F.col(tie), "_next": F.col(order)})).schema

    def _bounded(self, rows: DataFrame) -> DataFrame:
        return version_bounds(rows, self.order, self.start, self.end, self.tie)

    def _day(self):
        return F.coalesce(day_tag(self.order), F.lit("none")).alias(PART)

    def read(self, days: list[str] | None = None) -> DataFrame:
        """All versions, or those edited on some days."""
        return snapshots.read(self.spark, self.path, self.schema, days)

    def merge(self, edits: DataFrame) -> list[str]:
        """Bring the table up to date with `edits`; the days whose parts were written again."""
        instant = [*self.key, self.order]
        same = [*instant, self.tie]
        stored = self.read().select(*same)
        new = written(_without(edits.select(*self.columns).dropDuplicates(same), stored), "new-edits")
        touched = new.select(*self.key).distinct()
        times = written(stored.join(sized(touched, fits_broadcast(touched)), self.key, "left_semi"), "touched-times")
        after = written(next_times(times.unionByName(new.select(*same)), self.key, self.order, self.tie), "next-times")
        changed = written(_without(after, next_times(times, self.key, self.order, self.tie)), "changed-times")
        found = changed.select(self._day()).unionByName(new.select(self._day())).distinct().collect()  # no more than days in the table
        days = sorted(row[PART] for row in found)
        if not days:
            return []
        kept = self.read(days)
        marked = changed.withColumn("_reopened", F.lit(True))
        old = kept.select(*self.columns, *(F.col(name).alias(f"_{name}") for name in self.schema.names if name not in self.columns))
        again = self._bounded(old.join(sized(marked, fits_broadcast(marked)), instant, "left"))
        bounds = {name: F.when(F.col("_reopened"), F.col(name)).otherwise(F.col(f"_{name}")) for name in self.schema.names if name not in self.columns}
        reopened = again.withColumns(bounds).select(*self.schema.names)
        fresh = self._bounded(new.join(sized(after, fits_broadcast(after)), instant, "left")).select(*self.schema.names)
        rows = reopened.unionByName(fresh)
        snapshots.publish(rows.withColumn(PART, self._day()), self.path, PART, days)
        return days
