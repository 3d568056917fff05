"""Page views and unique visitors of a log stream, per place and window of event time.

Two stateful steps follow each other. The first keeps one state row for each (window, place, visitor), so a visitor who comes again in a
window is counted once, however far apart the micro-batches are; the second adds them up per (window, place). Both drop their
state, and give out a window's row, once the watermark has passed the window's end; rows that come later than that are dropped. State
is partitioned by place and visitor, so a busy place is spread over all tasks.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from placelens.operators.attribution import SLOT_KEYS
from placelens.sinks import snapshots

# Fixed value: the report interval.
WINDOW = "10 minutes"
DELAY = "1 hour"


def windowed_traffic(log: DataFrame, keys: list[str] = SLOT_KEYS, window: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """from_second, to_second, keys, pv, uv of every window that is complete; `log` has the keys, `visitor` and `dateline`.

    A row counts if it comes before the stream's latest event time is `delay` past the end of its window.
    """
    timed = log.withColumn("at", F.timestamp_seconds("dateline")).withWatermark("at", delay)
    per_visitor = timed.groupBy(F.window("at", window), *keys, "visitor").agg(F.count("*").alias("views"))
    again = F.window(F.window_time("window"), window).alias("window")
    totals = per_visitor.groupBy(again, *keys).agg(F.sum("views").alias("pv"), F.count("visitor").alias("uv"))
    return totals.select(
        F.unix_timestamp("window.start").alias("from_second"), F.unix_timestamp("window.end").alias("to_second"), *keys, "pv", "uv"
    )


def run(totals: DataFrame, path: str, checkpoint: str, trigger: str | None = None) -> StreamingQuery:
    """Publish the windows that each micro-batch completes as a part of its own; a batch that is repeated counts once.

    Without a trigger everything available is processed and the query ends; windows that are not complete wait in the state for the next start.
    """

    def commit(rows: DataFrame, batch_id: int) -> None:
        part = f"batch-{batch_id:012}"
        snapshots.publish(rows.withColumn("batch", F.lit(part)), path, "batch", [part], version=str(batch_id))

    writer = totals.writeStream.outputMode("append").foreachBatch(commit).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()
