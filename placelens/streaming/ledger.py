"""Results of micro-batches, committed in one step with a record of the messages they were made from.

The checkpoint of a stream knows which messages a batch had, and a sink may see a batch again after a failure. Here the batch's result and its
ledger, a row for each source with the first and last position and the number of messages, become visible by one commit named by the
batch (`sinks.snapshots`). A batch that failed before its commit left nothing to see and is committed when it is repeated; one that failed after it
is recognised and skipped. So every message counts once, and the ledger shows which have.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from placelens.sinks import snapshots

LEDGER = "ledger"
LEDGER_SCHEMA = "source string, first bigint, last bigint, messages bigint"


def part_name(batch_id: int) -> str:
    return f"batch-{batch_id:012}"


def commit(batch: DataFrame, compute: Callable[[DataFrame], DataFrame], path: str, batch_id: int) -> bool:
    """Commit `compute(batch)` and the ledger of `batch`; whether there was anything to do. `batch`: source, position and the message."""
    part = part_name(batch_id)
    ranges = batch.groupBy("source").agg(F.min("position").alias("first"), F.max("position").alias("last"), F.count("*").alias("messages"))
    result = compute(batch.drop("source", "position")).withColumn("batch", F.lit(part))
    beside = {LEDGER: ranges.withColumn("batch", F.lit(part))}
    return snapshots.publish(result, path, "batch", [part], version=str(batch_id), beside=beside) is not None


def start(
    messages: DataFrame, compute: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, trigger: str | None = None
) -> StreamingQuery:
    """Run `compute` on every micro-batch of `messages` and commit what it gives. Without a trigger everything available is processed."""
    writer = messages.writeStream.foreachBatch(lambda batch, batch_id: commit(batch, compute, path, batch_id) and None)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)).start()


def results(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of all committed batches, with their batch."""
    return snapshots.read(spark, path, schema, part_col="batch")


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The ledger: batch, source, first, last, messages of every committed batch that had a result."""
    return snapshots.read(spark, path, LEDGER_SCHEMA, part_col="batch", name=LEDGER)
