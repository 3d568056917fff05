"""Token counts of a message stream, counted anew in every micro-batch."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from placelens.operators.tokens import token_count

# Fixed value: the pace of the micro-batches.
TRIGGER = "3 seconds"


def start(
    messages: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: str | None = TRIGGER,
) -> StreamingQuery:
    """Count the tokens of each batch by itself and hand them to `sink(counts, batch_id)`.

    Without a trigger everything available is processed and the query ends. `sink` may see a batch
    again after a failure and must replace what it wrote for that batch.
    """
    writer = messages.writeStream.foreachBatch(
        lambda batch, batch_id: sink(token_count(batch), batch_id)
    ).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    return writer.start()


def show(rows: int) -> Callable[[DataFrame, int], None]:
    """A sink that prints some pairs of every batch and keeps none."""

    def print_some(counts: DataFrame, batch_id: int) -> None:
        print(f"batch {batch_id}")
        counts.show(rows, truncate=False)

    return print_some


def batch_files(path: str) -> Callable[[DataFrame, int], None]:
    """A sink that keeps one folder per batch; a repeated batch overwrites its own folder."""

    def write(counts: DataFrame, batch_id: int) -> None:
        counts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
