"""A change log as a stream: each micro-batch is folded to its newest changes and added to the store; rollups beside it.

Batches carry their number into the store, where a batch that runs again replaces itself: together with the checkpoint
the result is the same as if each had run once. Order needs no watermark, since a change's version, not its arrival,
decides.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidelog.store.table import Store


def apply_stream(
    changes: DataFrame, store: Store, checkpoint: str, interval: str | None = None, also: Callable[[DataFrame, int], None] | None = None
) -> StreamingQuery:
    """Starts applying a stream of store rows. Without an interval it takes what is there now and ends.

    also runs on each batch as it came, before it is folded, for instance Rollup.add.
    """

    def batch(rows: DataFrame, number: int) -> None:
        rows.persist()
        try:
            if also:
                also(rows, number)
            store.append(rows, number)
        finally:
            rows.unpersist()

    writer = changes.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


class Rollup:
    """Counts per group kept as partial counts, one part per batch, and added up when read.

    It counts the versions it is given: a row that is updated counts again, as it does in an insert-triggered view.
    """

    def __init__(self, root: str, group: dict[str, str]) -> None:
        self.root, self.group = root.rstrip("/"), group

    def _partial(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*[F.expr(e).alias(n) for n, e in self.group.items()]).agg(F.count(F.lit(1)).alias("n"))

    def add(self, rows: DataFrame, batch: int | str) -> None:
        self._partial(rows).write.mode("overwrite").parquet(f"{self.root}/batch={batch}")

    def read(self, spark) -> DataFrame:  # noqa: ANN001
        return spark.read.parquet(self.root).groupBy(*self.group).agg(F.sum("n").alias("n"))


def windowed_counts(stream: DataFrame, at: str, size: str, late: str, group: Sequence[str] = ()) -> DataFrame:
    """Counts per tumbling window of event time; rows later than `late` are left out, so that state stays bounded."""
    return stream.withWatermark(at, late).groupBy(F.window(at, size), *group).agg(F.count(F.lit(1)).alias("n"))
