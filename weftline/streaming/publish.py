"""Publishers of training records, fed by micro-batches; an error of one keeps none of the others from their records."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weftline.operators.evaluate import published
from weftline.operators.logs import training_epochs
from weftline.streaming.events import assemble_stream

log = logging.getLogger(__name__)


class Publisher:
    """What takes records. Each method may be left out; `batch` is the same number when a batch is sent again."""

    def open(self) -> None: ...

    def training(self, records: DataFrame, batch: int) -> None: ...

    def validation(self, records: DataFrame, batch: int) -> None: ...

    def metrics(self, records: DataFrame) -> None: ...

    def close(self) -> None: ...


class Csv(Publisher):
    """Records as CSV files, a folder a batch: one that is sent again is written over, not beside."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def _write(self, records: DataFrame, kind: str, batch: int) -> None:
        records.write.mode("overwrite").csv(f"{self.folder}/{kind}/batch={batch}", header=True)

    def training(self, records: DataFrame, batch: int) -> None:
        self._write(records, "training", batch)

    def validation(self, records: DataFrame, batch: int) -> None:
        self._write(records, "validation", batch)

    def metrics(self, records: DataFrame) -> None:
        self._write(records, "metrics", 0)


class Scalars(Publisher):
    """(tag, step, value, wall) rows as Parquet, the form in which dashboards take scalars; nulls are left out."""

    def __init__(self, folder: str, step: str = "up", wall: str | None = None) -> None:
        self.folder, self.step, self.wall = folder, step, wall

    def _write(self, records: DataFrame, kind: str, batch: int) -> None:
        scalars(records, self.step, kind, self.wall).write.mode("overwrite").parquet(f"{self.folder}/{kind}/batch={batch}")

    def training(self, records: DataFrame, batch: int) -> None:
        self._write(records, "train", batch)

    def validation(self, records: DataFrame, batch: int) -> None:
        self._write(records, "valid", batch)


def scalars(records: DataFrame, step: str, prefix: str, wall: str | None = None) -> DataFrame:
    """(tag, step, value, wall) of every number in records that isn't null; wall is null without a column of times."""
    numbers = [f.name for f in records.schema if f.dataType.simpleString() in ("bigint", "int", "double", "float")]
    kept = records.select(step, *(c for c in numbers if c not in (step, wall)), (F.col(wall) if wall else F.lit(None)).cast("timestamp").alias("_wall"))
    one = published(kept.select(F.struct(step, "_wall").alias("_at"), *(c for c in kept.columns if c not in (step, "_wall"))), "_at", prefix)
    return one.select(F.col("key").alias("tag"), F.col(f"step.{step}").alias("step"), "value", F.col("step._wall").alias("wall"))


def each(publishers: Sequence[Publisher], what: str, *args) -> list[tuple[str, Exception]]:
    """Calls a method of all publishers; returns whose failed and how, after all were called."""
    failed = []
    for p in publishers:
        try:
            getattr(p, what)(*args)
        except Exception as error:  # noqa: BLE001
            log.error("%s of %s failed: %s", what, type(p).__name__, error)
            failed.append((type(p).__name__, error))
    return failed


def publish(lines: DataFrame, publishers: Sequence[Publisher], checkpoint: str, once: bool = False, give_up_ms: int | None = 3_600_000) -> list[StreamingQuery]:
    """Starts two streams of log lines (a column text) to publishers: training records, and validation records as they get complete.

    checkpoint is a shared folder; streams that start again with it go on behind their last batch. `once` stops when what
    is there has been read; values of records that are incomplete by then wait in the checkpoint.
    """
    each(publishers, "open")

    def sender(what: str):
        def send(batch: DataFrame, number: int) -> None:
            kept = batch.persist()
            try:
                if not kept.isEmpty():
                    each(publishers, what, kept, number)
            finally:
                kept.unpersist()

        return send

    out = []
    for what, records in (("training", training_epochs(lines)), ("validation", assemble_stream(lines, None if once else give_up_ms))):
        writer = records.writeStream.foreachBatch(sender(what)).outputMode("append").option("checkpointLocation", f"{checkpoint}/{what}")
        out.append((writer.trigger(availableNow=True) if once else writer).start())
    return out
