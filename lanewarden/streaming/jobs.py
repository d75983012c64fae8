"""The streaming jobs, all in append mode over one watermark."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from lanewarden.operators.detect import ADJACENT, first_of
from lanewarden.operators.trips import enrich_crossings
from lanewarden.schemas import VIOLATION_COLUMNS
from lanewarden.sources.sinks import LedgerWriter
from lanewarden.settings import DEDUP_WINDOW, duration_minutes
from lanewarden.streaming.micro_batches import BatchDetector


def one_event_time(violations: DataFrame) -> DataFrame:
    """Leave the start as the only event time; recomputing the end takes its watermark mark away."""
    return violations.withColumn("timestamp_end", F.timestamp_micros(F.unix_micros("timestamp_end")))


def flag_once_live(violations: DataFrame) -> DataFrame:
    """At most one flag per plate while its state lasts; the first arrival wins.

    Retention is the watermark delay, and a key leaves only when a later batch moves the watermark
    past it. So repeats within the delay never pass, and later ones may still be held back: a feed
    for people, not the ledger. The ledger's exact form is :func:`ledger_stream`.
    """
    return one_event_time(violations).dropDuplicatesWithinWatermark(["car_plate"])


def ledger_stream(violations: DataFrame, window: str = DEDUP_WINDOW) -> DataFrame:
    """One violation per plate and tumbling window, emitted once when the window closes.

    The stream form of :func:`lanewarden.operators.dedup.first_per_plate_window`, for widths that
    divide an hour. State is one row per open window, and is evicted as the watermark passes.
    """
    first = first_of(violations, "car_plate", F.window("timestamp_start", f"{_streamed_minutes(window)} minutes"))
    return first.select(*VIOLATION_COLUMNS, F.col("_key1.start").alias("window_start"))


def _streamed_minutes(window: str) -> int:
    minutes = duration_minutes(window)
    if minutes < 1 or 60 % minutes:
        raise ValueError("a streamed window must be a whole number of minutes that divides an hour")
    return minutes


def append_table(stream: DataFrame, path: str, checkpoint: str, *, once: bool = False, name: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet table, exactly once per row."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    return _start(writer.option("path", path), once, name)


def start_detection(
    events: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    strategy: str = ADJACENT,
    once: bool = False,
    name: str | None = None,
    **options,
) -> StreamingQuery:
    """Both detectors on one read of ``events``; each batch's violations go to ``write(violations, batch_id)``.

    ``options`` are those of :class:`lanewarden.streaming.micro_batches.BatchDetector`. A batch that runs again
    hands over the same violations, so ``write`` should replace or ignore what it has of a batch.
    """
    return _start_batches(events, BatchDetector(f"{checkpoint}/crossings", write, strategy=strategy, **options), checkpoint, once, name)


def start_detector(
    events: DataFrame,
    ledger_path: str,
    checkpoint: str,
    *,
    strategy: str = ADJACENT,
    window: str = DEDUP_WINDOW,
    emit: str = "first-seen",
    publish: Callable[[DataFrame, int], None] | None = None,
    report: Callable[[dict], None] | None = None,
    once: bool = False,
    name: str | None = None,
    **options,
) -> StreamingQuery:
    """The whole job: detect, keep one violation per plate and window, write the ledger.

    ``emit="first-seen"`` stores a violation in the batch that detects it; of one plate and window the
    first batch wins, and its first row. ``"window-close"`` waits until no crossing to come can add to the
    window and stores its first row in event time. ``window`` divides an hour. ``report`` also gets the
    number of crossings left out as too ``late`` so far. ``options`` (span of a segment, delay, hot slices) are those of
    :class:`lanewarden.streaming.micro_batches.BatchDetector`.
    Stopping the job and starting it on the same checkpoint resumes from the stored offsets and crossings.
    """
    if emit not in ("first-seen", "window-close"):
        raise ValueError("emit is 'first-seen' or 'window-close'")
    _streamed_minutes(window)
    counted = report and (lambda counts: report({**counts, "late": detector.late}))
    detector = BatchDetector(
        f"{checkpoint}/crossings", LedgerWriter(ledger_path, window=window, publish=publish, report=counted),
        strategy=strategy, close_windows=window if emit == "window-close" else None, **options,
    )
    return _start_batches(events, detector, checkpoint, once, name)


def _start_batches(events: DataFrame, detector: BatchDetector, checkpoint: str, once: bool, name: str | None) -> StreamingQuery:
    return _start(events.writeStream.foreachBatch(detector).option("checkpointLocation", checkpoint), once, name)


def start_enrichment(
    raw: DataFrame,
    cameras: Callable[[SparkSession], DataFrame],
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    once: bool = False,
) -> StreamingQuery:
    """Enrich crossings from the camera table as it is at each batch, so new cameras need no restart."""

    def refresh(batch: DataFrame, batch_id: int) -> None:
        write(enrich_crossings(batch, cameras(batch.sparkSession)), batch_id)

    return _start(raw.writeStream.foreachBatch(refresh).option("checkpointLocation", checkpoint), once, None)


def _start(writer, once: bool, name: str | None) -> StreamingQuery:
    if name:
        writer = writer.queryName(name)
    return (writer.trigger(availableNow=True) if once else writer).start()


def run_paths(root: str, current: str | None = None, reset: bool = False) -> tuple[str, str, str]:
    """Run name, checkpoint path and ledger path; a reset takes a fresh name, so both start empty.

    The checkpoint and the ledger share the name, since either alone would be wrong: old offsets
    with an empty ledger lose violations.
    """
    run = current if current and not reset else f"run-{uuid.uuid4().hex[:12]}"
    return run, f"{root}/{run}/checkpoint", f"{root}/{run}/ledger"


PROGRESS = StructType(
    [
        StructField("query_id", StringType()),
        StructField("batch_id", LongType()),
        StructField("input_rows", LongType()),
        StructField("total_rows", LongType()),
        StructField("rows_per_second", DoubleType()),
        StructField("dropped_late", LongType()),
        StructField("idle", StringType()),
    ]
)


class ProgressLog(StreamingQueryListener):
    """One record per micro-batch, and an idle note after ``idle_after_s`` without input.

    Attach it as a listener, or :meth:`poll` queries for what they still remember. Spark counts input
    once for each time a plan reads it; the detector reads once. :meth:`flush` moves records to a table.
    """

    def __init__(self, idle_after_s: float = 30.0) -> None:
        self.idle_after_s = idle_after_s
        self.records: list[tuple] = []
        self._totals: dict[str, int] = {}
        self._newest: dict[str, int] = {}
        self._last_input = time.monotonic()

    def onQueryStarted(self, event) -> None:
        self._last_input = time.monotonic()

    def onQueryProgress(self, event) -> None:
        self._add(event.progress)

    def poll(self, query: StreamingQuery) -> None:
        for progress in query.recentProgress:
            self._add(progress)

    def _add(self, p) -> None:
        query, rows = str(p.id), int(p.numInputRows or 0)
        if p.batchId <= self._newest.get(query, -1):
            return
        self._newest[query] = p.batchId
        self._totals[query] = self._totals.get(query, 0) + rows
        late = sum(int(s.numRowsDroppedByWatermark or 0) for s in p.stateOperators)
        if rows:
            self._last_input = time.monotonic()
        self.records.append(
            (query, int(p.batchId), rows, self._totals[query], float(p.processedRowsPerSecond or 0.0), late, None)
        )

    def onQueryIdle(self, event) -> None:
        if time.monotonic() - self._last_input > self.idle_after_s:
            query = str(event.id)
            self.records.append((query, None, 0, self._totals.get(query, 0), 0.0, 0, "waiting for events"))
            self._last_input = time.monotonic()

    def onQueryTerminated(self, event) -> None:
        pass

    def table(self, spark: SparkSession) -> DataFrame:
        """The records since the last flush, one per batch."""
        return spark.createDataFrame(self.records, PROGRESS)

    def flush(self, spark: SparkSession, path: str) -> None:
        """Append the records to the table at ``path`` and forget them."""
        taken, self.records = self.records, []
        if taken:
            spark.createDataFrame(taken, PROGRESS).coalesce(1).write.mode("append").parquet(path)
