"""Writers: the violation ledger, its republished stream, CSV export and table rewrites."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewarden.functions.scalars import iso_text
from lanewarden.operators.dedup import for_ledger_table, to_stored_violation
from lanewarden.operators.detect import FIRST_ORDER
from lanewarden.operators.ledger import export_rows, without_violations
from lanewarden.operators.live import route_by_lane
from lanewarden.schemas import LEDGER_KEY, STORED_VIOLATION
from lanewarden.session import delete_path, scratch_path
from lanewarden.settings import AVERAGE, DEDUP_WINDOW, INSTANTANEOUS


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger table; an empty frame while nothing has been written."""
    try:
        return spark.read.schema(STORED_VIOLATION).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], STORED_VIOLATION)


# Up to so many rows are written by one task, without a shuffle to even out files.
_ONE_TASK_ROWS = 10_000


def append_to_ledger(stored: DataFrame, path: str, at_most: int | None = None) -> None:
    """Append rows to the table, split by day; ``at_most`` is a bound of their number, if one is known.

    The rebalance gives files of even size: a day with little data is one file, and a day that
    holds most of the rows is written by many tasks. Rows are sorted by plate within a day, so the
    row-group statistics of the files serve plate lookups.
    """
    rows = for_ledger_table(stored)
    few = at_most is not None and at_most <= _ONE_TASK_ROWS
    laid_out = rows.coalesce(1).sortWithinPartitions("date", "car_plate") if few else _laid_out(rows)
    laid_out.write.mode("append").partitionBy("date").parquet(path)


def _laid_out(ledger: DataFrame) -> DataFrame:
    return ledger.hint("rebalance", "date").sortWithinPartitions("date", "car_plate")


def rewrite_days(spark: SparkSession, path: str, days: list[date], rows: DataFrame) -> None:
    """Replace the given days of the table by their ``rows``; files of other days are not touched.

    The rows are written to the scratch folder first, since they come from the files they replace. Each day
    is swapped by renames as the job commits, so a reader that lists a day in that moment should list again.
    Days that have no rows left are deleted.
    """
    path_of = scratch_path(spark, "ledger-days")
    rows.select(STORED_VIOLATION.fieldNames()).write.parquet(path_of)
    staged = spark.read.schema(STORED_VIOLATION).parquet(path_of)
    writer = _laid_out(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("date").parquet(path)
    left = {row["date"] for row in staged.select("date").distinct().collect()}
    for day in days:
        if day not in left:
            delete_path(spark, f"{path}/date={day.isoformat()}")
    delete_path(spark, path_of)


def delete_stored_violations(spark: SparkSession, path: str, since=None) -> list[date]:
    """Delete all rows, or those detected at or after ``since``; returns the days that held any.

    Only those days are rewritten. Run again after a failure, it finishes what is left.
    """
    ledger = read_ledger(spark, path)
    gone = ledger if since is None else ledger.where(F.col("detected_at") >= F.lit(since).cast("timestamp"))
    days = sorted(row["date"] for row in gone.select("date").distinct().collect())
    if days:
        rewrite_days(spark, path, days, without_violations(ledger.where(F.col("date").isin(days)), since))
    return days


# A day is compacted when it lies in more files than its bytes need at this size.
COMPACT_FILE_BYTES = 64 << 20


def compact_ledger(spark: SparkSession, path: str, before: date, file_bytes: int = COMPACT_FILE_BYTES) -> list[date]:
    """Rewrite the small files of each day before ``before`` into few sorted ones; returns those days.

    ``before`` is a day that the detector may still write to: the day of its newest crossing, less the delay
    and the span of a segment. Appends go to later days, so the job runs beside the sink.
    """
    ledger = read_ledger(spark, path).where(F.col("date") < F.lit(before))
    if ledger.isEmpty():
        return []
    files = ledger.select("date", "_metadata.file_path", "_metadata.file_size").distinct().groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("file_size").alias("bytes")
    )
    crowded = files.where(F.col("n") > 1 + F.floor(F.col("bytes") / file_bytes))
    days = sorted(row["date"] for row in crowded.select("date").collect())
    if days:
        rewrite_days(spark, path, days, ledger.where(F.col("date").isin(days)))
    return days


def write_by_lane(crossings: DataFrame, path: str) -> None:
    """All crossings that name a lane, split by lane in one pass and sorted by time.

    A lane with little data is one file; the rebalance deals a busy lane to many tasks.
    """
    routed = route_by_lane(crossings).hint("rebalance", "lane_id").sortWithinPartitions("lane_id", "event_time")
    routed.write.mode("append").partitionBy("lane_id").parquet(path)


def overwrite_copy(df: DataFrame, path: str) -> str:
    """Write a whole new version of a table at ``path``; the caller then points readers to it."""
    df.write.mode("errorifexists").parquet(path)
    return path


def overwrite_ledger_copy(ledger: DataFrame, path: str) -> str:
    rows = _laid_out(ledger.select(STORED_VIOLATION.fieldNames()))
    rows.write.mode("errorifexists").partitionBy("date").parquet(path)
    return path


def republish_violations(stored: DataFrame) -> DataFrame:
    """Key and JSON value of violations, with ISO times, for any sink that takes messages."""
    stamps = {name for name, kind in stored.dtypes if kind.startswith("timestamp")}
    body = [iso_text(F.col(c)).alias(c) if c in stamps else F.col(c) for c in stored.columns]
    return stored.select(F.col("car_plate").alias("key"), F.to_json(F.struct(*body)).alias("value"))


def publisher(sink: str, **options: str) -> Callable[[DataFrame, int], None]:
    """A ``publish`` function for the detector: each batch's violations as messages to a sink format.

    ``publisher("kafka", **{"kafka.bootstrap.servers": servers, "topic": "violations"})``, or a file format
    with ``path``.
    """

    def publish(stored: DataFrame, batch_id: int) -> None:
        republish_violations(stored).write.format(sink).options(**options).mode("append").save()

    return publish


def export_violations_csv(ledger: DataFrame, path: str, **filters) -> None:
    """CSV files with a header, newest detection first across the numbered part files."""
    rows = export_rows(ledger, **filters)
    stamps = {name for name, kind in rows.dtypes if kind.startswith("timestamp")}
    text = rows.select(*[iso_text(F.col(c)).alias(c) if c in stamps else F.col(c) for c in rows.columns])
    text.write.option("header", True).csv(path)


class LedgerWriter:
    """A ``foreachBatch`` sink: insert if absent on plate and window, the first writer wins.

    A replayed batch finds its keys stored and adds nothing. The batch is reduced to one row per
    key, then only the stored keys of its own days and windows are read for the anti-join. Every
    detected row, stored before or not, goes to ``publish`` when one is given (at least once).
    ``report`` receives the counts of each batch, one small dictionary.
    """

    def __init__(
        self,
        path: str,
        *,
        window: str = DEDUP_WINDOW,
        publish: Callable[[DataFrame, int], None] | None = None,
        report: Callable[[dict], None] | None = None,
    ) -> None:
        self.path, self.window, self.publish, self.report = path, window, publish, report

    def _stored_keys(self, spark: SparkSession, low, high) -> DataFrame:
        ledger = read_ledger(spark, self.path)
        in_span = F.col("window_start").between(F.lit(low), F.lit(high))
        on_days = F.col("date").between(F.lit(low.date()), F.lit(high.date()))
        return ledger.where(on_days & in_span).select(*LEDGER_KEY).withColumn("_stored", F.lit(True))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        stored = to_stored_violation(batch, self.window)
        if self.publish is not None:
            # Before anything is built on it, so that the batch is computed once.
            stored.persist()
        kind = F.col("violation_type")
        payload = [c for c in stored.columns if c not in LEDGER_KEY]
        per_key = (
            stored.groupBy(*LEDGER_KEY)
            .agg(
                F.min(F.struct(*FIRST_ORDER, *[c for c in payload if c not in FIRST_ORDER])).alias("_first"),
                F.count(F.lit(1)).alias("_n"),
                F.count_if(kind == INSTANTANEOUS).alias("_instant"),
                F.count_if(kind == AVERAGE).alias("_average"),
            )
            .persist()
        )
        try:
            counts = per_key.agg(
                F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"),
                F.coalesce(F.sum("_instant"), F.lit(0)).alias("instant"),
                F.coalesce(F.sum("_average"), F.lit(0)).alias("average"),
                F.count(F.lit(1)).alias("keys"),
                F.min("window_start").alias("low"),
                F.max("window_start").alias("high"),
            ).first()
            if counts["violations"] == 0:
                return
            known = self._stored_keys(batch.sparkSession, counts["low"], counts["high"])
            fresh = per_key.join(known, LEDGER_KEY, "left_anti").select(
                *LEDGER_KEY, *[F.col(f"_first.{c}").alias(c) for c in payload]
            )
            if self.publish is not None:
                self.publish(stored, batch_id)
            repeated = None
            if self.report is not None:
                repeated = per_key.join(known, LEDGER_KEY, "left_semi").count()
            append_to_ledger(fresh, self.path, counts["keys"])
            if self.report is not None:
                new = counts["keys"] - repeated
                self.report(
                    {
                        "batch_id": batch_id,
                        "violations": counts["violations"],
                        "instant": counts["instant"],
                        "average": counts["average"],
                        "new": new,
                        "duplicate": counts["violations"] - new,
                    }
                )
        finally:
            per_key.unpersist()
            stored.unpersist()
