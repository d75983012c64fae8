"""From detections to the grain of the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewarden.functions.scalars import day_of, day_start, window_start
from lanewarden.functions.timeline import HOME, SLICE, with_slices
from lanewarden.operators.chains import follow
from lanewarden.operators.detect import first_of
from lanewarden.schemas import STORED_VIOLATION, VIOLATION_COLUMNS
from lanewarden.settings import DEDUP_WINDOW, duration_minutes, duration_seconds


def first_per_plate_window(violations: DataFrame, window: str = DEDUP_WINDOW) -> DataFrame:
    """One violation per plate and tumbling window of its start time; the first one wins."""
    bucket = window_start(F.col("timestamp_start"), duration_minutes(window))
    first = first_of(violations, "car_plate", bucket)
    return first.select(*VIOLATION_COLUMNS, F.col("_key1").alias("window_start"))


def rolling_flag(violations: DataFrame, width: str = DEDUP_WINDOW) -> DataFrame:
    """``car_plate, violation_type, start_us``: a plate's first violation, then each first one that starts
    at least ``width`` after the flag before it.

    The flag after one at ``t`` is the next start from ``t + width`` on. A start with none in the width
    before it always is a flag, so successors further than two widths away need not be known, and both
    are found in overlapping slices of time. From those sure flags the chains are followed in steps of
    1, 2, 4, ... successors, each a join of stored tables, so no plate's history is one group. Of equal
    starts the least type is named; rows without plate or start are left out.
    """
    span = duration_seconds(width)
    us = span * 1_000_000
    at = F.unix_micros("timestamp_start").alias("start_us")
    starts = violations.where("car_plate is not null and timestamp_start is not null").groupBy("car_plate", at).agg(
        F.min("violation_type").alias("violation_type"), F.min("timestamp_start").alias("_at")
    )
    by_time = Window.partitionBy("car_plate", SLICE).orderBy("start_us")
    sliced = with_slices(starts, "_at", back_s=2 * span, ahead_s=span, width_s=6 * span)
    linked = sliced.select(
        "car_plate", "start_us", "violation_type", HOME,
        (F.count("start_us").over(by_time.rangeBetween(1 - us, -1)) == 0).alias("_sure"),
        F.min("start_us").over(by_time.rangeBetween(us, 2 * us - 1)).alias("_next"),
    )
    flags = follow(linked.where(HOME).drop(HOME), ["car_plate"], "start_us")
    return flags.select("car_plate", "violation_type", "start_us")


def to_stored_violation(
    violations: DataFrame, window: str = DEDUP_WINDOW, detected_at: Column | None = None
) -> DataFrame:
    """Cast to the ledger row and add its window, its midnight ``date`` and the detection time."""
    types = {f.name: f.dataType for f in STORED_VIOLATION.fields}
    start = F.col("timestamp_start")
    return violations.select(
        *[F.col(c).cast(types[c]).alias(c) for c in VIOLATION_COLUMNS],
        window_start(start, duration_minutes(window)).alias("window_start"),
        day_start(start).alias("date"),
        (F.current_timestamp() if detected_at is None else detected_at).alias("detected_at"),
    )


def for_ledger_table(stored: DataFrame) -> DataFrame:
    """The stored row as the table holds it: ``date`` is a calendar day, last, for partitioning."""
    return stored.withColumn("date", day_of(F.col("timestamp_start"))).select(STORED_VIOLATION.fieldNames())
