"""Trips: recovering them from crossings, and summing them up."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewarden.functions.scalars import (
    micros_between,
    seconds_between,
    segment_speed,
    trip_label,
)
from lanewarden.functions.timeline import HOME, SLICE, with_slices
from lanewarden.operators.detect import to_unified
from lanewarden.settings import AVERAGE, JOIN_WINDOW, duration_seconds


def index_cameras(cameras: DataFrame) -> DataFrame:
    """Add ``camera_index``, the 0-based ordinal along the lane.

    A lane is one physical road, so its group is the few cameras that stand on it.
    """
    along = Window.partitionBy("lane_id").orderBy("position_km", "camera_id")
    return cameras.withColumn("camera_index", F.row_number().over(along) - 1)


def enrich_crossings(raw: DataFrame, cameras: DataFrame) -> DataFrame:
    """Add lane, index, position and limit of the camera; crossings of unknown cameras are skipped.

    The join is left unmarked: the planner broadcasts the cameras if their bytes are few.
    """
    indexed = index_cameras(cameras).select("camera_id", "lane_id", "camera_index", "position_km", "speed_limit")
    return raw.join(indexed, "camera_id")


def unknown_camera_count(raw: DataFrame, cameras: DataFrame) -> DataFrame:
    """One row: how many crossings :func:`enrich_crossings` skips."""
    return raw.join(cameras.select("camera_id"), "camera_id", "left_anti").agg(F.count(F.lit(1)).alias("skipped"))


def _following(df: DataFrame, window: Window) -> DataFrame:
    """Add the next crossing's camera, position, limit and the segment between the two."""
    ahead = {c: F.lead(c).over(window) for c in ("camera_id", "position_km", "speed_limit", "event_time")}
    seen = df.select("*", *[v.alias(f"next_{k}") for k, v in ahead.items()])
    dt = micros_between(F.col("event_time"), F.col("next_event_time")) / F.lit(1e6)
    distance = F.abs(F.col("next_position_km") - F.col("position_km"))
    return seen.select(
        "*",
        distance.alias("distance_km"),
        dt.alias("dt_seconds"),
        F.when(dt > 0, segment_speed(distance, dt)).alias("segment_speed"),
    )


def consecutive_segments(
    events: DataFrame, trip_keys: Sequence[str] | None = None, *, gap: str = JOIN_WINDOW, slice_width: str = "6 hours"
) -> DataFrame:
    """Each crossing with the next one of its trip; the last crossing of a trip has nulls there.

    With ``trip_keys`` the trip is named by columns, and its group is one crossing per camera.
    Otherwise a trip ends when the vehicle is not seen on the lane for longer than ``gap``. The
    next crossing then lies at most ``gap`` ahead, so histories are cut into time slices that
    overlap by ``gap``, and no task sorts a vehicle's whole history.
    """
    if trip_keys is not None:
        return _following(events, Window.partitionBy(*trip_keys).orderBy("event_time", "camera_index"))
    reach, width = duration_seconds(gap), duration_seconds(slice_width)
    sliced = with_slices(events, "event_time", back_s=reach, ahead_s=0, width_s=width)
    order = Window.partitionBy("car_plate", "lane_id", SLICE).orderBy("event_time", "camera_index")
    ahead = _following(sliced, order).where(HOME).drop(SLICE, HOME)
    within = F.coalesce(F.col("dt_seconds") <= reach, F.lit(False))
    derived = [c for c in ahead.columns if c not in events.columns]
    return ahead.select(*events.columns, *[F.when(within, F.col(c)).alias(c) for c in derived])


def detect_average_last_crossing(events: DataFrame, *, window: str = JOIN_WINDOW) -> DataFrame:
    """Average violations between each crossing and the vehicle's next one on the lane.

    Unlike pairing neighbouring cameras by index, a missed camera leaves no gap: the segment then
    spans it. One row per offending segment.
    """
    return judged_pairs(consecutive_segments(events, gap=window))


def judged_pairs(pairs: DataFrame) -> DataFrame:
    """The violations among crossings that each carry the next one's ``next_`` columns; table or stream."""
    dt = seconds_between(F.col("event_time"), F.col("next_event_time"))
    distance = F.abs(F.col("next_position_km") - F.col("position_km"))
    found = pairs.where(dt > 0).select(
        "car_plate",
        "lane_id",
        F.col("camera_id").alias("camera_id_start"),
        F.col("next_camera_id").alias("camera_id_end"),
        F.col("position_km").alias("position_start_km"),
        F.col("next_position_km").alias("position_end_km"),
        F.col("event_time").alias("timestamp_start"),
        F.col("next_event_time").alias("timestamp_end"),
        F.col("next_speed_limit").alias("speed_limit"),
        segment_speed(distance, dt).alias("avg_speed"),
    )
    return to_unified(found.where(F.col("avg_speed") > F.col("speed_limit")), AVERAGE)


def assign_trips(events: DataFrame, *, gap: str = JOIN_WINDOW, slice_width: str = "6 hours") -> DataFrame:
    """Add ``trip_start``: a new trip opens when the gap to the previous crossing exceeds ``gap``.

    The start of a trip is found by looking back ``gap``. The start in force at a crossing is the
    latest one before it: inside its slice by a window over the slice, else carried over from the
    earlier slices, which are first reduced to one row each.
    """
    reach, width = duration_seconds(gap), duration_seconds(slice_width)
    keys = ["car_plate", "lane_id"]
    sliced = with_slices(events, "event_time", back_s=0, ahead_s=reach, width_s=width)
    order = Window.partitionBy(*keys, SLICE).orderBy("event_time", "camera_index")
    silence = micros_between(F.lag("event_time").over(order), F.col("event_time"))
    opens = silence.isNull() | (silence > reach * 1_000_000)
    marked = (
        sliced.withColumn("_opens", opens)
        .where(HOME)
        .withColumn("_start", F.when(F.col("_opens"), F.col("event_time")))
        .withColumn("_start", F.max("_start").over(order))
        .drop("_opens", HOME)
    )
    per_slice = marked.groupBy(*keys, SLICE).agg(F.max("_start").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = per_slice.select(*keys, SLICE, F.max("_last").over(earlier).alias("_carried"))
    return (
        marked.join(carried, [*keys, SLICE])
        .withColumn("trip_start", F.coalesce("_start", "_carried"))
        .select(*events.columns, "trip_start")
    )


def trip_summary(segments: DataFrame, trip_keys: Sequence[str]) -> DataFrame:
    """Per trip: crossings, top reading, top segment average, and what it should trigger."""
    over_average = F.coalesce(F.col("segment_speed") > F.col("next_speed_limit"), F.lit(False))
    summed = segments.groupBy(*trip_keys).agg(
        F.count(F.lit(1)).alias("n_events"),
        F.bround(F.max("speed_reading"), 1).alias("max_spot"),
        F.bround(F.coalesce(F.max("segment_speed"), F.lit(0.0)), 1).alias("max_avg"),
        F.bool_or(F.col("speed_reading") > F.col("speed_limit")).alias("expect_instantaneous"),
        F.bool_or(over_average).alias("expect_average"),
    )
    return summed.withColumn("label", trip_label(F.col("expect_instantaneous"), F.col("expect_average")))
