"""The live picture of a lane, from crossings and violations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewarden.operators.ledger import newest_first
from lanewarden.settings import (
    AVERAGE,
    CAMERA_PULSE_S,
    INSTANTANEOUS,
    LANE_QUEUE_LENGTH,
    MARKED_VIOLATIONS,
    VEHICLE_TTL_S,
)


def route_by_lane(events: DataFrame, lane_id: int | None = None) -> DataFrame:
    """One lane's crossings, or all that name a lane."""
    return events.where(F.col("lane_id").isNotNull() if lane_id is None else F.col("lane_id") == lane_id)


def latest_n_per_lane(events: DataFrame, n: int = LANE_QUEUE_LENGTH) -> DataFrame:
    """The last ``n`` crossings of each lane; every task passes on at most ``n`` per lane."""
    newest = Window.partitionBy("lane_id").orderBy(F.col("event_time").desc(), F.col("event_id").desc())
    ranked = events.where(F.col("lane_id").isNotNull()).withColumn("_rank", F.row_number().over(newest))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def over_limit(events: DataFrame, cameras: DataFrame) -> DataFrame:
    """Crossings of known cameras with ``over``: reading above the event's limit, else the camera's."""
    limits = cameras.select("camera_id", F.col("speed_limit").alias("_camera_limit"))
    joined = events.join(limits, "camera_id")
    limit = F.coalesce("speed_limit", "_camera_limit")
    return joined.withColumn("over", F.col("speed_reading") > limit).drop("_camera_limit")


def _recent(events: DataFrame, now: Column, span_s: float) -> DataFrame:
    """Crossings of the last ``span_s`` seconds; a constant ``now`` reaches the scan as a range."""
    oldest = F.timestamp_micros(F.unix_micros(now) - F.lit(round(span_s * 1_000_000)))
    return events.where((F.col("event_time") >= oldest) & (F.col("event_time") <= now))


def live_vehicles(events: DataFrame, now: Column, ttl_s: float = VEHICLE_TTL_S) -> DataFrame:
    """Vehicles last seen within ``ttl_s`` before ``now``: where, how fast, and whether over the limit."""
    last = _recent(events, now, ttl_s).groupBy("car_plate").agg(
        F.max(
            F.struct(
                "event_time", "camera_id", "lane_id", "position_km", "speed_reading",
                (F.col("speed_reading") > F.col("speed_limit")).alias("over"),
            )
        ).alias("_last")
    )
    return last.select("car_plate", "_last.*").withColumnRenamed("event_time", "last_seen")


def vehicles_in_segment(vehicles: DataFrame) -> DataFrame:
    return vehicles.groupBy("lane_id").agg(F.count(F.lit(1)).alias("vehicles"))


def camera_pulse(events: DataFrame, now: Column, pulse_s: float = CAMERA_PULSE_S) -> DataFrame:
    """Cameras crossed within ``pulse_s`` before ``now``."""
    return _recent(events, now, pulse_s).groupBy("camera_id").agg(F.max("event_time").alias("last_crossed"))


def mark_active_vehicles(active: DataFrame, ledger: DataFrame, n: int = MARKED_VIOLATIONS) -> DataFrame:
    """Give each vehicle on the road the kind of its offence, from the newest ``n`` violations.

    An average offence outranks a single reading; an over-limit reading marks the vehicle by itself.
    """
    newest = ledger.orderBy(*newest_first()).limit(n)
    kinds = newest.groupBy("car_plate").agg(F.bool_or(F.col("violation_type") == AVERAGE).alias("_average"))
    kind = F.when(F.col("_average"), AVERAGE).when(F.col("_average").isNotNull() | F.col("over"), INSTANTANEOUS)
    return active.join(kinds, "car_plate", "left").withColumn("violation_type", kind).drop("_average")
