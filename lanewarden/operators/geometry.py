"""Road geometry: laying out, extending and shortening the camera chain of a lane."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lanewarden.functions.ordering import global_ordinal
from lanewarden.operators.ledger import camera_counts_by_lane
from lanewarden.schemas import CAMERA
from lanewarden.settings import CAMERA_SPACING_KM, EMPTY_LANE_LIMIT, MIN_CAMERAS_PER_LANE

_CAMERA_COLUMNS = CAMERA.fieldNames()


def _as_cameras(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CAMERA.fields])


def lay_out_cameras(plan: DataFrame, spacing_km: float = CAMERA_SPACING_KM) -> DataFrame:
    """Cameras from a plan ``lane_id, camera_count, speed_limit``, numbered across lanes in order."""
    slots = plan.where(F.col("camera_count") > 0).select(
        "lane_id", "speed_limit", F.explode(F.sequence(F.lit(1), F.col("camera_count").cast("int"))).alias("_slot")
    )
    numbered = global_ordinal(slots, F.col("lane_id").asc(), F.col("_slot").asc())
    return _as_cameras(
        numbered.withColumn("camera_id", F.col("ordinal") + 1).withColumn(
            "position_km", F.round(F.col("_slot") * F.lit(spacing_km), 3)
        )
    )


def cameras_of_lane(cameras: DataFrame, lane_id: int | None = None) -> DataFrame:
    """All cameras or one lane's, by lane and position."""
    found = cameras if lane_id is None else cameras.where(F.col("lane_id") == lane_id)
    return found.orderBy("lane_id", "position_km")


def known_lane_requests(requests: DataFrame, lanes: DataFrame) -> DataFrame:
    return requests.join(lanes.select("lane_id"), "lane_id", "left_semi")


def unknown_lane_requests(requests: DataFrame, lanes: DataFrame) -> DataFrame:
    """Requests that are refused because their lane does not exist."""
    return requests.join(lanes.select("lane_id"), "lane_id", "left_anti")


def append_cameras(
    cameras: DataFrame, lanes: DataFrame, requests: DataFrame, spacing_km: float = CAMERA_SPACING_KM
) -> DataFrame:
    """The cameras that ``requests`` (``request_id, lane_id, speed_limit``) add, in request order.

    The k-th request of a lane stands k spacings past its last camera. Without a limit it takes
    the highest limit on the lane by then, or 100 on an empty lane. Unknown lanes and limits that
    are not positive are refused. Identifiers continue the highest one over the whole network, in
    a distributed order; the per-lane window holds the cameras asked for on one road.
    """
    valid = known_lane_requests(requests, lanes).where(F.col("speed_limit").isNull() | (F.col("speed_limit") > 0))
    ends = cameras.groupBy("lane_id").agg(
        F.max("position_km").alias("_last_km"), F.max("speed_limit").alias("_limit")
    )
    queue = Window.partitionBy("lane_id").orderBy("request_id")
    earlier = queue.rowsBetween(Window.unboundedPreceding, -1)
    first_given = F.first("speed_limit").over(queue)
    start_limit = F.coalesce(F.col("_limit"), F.when(first_given.isNull(), F.lit(EMPTY_LANE_LIMIT)))
    placed = valid.join(ends, "lane_id", "left").select(
        "request_id",
        "lane_id",
        F.round(F.coalesce("_last_km", F.lit(0.0)) + F.row_number().over(queue) * F.lit(spacing_km), 3).alias("position_km"),
        F.coalesce(F.col("speed_limit"), F.greatest(start_limit, F.max("speed_limit").over(earlier))).alias("speed_limit"),
    )
    highest = F.coalesce(cameras.agg(F.max("camera_id").alias("m")).scalar(), F.lit(0))
    numbered = global_ordinal(placed, F.col("request_id").asc())
    return _as_cameras(numbered.withColumn("camera_id", highest + F.col("ordinal") + 1))


def _removal(cameras: DataFrame, lanes: DataFrame, requests: DataFrame) -> DataFrame:
    """Known lanes asked for: how often, and how many of the requests leave enough cameras to be served."""
    asked = requests.groupBy("lane_id").agg(F.count(F.lit(1)).alias("_asked"))
    held = camera_counts_by_lane(cameras)
    spare = F.coalesce("camera_count", F.lit(0)) - MIN_CAMERAS_PER_LANE
    served = F.greatest(F.lit(0), F.least("_asked", spare)).alias("_served")
    return known_lane_requests(asked, lanes).join(held, "lane_id", "left").select("lane_id", "_asked", served)


def remove_last_cameras(cameras: DataFrame, lanes: DataFrame, requests: DataFrame) -> DataFrame:
    """The cameras removed: each request takes the last one left of its lane, while enough stay.

    ``requests`` has a row per request with its ``lane_id``; refused requests and unknown lanes give
    no row. The window holds the cameras of one road.
    """
    served = _removal(cameras, lanes, requests).where("_served > 0").select("lane_id", "_served")
    from_end = Window.partitionBy("lane_id").orderBy(F.desc("position_km"), F.desc("camera_id"))
    ranked = cameras.join(served, "lane_id").withColumn("_place", F.row_number().over(from_end))
    return ranked.where("_place <= _served").select(_CAMERA_COLUMNS)


def refused_removals(cameras: DataFrame, lanes: DataFrame, requests: DataFrame) -> DataFrame:
    """Per lane, how many requests would have left too few cameras to measure an average."""
    refused = (F.col("_asked") - F.col("_served")).alias("refused")
    return _removal(cameras, lanes, requests).select("lane_id", refused).where("refused > 0")


def cameras_after_removal(cameras: DataFrame, lanes: DataFrame, requests: DataFrame) -> DataFrame:
    return cameras.join(remove_last_cameras(cameras, lanes, requests).select("camera_id"), "camera_id", "left_anti")


def camera_config_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """Lanes whose number of cameras differs between two reads; null where a lane is absent."""
    old = camera_counts_by_lane(before).withColumnRenamed("camera_count", "cameras_before")
    new = camera_counts_by_lane(after).withColumnRenamed("camera_count", "cameras_after")
    changed = ~F.col("cameras_before").eqNullSafe(F.col("cameras_after"))
    return old.join(new, "lane_id", "full_outer").where(changed)


def lane_limits(cameras: DataFrame) -> DataFrame:
    """The distinct limits of each lane, ascending."""
    return cameras.groupBy("lane_id").agg(F.array_sort(F.collect_set("speed_limit")).alias("limits"))


def lane_span(cameras: DataFrame) -> DataFrame:
    """Position of the last camera and number of cameras per lane."""
    return cameras.groupBy("lane_id").agg(
        F.max("position_km").alias("span_km"), F.count(F.lit(1)).alias("camera_count")
    )
