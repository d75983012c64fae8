"""Enforcement data as views over the driver tables, so that every query grows with them.

Crossings: each row of ``events`` is one trip past the three cameras of its lane, with behaviour,
speeds and times computed from its id. Road network: suppliers are lanes, parts are cameras, orders
ask for more of them. Registry: customers are cars. Nothing here is random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewarden.operators.dedup import first_per_plate_window, to_stored_violation
from lanewarden.operators.detect import ADJACENT, all_violations
from lanewarden.operators.trips import index_cameras
from lanewarden.schemas import CAMERA, LANE
from lanewarden.session import materialize, scratch_path
from lanewarden.sources.sinks import append_to_ledger

# The seeded lanes and cameras (camera, lane, position, limit).
LANES = [(1, "North Highway"), (2, "Coastal Expressway"), (3, "City Bypass")]
CAMERAS = [
    (1, 1, 1.0, 90.0), (2, 1, 2.0, 90.0), (3, 1, 3.0, 90.0),
    (4, 2, 1.0, 100.0), (5, 2, 2.0, 100.0), (6, 2, 3.0, 100.0),
    (7, 3, 1.0, 80.0), (8, 3, 2.0, 80.0), (9, 3, 3.0, 80.0),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _values(spark: SparkSession, rows: list[tuple], schema) -> DataFrame:
    """A constant table that the planner knows the size of."""
    body = ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)
    plain = spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(schema.fieldNames())})")
    return plain.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def lanes(spark: SparkSession) -> DataFrame:
    return _values(spark, LANES, LANE)


def cameras(spark: SparkSession) -> DataFrame:
    return _values(spark, CAMERAS, CAMERA)


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("start_time"))
    digit = F.col("event_id") % 10
    percent = F.when(digit < 7, 70).when(digit < 9, 115).otherwise(120) + (F.col("event_id") * 7) % 26
    return events.select(
        F.col("event_id").alias("trip_id"),
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("car_plate"),
        (F.col("event_id") % 3 + 1).cast("int").alias("lane_id"),
        "start_time",
        F.when(digit < 7, "normal").when(digit < 9, "speeder").otherwise("sneaky").alias("behavior"),
        (percent.cast("double") / 100).alias("pace"),
    )


def crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per trip and camera of its lane; all cameras of a lane have one limit here."""
    limit, kind = F.col("speed_limit"), F.col("behavior")
    speed = F.col("pace") * limit
    reading = F.when(kind == "normal", F.least(speed, limit - 1)).when(kind == "speeder", speed + 1).otherwise(0.9 * limit)
    millis = F.round((F.col("position_km") - 1) * F.lit(3600000.0) / speed).cast("long")
    return trips(spark, sf_dir).join(F.broadcast(index_cameras(cameras(spark))), "lane_id").select(
        "trip_id", "car_plate", "lane_id", "camera_id", "camera_index", "position_km", "speed_limit",
        F.timestamp_micros(F.unix_micros("start_time") + millis * 1000).alias("event_time"),
        F.round(reading, 1).alias("speed_reading"),
        "behavior",
        (F.col("trip_id") * 10 + F.col("camera_id")).alias("event_id"),
    )


def misread_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the trips are read under another plate at their middle camera."""
    misread = (F.col("camera_index") == 1) & (F.col("trip_id") % 4 == 0)
    plate = F.when(misread, F.concat(F.lit("M"), "car_plate")).otherwise(F.col("car_plate"))
    return crossings(spark, sf_dir).withColumn("car_plate", plate)


def _hurried() -> Column:
    """The event time in a twentieth of the span."""
    start = 1_704_067_200_000_000
    return F.timestamp_micros(F.lit(start) + F.call_function("div", F.unix_micros("event_time") - start, F.lit(20)))


def crowded_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two plates that make all trips of a lane, in a twentieth of the time: dense histories."""
    plate = F.concat(F.lit("C"), (F.col("trip_id") % 2).cast("string"))
    return crossings(spark, sf_dir).withColumns({"car_plate": plate, "event_time": _hurried()})


def hot_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of all trips under one plate, all of them in a twentieth of the time."""
    plate = F.when(F.col("trip_id") % 3 == 0, "HOT").otherwise(F.col("car_plate"))
    return crossings(spark, sf_dir).withColumns({"car_plate": plate, "event_time": _hurried()})


def violations(spark: SparkSession, sf_dir: str, strategy: str = ADJACENT) -> DataFrame:
    return all_violations(crossings(spark, sf_dir), strategy)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored violations with a detection time computed from the row: mostly half a second to three
    seconds after the end, some implausibly late or early."""
    return ledger_of(violations(spark, sf_dir))


def ledger_of(found: DataFrame) -> DataFrame:
    return to_stored_violation(first_per_plate_window(found).drop("window_start"), detected_at=detection_time())


def ledger_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as a stored table, for queries that read it more than once."""
    return materialize(ledger(spark, sf_dir), "ledger-view")


def stored_ledger(spark: SparkSession, sf_dir: str) -> str:
    """The path of the ledger as the detector lays it out: split by day, each day in a few files."""
    path = scratch_path(spark, "stored-ledger")
    append_to_ledger(ledger_table(spark, sf_dir), path)
    return path


def detection_time():
    millis = F.unix_millis("timestamp_end")
    delay = (
        500 + (millis * 7919 + F.col("camera_id_end") * 31) % 2500
        + F.when(millis % 97 == 0, 700_000).when(millis % 101 == 0, -5_000).otherwise(0)
    )
    return F.timestamp_micros(F.unix_micros("timestamp_end") + delay * 1000)


def cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return customer.select(
        F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("car_plate"),
        F.col("c_name").alias("owner_name"),
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("owner_addr"),
        F.lower("c_mktsegment").alias("vehicle_type"),
        F.concat(F.lit("2020-01-"), F.lpad((F.col("c_custkey") % 28 + 1).cast("string"), 2, "0")).alias("registration_date"),
    )


def network_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    return supplier.select((F.col("s_suppkey") + 1).cast("int").alias("lane_id"), F.col("s_name").alias("name"))


def network_cameras(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One camera per part, on the lane of its block of 25; every fourth lane hands most to the next one."""
    part = table(spark, sf_dir, "part")
    block = F.call_function("div", F.col("p_partkey"), F.lit(25))
    handed = ((block % 4 == 0) & (F.col("p_size") > 3)).cast("int")
    return part.select(
        (F.col("p_partkey") + 1).cast("int").alias("camera_id"),
        (block + 1 + handed).cast("int").alias("lane_id"),
        F.round(F.col("p_partkey") % 25 * 0.75 + 1.0 + handed * 18.75, 3).alias("position_km"),
        (F.col("p_size") % 7 * 10 + 60).cast("double").alias("speed_limit"),
    )


def camera_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests to append a camera, some without a limit, some for lanes that do not exist."""
    order = table(spark, sf_dir, "orders")
    lane = F.call_function("div", F.col("o_custkey"), F.lit(15)) + 1
    return order.select(
        F.col("o_orderkey").alias("request_id"),
        (lane + F.when(F.col("o_orderkey") % 7 == 0, 1_000_000).otherwise(0)).cast("int").alias("lane_id"),
        F.when(F.col("o_orderstatus") == "P", None)
        .otherwise(60 + F.col("o_orderkey") % 5 * 10).cast("double").alias("speed_limit"),
    )
