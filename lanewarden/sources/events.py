"""Readers of crossings and of the vehicle registry."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lanewarden.functions.scalars import iso_text, parse_utc
from lanewarden.schemas import CAR, REGISTRY_CSV, REPLAY_CSV, WIRE_EVENT
from lanewarden.settings import WATERMARK


def read_events(
    spark: SparkSession,
    options: Mapping[str, str],
    *,
    source: str = "kafka",
    schema: str | None = None,
    watermark: str = WATERMARK,
) -> DataFrame:
    """Stream of parsed crossings from one topic, from the latest offsets unless told otherwise.

    ``options`` go to the source (for Kafka at least ``kafka.bootstrap.servers`` and ``subscribe``).
    Any streaming source with a ``value`` column will do; files need their ``schema`` named.
    """
    settings = {"startingOffsets": "latest", **options} if source == "kafka" else dict(options)
    reader = spark.readStream.format(source).options(**settings)
    return parse_events((reader.schema(schema) if schema else reader).load(), watermark)


def parse_events(raw: DataFrame, watermark: str | None = WATERMARK) -> DataFrame:
    """Decode the JSON of ``value``; add ``event_time`` and, on a stream, its watermark.

    Text that is not JSON, and stamps that are no time, become nulls, which no detector accepts.
    """
    event = F.from_json(F.col("value").cast("string"), WIRE_EVENT)
    parsed = raw.select(event.alias("e")).select("e.*").withColumn("event_time", parse_utc(F.col("timestamp")))
    return parsed.withWatermark("event_time", watermark) if raw.isStreaming and watermark else parsed


def normalise_event(df: DataFrame) -> DataFrame:
    """Cast every field to its wire type; a missing ``event_id`` becomes a random one."""
    given = set(df.columns)
    stamp = dict(df.dtypes)["timestamp"]
    columns = []
    for field in WIRE_EVENT.fields:
        if field.name == "timestamp":
            value = iso_text(F.col("timestamp")) if stamp.startswith("timestamp") else F.col("timestamp").cast("string")
        elif field.name == "event_id":
            known = F.col("event_id").cast("string") if "event_id" in given else F.lit(None).cast("string")
            value = F.coalesce(F.nullif(known, F.lit("")), F.expr("uuid()"))
        else:
            value = F.col(field.name).cast(field.dataType)
        columns.append(value.alias(field.name))
    return df.select(*columns)


def to_wire(events: DataFrame) -> DataFrame:
    """Key and JSON value of crossings, as a topic carries them."""
    stamped = events.withColumn("timestamp", iso_text(F.col("event_time"))) if "timestamp" not in events.columns else events
    body = normalise_event(stamped)
    return body.select(
        F.col("car_plate").alias("key"),
        F.to_json(F.struct(*WIRE_EVENT.fieldNames())).cast("binary").alias("value"),
    )


def topic_event_count(raw: DataFrame) -> DataFrame:
    """One row: events and partitions of a topic, from its highest offsets."""
    ends = raw.groupBy("partition").agg((F.max("offset") + 1).alias("_end"))
    return ends.agg(F.coalesce(F.sum("_end"), F.lit(0)).alias("events"), F.count(F.lit(1)).alias("partitions"))


def read_replay_csv(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Crossings of all files as one frame; rows without a time, a camera or a reading are dropped."""
    text = spark.read.schema(REPLAY_CSV).option("header", True).csv(list(paths))
    typed = text.select(
        parse_utc(F.col("timestamp")).alias("event_time"),
        F.expr("CAST(try_cast(camera_id AS DOUBLE) AS INT)").alias("camera_id"),
        "car_plate",
        F.expr("try_cast(speed_reading AS DOUBLE)").alias("speed_reading"),
    )
    return typed.na.drop(subset=["event_time", "camera_id", "speed_reading"])


def in_time_order(crossings: DataFrame, n: int | None = None) -> DataFrame:
    """Crossings by time, the first ``n`` when given; camera and plate break ties."""
    ordered = crossings.orderBy("event_time", "camera_id", "car_plate")
    return ordered if n is None else ordered.limit(n)


def read_vehicle_registry(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """The registry with its type column renamed and every field as text; the first ``limit`` plates."""
    text = spark.read.schema(REGISTRY_CSV).option("header", True).csv(path)
    cars = text.withColumnRenamed("vechicle_type", "vehicle_type").select(CAR.fieldNames())
    return cars if limit is None else cars.orderBy("car_plate").limit(limit)
