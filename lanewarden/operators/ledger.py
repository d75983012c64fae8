"""Questions asked of the violation ledger and the vehicle registry."""

from __future__ import annotations

from datetime import datetime
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewarden.functions.ordering import ranked_slice, text_position
from lanewarden.functions.scalars import (
    has_prefix, iso_text, read_violation_ref, violation_id, violation_key, violation_ref,
)
from lanewarden.schemas import CAR, EXPORT_COLUMNS
from lanewarden.settings import AVERAGE, FEED_LENGTH, INSTANTANEOUS, PAGE_LIMIT_MAX, VIOLATION_TYPES


# --- filters and lookups --------------------------------------------------------------------

def filter_violations(
    ledger: DataFrame,
    *,
    lane_id: int | None = None,
    violation_type: str | None = None,
    car_plate: str | None = None,
    date: str | None = None,
) -> DataFrame:
    """Rows matching every filter given; empty text means no filter, an unknown type is refused.

    All tests are plain column comparisons, so the scan prunes by date partition and by the
    plate and lane statistics of the files.
    """
    if violation_type and violation_type not in VIOLATION_TYPES:
        raise ValueError(f"violation_type must be one of {VIOLATION_TYPES}, not {violation_type!r}")
    found = ledger
    if lane_id is not None:
        found = found.where(F.col("lane_id") == lane_id)
    if violation_type:
        found = found.where(F.col("violation_type") == violation_type)
    if car_plate:
        found = found.where(F.col("car_plate") == car_plate)
    if date:
        day = datetime.fromisoformat(date).date()
        found = found.where((F.col("date") >= F.lit(day)) & (F.col("date") < F.lit(day + timedelta(days=1))))
    return found


def newest_first() -> list[Column]:
    """Newest detection first; the ledger key breaks ties, so pages never overlap."""
    return [F.col("detected_at").desc(), F.col("car_plate").asc(), F.col("window_start").asc()]


def _page(df: DataFrame, position: Column, order: list[Column], skip: int, limit: int, within=None) -> DataFrame:
    if skip < 0:
        raise ValueError("skip must not be negative")
    if not 1 <= limit <= PAGE_LIMIT_MAX:
        raise ValueError(f"limit must be between 1 and {PAGE_LIMIT_MAX}")
    return ranked_slice(df, position, order, skip, limit, within)


def page_violations(ledger: DataFrame, *, skip: int = 0, limit: int = 50, **filters) -> DataFrame:
    """One page of the filtered ledger, newest first, found in the same way however deep it lies."""
    undated = 1 << 62
    age = F.coalesce(-F.unix_micros("detected_at"), F.lit(undated))

    def within(low: int, high: int) -> Column:
        if low == undated:
            return F.col("detected_at").isNull()
        until = F.col("detected_at") <= F.timestamp_micros(F.lit(-low))
        if high == undated:
            return until | F.col("detected_at").isNull()
        return until & (F.col("detected_at") >= F.timestamp_micros(F.lit(-high)))

    return _page(filter_violations(ledger, **filters), age, newest_first(), skip, limit, within)


def matching_total(ledger: DataFrame, **filters) -> DataFrame:
    """One row: how many rows the same filters match in all."""
    return filter_violations(ledger, **filters).agg(F.count(F.lit(1)).alias("total"))


def search_cars(cars: DataFrame, plate_prefix: str | None = None) -> DataFrame:
    """Cars whose plate starts with the prefix, whatever its case; the prefix is taken literally."""
    return cars.where(has_prefix(F.col("car_plate"), plate_prefix)) if plate_prefix else cars


def page_cars(cars: DataFrame, plate_prefix: str | None = None, *, skip: int = 0, limit: int = 50) -> DataFrame:
    return _page(search_cars(cars, plate_prefix), text_position(F.col("car_plate")), [F.col("car_plate").asc()], skip, limit)


def car_plates(cars: DataFrame) -> DataFrame:
    return cars.select("car_plate")


def car_by_plate(cars: DataFrame, plate: str) -> DataFrame:
    return cars.where(F.col("car_plate") == plate)


def lane_by_id(lanes: DataFrame, lane_id: int) -> DataFrame:
    return lanes.where(F.col("lane_id") == lane_id)


def with_violation_id(ledger: DataFrame) -> DataFrame:
    return ledger.withColumn("id", violation_id(F.col("car_plate"), F.col("window_start")))


def violation_by_id(ledger: DataFrame, wanted: str | Column) -> DataFrame:
    return with_violation_id(ledger).where(F.col("id") == wanted)


def with_violation_ref(ledger: DataFrame) -> DataFrame:
    return ledger.withColumn("ref", violation_ref(F.col("car_plate"), F.col("window_start")))


def violation_by_ref(ledger: DataFrame, ref: str) -> DataFrame:
    """The row that the identifier names, none for an unknown or damaged one.

    The key is read out of the identifier, so one day is read, and of it what may hold the plate. A window
    never crosses midnight, so its day is that of the violation.
    """
    key = read_violation_ref(ref)
    if key is None:
        return ledger.where(F.lit(False))
    plate, window = key
    at = F.timestamp_micros(F.lit(int(window.timestamp()) * 1_000_000))
    return ledger.where((F.col("date") == F.lit(window.date())) & (F.col("car_plate") == plate) & (F.col("window_start") == at))


def to_json_safe(df: DataFrame) -> DataFrame:
    """The same rows with every timestamp as ISO text."""
    stamps = {name for name, kind in df.dtypes if kind.startswith("timestamp")}
    return df.select(*[iso_text(F.col(c)).alias(c) if c in stamps else F.col(c) for c in df.columns])


def export_rows(ledger: DataFrame, **filters) -> DataFrame:
    """The rows and columns of the CSV export, newest first."""
    return filter_violations(ledger, **filters).orderBy(*newest_first()).select(EXPORT_COLUMNS)


# --- feeds ----------------------------------------------------------------------------------

def recent_feed(ledger: DataFrame, n: int = FEED_LENGTH, lane_id: int | None = None) -> DataFrame:
    return filter_violations(ledger, lane_id=lane_id).orderBy(*newest_first()).limit(n)


def newest_bound(ledger: DataFrame, n: int) -> int | None:
    """A detection time, in microseconds, that the ``n`` newest rows all reach; None where fewer have one.

    Rows are counted per day, then the newest days are read until ``n`` rows stand; the time of the last of
    those is the bound. Rows of older days that were detected later reach it too.
    """
    days = ledger.where("detected_at is not null").groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    seen = 0
    for row in days.orderBy(F.col("date").desc_nulls_last()).toLocalIterator():
        seen += row["n"]
        if seen >= n and row["date"] is not None:
            newest = ledger.where((F.col("date") >= F.lit(row["date"])) & F.col("detected_at").isNotNull())
            last = newest.select("detected_at").orderBy(F.col("detected_at").desc()).limit(n)
            return last.agg(F.unix_micros(F.min("detected_at")).alias("us")).first()["us"]
    return None


def newest_rows(ledger: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest rows of a stored ledger; only files with rows that reach :func:`newest_bound` are read."""
    us = newest_bound(ledger, n)
    near = ledger if us is None else ledger.where(F.col("detected_at") >= F.timestamp_micros(F.lit(us)))
    return near.orderBy(*newest_first()).limit(n)


def merge_feed(history: DataFrame, live: DataFrame, n: int = FEED_LENGTH) -> DataFrame:
    """The newest ``n`` of both frames, one row per natural key.

    A key that both hold keeps its history row. Rows are reduced per key by an aggregate that
    combines before the shuffle.
    """
    columns = history.columns
    both = history.withColumn("_source", F.lit(0)).unionByName(live.withColumn("_source", F.lit(1)))
    key = violation_key(
        F.col("car_plate"), F.col("violation_type"), F.col("timestamp_start"), F.col("camera_id_start")
    )
    ranked = ["_source", "detected_at", *[c for c in columns if c != "detected_at"]]
    kept = both.groupBy(key.alias("violation_key")).agg(F.min(F.struct(*ranked)).alias("_r"))
    merged = kept.select("violation_key", *[F.col(f"_r.{c}").alias(c) for c in columns])
    return merged.orderBy(F.col("detected_at").desc(), F.col("violation_key").asc()).limit(n)


def latest_capture(ledger: DataFrame, cars: DataFrame) -> DataFrame:
    """The newest violation with its car; the car's columns are null for an unknown plate."""
    newest = ledger.orderBy(*newest_first()).limit(1)
    return newest.join(cars, "car_plate", "left")


# --- tallies --------------------------------------------------------------------------------

def violation_counts_by_lane(ledger: DataFrame) -> DataFrame:
    kind = F.col("violation_type")
    return ledger.groupBy("lane_id").agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(kind == INSTANTANEOUS).alias("instantaneous"),
        F.count_if(kind == AVERAGE).alias("average"),
    )


def camera_counts_by_lane(cameras: DataFrame) -> DataFrame:
    return cameras.groupBy("lane_id").agg(F.count(F.lit(1)).alias("camera_count"))


def lanes_summary(lanes: DataFrame, cameras: DataFrame, ledger: DataFrame) -> DataFrame:
    """Every lane with its camera count and tallies, zero where it has none.

    Both facts are reduced to one row per lane before they are joined.
    """
    summary = lanes.join(camera_counts_by_lane(cameras), "lane_id", "left").join(
        violation_counts_by_lane(ledger), "lane_id", "left"
    )
    return summary.na.fill(0, ["camera_count", "total", "instantaneous", "average"])


def network_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("lanes"),
        F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
        F.coalesce(F.sum("instantaneous"), F.lit(0)).alias("instantaneous"),
        F.coalesce(F.sum("average"), F.lit(0)).alias("average"),
        F.coalesce(F.sum("camera_count"), F.lit(0)).alias("cameras"),
    )


def type_share_by_lane(summary: DataFrame) -> DataFrame:
    """Percent of each kind per lane; a lane without violations has 0 and 0."""
    total = F.greatest(F.col("total"), F.lit(1))
    return summary.select(
        "lane_id",
        (F.col("instantaneous") / total * 100).alias("instantaneous_pct"),
        (F.col("average") / total * 100).alias("average_pct"),
    )


# --- nested documents -----------------------------------------------------------------------

def lane_detail(lanes: DataFrame, cameras: DataFrame, ledger: DataFrame, lane_id: int | None = None) -> DataFrame:
    """One lane (or all) with its cameras in road order and its tallies."""
    if lane_id is not None:
        lanes, cameras, ledger = (d.where(F.col("lane_id") == lane_id) for d in (lanes, cameras, ledger))
    camera = F.struct("position_km", "camera_id", "speed_limit")
    placed = cameras.groupBy("lane_id").agg(F.array_sort(F.collect_list(camera)).alias("cameras"))
    empty = F.array().cast(placed.schema["cameras"].dataType)
    detail = lanes.join(placed, "lane_id", "left").join(violation_counts_by_lane(ledger), "lane_id", "left")
    return detail.withColumn("cameras", F.coalesce("cameras", empty)).na.fill(0, ["total", "instantaneous", "average"])


def car_with_violations(cars: DataFrame, ledger: DataFrame, plate: str | None = None) -> DataFrame:
    """One car (or all) with its violations, newest first; a clean car has an empty list.

    The ledger holds one row per plate and window, so a list grows with the time covered (at most
    144 rows a day for ten-minute windows), not with the traffic of a plate.
    """
    if plate is not None:
        cars, ledger = (d.where(F.col("car_plate") == plate) for d in (cars, ledger))
    body = [c for c in ledger.columns if c not in ("car_plate", "detected_at")]
    history = ledger.groupBy("car_plate").agg(
        F.sort_array(F.collect_list(F.struct("detected_at", *body)), asc=False).alias("violations")
    )
    empty = F.array().cast(history.schema["violations"].dataType)
    return cars.join(history, "car_plate", "left").withColumn("violations", F.coalesce("violations", empty))


def car_history_pieces(cars: DataFrame, ledger: DataFrame, n: int = 500) -> DataFrame:
    """Each car's violations in pieces of at most ``n``: ``month`` of the window and ``piece`` from 0, newest first.

    Within a month the ledger's key allows a plate one row per window, so what is numbered together is
    bounded, however long the history is. A clean car has one piece without a month, with an empty list.
    """
    columns = [c for c in ledger.columns if c not in ("car_plate", "detected_at")]
    month = F.date_format("window_start", "yyyy-MM")
    row = F.struct("detected_at", *columns)
    newest = Window.partitionBy("car_plate", "month").orderBy(F.col("_row").desc())
    numbered = ledger.select("car_plate", month.alias("month"), row.alias("_row")).withColumn(
        "piece", F.floor((F.row_number().over(newest) - 1) / n).cast("int")
    )
    pieces = numbered.groupBy("car_plate", "month", "piece").agg(F.sort_array(F.collect_list("_row"), asc=False).alias("violations"))
    empty = F.array().cast(pieces.schema["violations"].dataType)
    return cars.join(pieces, "car_plate", "left").withColumns(
        {"piece": F.coalesce("piece", F.lit(0)), "violations": F.coalesce("violations", empty)}
    )


# --- registration ---------------------------------------------------------------------------

def register_cars(cars: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """New cars to insert, and per plate the number of requests refused as already taken.

    A plate given twice in one batch is inserted once. Both results come from one reduction per
    plate, which combines before the shuffle.
    """
    fields = CAR.fieldNames()
    offered = incoming.groupBy("car_plate").agg(
        F.count(F.lit(1)).alias("requests"), F.min(F.struct(*fields)).alias("_car")
    )
    known = cars.select("car_plate").distinct().withColumn("_known", F.lit(True))
    judged = offered.join(known, "car_plate", "left").withColumn("_known", F.coalesce("_known", F.lit(False)))
    inserted = judged.where(~F.col("_known")).select("_car.*")
    refused = F.when(F.col("_known"), F.col("requests")).otherwise(F.col("requests") - 1)
    return inserted, judged.select("car_plate", refused.alias("refused")).where(F.col("refused") > 0)


def upsert_by_key(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Whole-record replace or insert; of several incoming rows for a key the least one is taken."""
    columns = target.columns
    fresh = incoming.groupBy(key).agg(F.min(F.struct(*columns)).alias("_row")).select("_row.*")
    return target.join(fresh.select(key), key, "left_anti").select(columns).unionByName(fresh.select(columns))


def upsert_counts(target: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """One row: keys inserted and keys updated by the same upsert."""
    known = target.select(key).distinct().withColumn("_known", F.lit(True))
    keys = incoming.select(key).distinct().join(known, key, "left")
    return keys.agg(
        F.count_if(F.col("_known").isNull()).alias("inserted"), F.count_if(F.col("_known")).alias("updated")
    )


def without_violations(ledger: DataFrame, since=None) -> DataFrame:
    """The ledger after a delete: nothing left, or only rows not detected at or after ``since``."""
    if since is None:
        return ledger.where(F.lit(False))
    late = F.col("detected_at") >= F.lit(since).cast("timestamp")
    return ledger.where(~F.coalesce(late, F.lit(False)))


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n")) for name, df in tables.items()]
    united = counts[0]
    for one in counts[1:]:
        united = united.unionByName(one)
    return united
