from __future__ import annotations

import datetime as dt
import random

from conftest import T0
from pyspark.sql import functions as F

from lanewarden.functions import scalars as S
from lanewarden.operators import dedup, detect, trips


def test_window_start(spark):
    at = spark.sql("SELECT timestamp'2024-01-01 08:58:30.5' AS t")
    found = at.select(*[S.window_start(F.col("t"), m).alias(f"w{m}") for m in (7, 10, 90, 0, 60)]).first()
    assert [v.strftime("%H:%M:%S") for v in found] == ["08:56:00", "08:50:00", "08:00:00", "08:00:00", "08:00:00"]


def test_bucket_edges_and_repeat_offence(crossings):
    minutes = (9, 9.5, 11, 125)
    events = crossings([("A", 1, 0, 60 * m, 90, 120.0) for m in minutes])
    kept = dedup.first_per_plate_window(detect.all_violations(events)).orderBy("timestamp_start").collect()
    assert [r["timestamp_start"] for r in kept] == [T0 + dt.timedelta(minutes=m) for m in (9, 11, 125)]
    assert dedup.first_per_plate_window(detect.all_violations(events), "1 hour").count() == 2


def test_first_is_the_earliest_with_a_fixed_tie_break(crossings):
    events = crossings([("A", 1, 0, 0, 90, 120.0), ("A", 1, 1, 25, 90, 80.0), ("A", 1, 2, 50, 90, 130.0)])
    first = dedup.first_per_plate_window(detect.all_violations(events)).first()
    assert (first["violation_type"], first["camera_id_end"]) == ("AVERAGE", 11)


def test_stored_row(crossings):
    stored = dedup.to_stored_violation(detect.detect_instantaneous(crossings([("A", 1, 0, 3700, 90, 120.0)])))
    row = stored.first()
    assert row["window_start"] == dt.datetime(2024, 1, 1, 9, 0) and row["date"] == dt.datetime(2024, 1, 1)
    assert row["detected_at"] is not None
    assert dict(dedup.for_ledger_table(stored).dtypes)["date"] == "date"


def trip_starts(rows, gap=600):
    """Trips of each plate and lane by a plain scan."""
    found, last = {}, {}
    for plate, lane, index, at, *_ in sorted(rows, key=lambda r: (r[0], r[1], r[3], r[2])):
        previous = last.get((plate, lane))
        start = at if previous is None or at - previous[0] > gap else previous[1]
        last[(plate, lane)] = (at, start)
        found[(plate, lane, index, at)] = start
    return found


def test_trips_by_gap_match_a_plain_scan(crossings):
    draw = random.Random(3)
    rows = [
        ("HOT" if draw.random() < 0.4 else f"C{draw.randrange(5)}", draw.randrange(1, 3), draw.randrange(5),
         draw.randrange(0, 90_000), 90, 80.0)
        for _ in range(500)
    ]
    rows += [("EDGE", 1, 0, 0, 90, 80.0), ("EDGE", 1, 1, 600, 90, 80.0), ("EDGE", 1, 2, 1201, 90, 80.0)]
    rows = list({(r[0], r[1], r[2], r[3]): r for r in rows}.values())
    named = trips.assign_trips(crossings(rows), slice_width="1 hour")
    seconds = lambda t: (t - T0).total_seconds()
    found = {
        (r["car_plate"], r["lane_id"], r["camera_index"], seconds(r["event_time"])): seconds(r["trip_start"])
        for r in named.collect()
    }
    assert found == trip_starts(rows)


def test_segments_end_with_the_trip(crossings):
    events = crossings([("A", 1, 0, 3500, 90, 80.0), ("A", 1, 1, 3620, 90, 80.0), ("A", 1, 2, 4300, 90, 80.0)])
    rows = trips.consecutive_segments(events, slice_width="1 hour").orderBy("event_time").collect()
    assert [r["dt_seconds"] for r in rows] == [120.0, None, None]
    assert rows[0]["segment_speed"] == 30.0 and rows[1]["next_camera_id"] is None


def test_last_crossing_closes_a_missed_camera(crossings):
    events = crossings([("A", 1, 0, 0, 90, 80.0), ("A", 1, 2, 60, 90, 80.0)])
    found = trips.detect_average_last_crossing(events).collect()
    assert [r["avg_speed"] for r in found] == [120.0]


def test_summaries(crossings):
    rows = [("N", 1, i, 50 * i, 90, 70.0) for i in range(3)] + [("F", 1, i, 30 * i, 90, 120.0) for i in range(3)]
    rows += [("S", 1, i, 30 * i, 90, 80.0) for i in range(3)]
    sums = trips.trip_summary(trips.consecutive_segments(crossings(rows), ["car_plate"]), ["car_plate"])
    assert {r["car_plate"]: r["label"] for r in sums.collect()} == {"N": "clean", "F": "INSTANT+AVG", "S": "AVERAGE"}
    assert {r["n_events"] for r in sums.collect()} == {3}


def test_iso_text_is_utc_in_any_session(spark):
    at = spark.sql("SELECT timestamp'2024-03-31 23:30:05.25Z' AS t UNION ALL SELECT NULL")
    spark.conf.set("spark.sql.session.timeZone", "Europe/Rome")
    try:
        assert [r[0] for r in at.select(S.iso_text(F.col("t"))).collect()] == ["2024-03-31T23:30:05.250000", None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_enrichment_skips_unknown_cameras(spark):
    cameras = spark.createDataFrame(
        [(7, 1, 2.0, 90.0), (5, 1, 1.0, 90.0)], "camera_id int, lane_id int, position_km double, speed_limit double"
    )
    raw = spark.createDataFrame([("A", 7), ("A", 5), ("B", 99)], "car_plate string, camera_id int")
    found = {r["camera_id"]: r["camera_index"] for r in trips.enrich_crossings(raw, cameras).collect()}
    assert found == {5: 0, 7: 1}
    assert trips.unknown_camera_count(raw, cameras).first()["skipped"] == 1
