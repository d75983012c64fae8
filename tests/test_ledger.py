from __future__ import annotations

import datetime as dt

import pytest
from conftest import T0
from pyspark.sql import functions as F

from lanewarden.functions import scalars as S
from lanewarden.operators import dedup, detect, geometry, live
from lanewarden.operators import ledger as L
from lanewarden.sources import sinks
from lanewarden.sources.sinks import append_to_ledger, read_ledger

CAMERA = "camera_id int, lane_id int, position_km double, speed_limit double"
CAR = "car_plate string, owner_name string, owner_addr string, vehicle_type string, registration_date string"


@pytest.fixture
def stored(crossings):
    rows = [
        ("A1", 1, 0, 0, 90, 120.0), ("A1", 1, 1, 60, 90, 80.0), ("A1", 1, 0, 90_000, 90, 130.0),
        ("B1", 2, 0, 100, 90, 95.0), ("B2", 2, 0, 200, 90, 80.0), ("B2", 2, 1, 230, 90, 80.0),
    ]
    first = dedup.first_per_plate_window(detect.all_violations(crossings(rows))).drop("window_start")
    return dedup.to_stored_violation(first, detected_at=F.col("timestamp_end") + F.expr("interval 1 second"))


def test_filters(stored):
    count = lambda **f: L.filter_violations(stored, **f).count()
    assert count() == 4
    assert count(lane_id=2) == 2
    assert count(violation_type="AVERAGE") == 1
    assert count(car_plate="A1", violation_type="", date="") == 2
    assert count(date="2024-01-01") == 3 and count(date="2024-01-02T10:00:00") == 1
    assert count(lane_id=2, violation_type="AVERAGE", date="2024-01-02") == 0
    assert L.matching_total(stored, lane_id=1).first()["total"] == 2
    with pytest.raises(ValueError):
        count(violation_type="LOUD")


def test_pages(stored):
    newest = [r["car_plate"] for r in L.page_violations(stored, limit=10).collect()]
    assert newest == ["A1", "B2", "B1", "A1"]
    assert [r["car_plate"] for r in L.page_violations(stored, skip=1, limit=2).collect()] == ["B2", "B1"]
    assert L.page_violations(stored, skip=4).count() == 0
    for bad in ({"limit": 0}, {"limit": 501}, {"skip": -1}):
        with pytest.raises(ValueError):
            L.page_violations(stored, **bad)


def test_pages_follow_each_other_across_partitions_and_ties(spark):
    """Forty rows share each detection time; one has none and is last."""
    rows = [(f"P{i:04d}", T0 + dt.timedelta(seconds=i // 40) if i else None, T0) for i in range(400)]
    ledger = spark.createDataFrame(rows, "car_plate string, detected_at timestamp, window_start timestamp").repartition(7)
    want = [r[0] for r in sorted(rows, key=lambda r: (r[1] is None, -(r[1] or T0).timestamp(), r[0]))]
    paged = [r["car_plate"] for skip in range(0, 400, 150) for r in L.page_violations(ledger, skip=skip, limit=150).collect()]
    assert paged == want
    cars = spark.createDataFrame([(p, "", "", "", "") for p in ["", "A", "AB", "PLATE-11", "PLATE-12", "PLATE-1", "é"]], CAR)
    assert [r[0] for s in (0, 3, 6) for r in L.page_cars(cars, skip=s, limit=3).collect()] == [
        "", "A", "AB", "PLATE-1", "PLATE-11", "PLATE-12", "é"
    ]


def test_prefix_search_is_literal(spark):
    cars = spark.createDataFrame([("AB 1",), ("abc",), ("A.1",), ("AX1",)], "car_plate string")
    find = lambda p: sorted(r[0] for r in L.search_cars(cars, p).collect())
    assert find("ab") == ["AB 1", "abc"]
    assert find("A.") == ["A.1"]
    assert len(find("")) == len(find(None)) == 4


def test_ids_and_keys(stored):
    named = L.with_violation_id(stored)
    assert named.select("id").distinct().count() == 4
    one = named.where("car_plate = 'B1'").first()["id"]
    assert L.violation_by_id(stored, one).first()["car_plate"] == "B1"
    assert L.violation_by_id(stored, "absent").count() == 0
    key = stored.where("car_plate = 'B1'").select(
        S.violation_key(F.col("car_plate"), F.col("violation_type"), F.col("timestamp_start"), F.col("camera_id_start"))
    )
    assert key.first()[0] == "B1|INSTANTANEOUS|2024-01-01T08:01:40|20"


def test_iso_text_and_parse_utc(spark):
    stamps = spark.sql("SELECT timestamp'2024-01-01 08:00:00.05' AS t")
    assert stamps.select(S.iso_text(F.col("t"))).first()[0] == "2024-01-01T08:00:00.050000"
    texts = spark.createDataFrame(
        [("2024-01-01T08:00:00",), ("2024-01-01T08:00:00Z",), ("2024-01-01T10:30:00+02:30",), ("soon",), (None,)], "s string"
    )
    expected = dt.datetime(2024, 1, 1, 8)
    assert [r[0] for r in texts.select(S.parse_utc(F.col("s"))).collect()] == [expected] * 3 + [None, None]


def test_utc_is_used_whatever_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        at = spark.sql("SELECT timestamp_seconds(1704096000) AS t")
        row = at.select(
            F.unix_seconds(S.window_start(F.col("t"), 0)), F.unix_seconds(S.day_start(F.col("t"))), S.day_of(F.col("t")),
            F.unix_seconds(S.parse_utc(F.lit("2024-01-01T08:00:00"))),
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(row) == (1704096000, 1704067200, dt.date(2024, 1, 1), 1704096000)


def test_summaries(spark, stored):
    lanes = spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "lane_id int, name string")
    cameras = spark.createDataFrame([(1, 1, 1.0, 90.0), (2, 1, 2.0, 80.0), (3, 3, 1.0, 90.0)], CAMERA)
    summary = L.lanes_summary(lanes, cameras, stored)
    rows = {r["lane_id"]: (r["camera_count"], r["total"], r["instantaneous"], r["average"]) for r in summary.collect()}
    assert rows == {1: (2, 2, 2, 0), 2: (0, 2, 1, 1), 3: (1, 0, 0, 0)}
    assert L.network_totals(summary).first().asDict() == {
        "lanes": 3, "total": 4, "instantaneous": 3, "average": 1, "cameras": 3,
    }
    assert {r["lane_id"]: (r[1], r[2]) for r in L.type_share_by_lane(summary).collect()} == {
        1: (100.0, 0.0), 2: (50.0, 50.0), 3: (0.0, 0.0),
    }
    detail = L.lane_detail(lanes, cameras, stored, 1).first()
    assert [c["camera_id"] for c in detail["cameras"]] == [1, 2] and detail["total"] == 2
    assert L.lane_detail(lanes, cameras, stored, 2).first()["cameras"] == []
    assert L.lane_detail(lanes, cameras, stored, 9).count() == 0
    limits = {r["lane_id"]: r["limits"] for r in geometry.lane_limits(cameras).collect()}
    assert limits == {1: [80.0, 90.0], 3: [90.0]}


def test_car_history(spark, stored):
    cars = spark.createDataFrame([("A1", "o", "a", "t", "d"), ("Z", "o", "a", "t", "d")], CAR)
    found = {r["car_plate"]: r["violations"] for r in L.car_with_violations(cars, stored).collect()}
    assert [v["lane_id"] for v in found["A1"]] == [1, 1] and found["Z"] == []
    assert found["A1"][0]["detected_at"] > found["A1"][1]["detected_at"]
    assert L.car_with_violations(cars, stored, "nobody").count() == 0
    capture = L.latest_capture(stored, cars).first()
    assert (capture["car_plate"], capture["owner_name"]) == ("A1", "o")


def test_feed_merges_on_the_natural_key(stored):
    late = stored.withColumn("detected_at", F.col("detected_at") + F.expr("interval 1 hour"))
    merged = L.merge_feed(stored, late.where("car_plate = 'B1'"))
    assert merged.count() == 4
    assert merged.where("car_plate = 'B1'").first()["detected_at"] == stored.where("car_plate = 'B1'").first()["detected_at"]
    assert L.merge_feed(stored, late, 2).count() == 2
    assert L.recent_feed(stored, 60, lane_id=2).count() == 2


def test_register_and_upsert(spark):
    cars = spark.createDataFrame([("A", "old", "x", "t", "d")], CAR)
    incoming = spark.createDataFrame([("A", "new", "x", "t", "d"), ("B", "b1", "x", "t", "d"), ("B", "b2", "x", "t", "d")], CAR)
    inserted, refused = L.register_cars(cars, incoming)
    assert [(r["car_plate"], r["owner_name"]) for r in inserted.collect()] == [("B", "b1")]
    assert {r["car_plate"]: r["refused"] for r in refused.collect()} == {"A": 1, "B": 1}
    after = {r["car_plate"]: r["owner_name"] for r in L.upsert_by_key(cars, incoming, "car_plate").collect()}
    assert after == {"A": "new", "B": "b1"}
    assert L.upsert_counts(cars, incoming, "car_plate").first().asDict() == {"inserted": 1, "updated": 1}


def test_delete(stored):
    unseen = stored.limit(1).withColumn("detected_at", F.lit(None).cast("timestamp"))
    both = stored.unionByName(unseen)
    assert L.without_violations(both).count() == 0
    assert L.without_violations(both, "2024-01-02 00:00:00").count() == 4
    counts = {r["table_name"]: r["n"] for r in L.table_counts({"a": stored, "b": both}).collect()}
    assert counts == {"a": 4, "b": 5}


def test_append_cameras(spark):
    lanes = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "lane_id int, name string")
    cameras = spark.createDataFrame([(4, 1, 1.0, 80.0), (9, 1, 2.5, 90.0)], CAMERA)
    requests = spark.createDataFrame(
        [(1, 2, None), (2, 1, None), (3, 1, 120.0), (4, 1, None), (5, 8, None), (6, 1, -5.0), (7, 3, 60.0), (8, 3, None)],
        "request_id int, lane_id int, speed_limit double",
    )
    added = geometry.append_cameras(cameras, lanes, requests).orderBy("camera_id").collect()
    assert [tuple(r) for r in added] == [
        (10, 2, 1.0, 100.0), (11, 1, 3.5, 90.0), (12, 1, 4.5, 120.0), (13, 1, 5.5, 120.0), (14, 3, 1.0, 60.0), (15, 3, 2.0, 60.0),
    ]
    assert geometry.unknown_lane_requests(requests, lanes).count() == 1


def test_remove_last_camera(spark):
    lanes = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "lane_id int, name string")
    cameras = spark.createDataFrame(
        [(1, 1, 1.0, 90.0), (2, 1, 3.0, 90.0), (3, 1, 2.0, 90.0), (4, 2, 1.0, 90.0), (5, 2, 2.0, 90.0)], CAMERA
    )
    asked = spark.createDataFrame([(1,), (1,), (1,), (2,), (3,), (9,)], "lane_id int")
    assert [tuple(r) for r in geometry.remove_last_cameras(cameras, lanes, asked).collect()] == [(2, 1, 3.0, 90.0)]
    assert sorted(map(tuple, geometry.refused_removals(cameras, lanes, asked).collect())) == [(1, 2), (2, 1), (3, 1)]
    after = geometry.cameras_after_removal(cameras, lanes, asked)
    assert sorted(r["camera_id"] for r in after.collect()) == [1, 3, 4, 5]
    diff = geometry.camera_config_diff(cameras, after.where("lane_id = 1")).orderBy("lane_id").collect()
    assert [tuple(r) for r in diff] == [(1, 3, 2), (2, 2, None)]


def test_layout(spark):
    plan = spark.createDataFrame([(2, 2, 100.0), (1, 3, 90.0), (3, 0, 50.0)], "lane_id int, camera_count int, speed_limit double")
    laid = geometry.lay_out_cameras(plan, 0.5).orderBy("camera_id").collect()
    assert [(r["camera_id"], r["lane_id"], r["position_km"]) for r in laid] == [
        (1, 1, 0.5), (2, 1, 1.0), (3, 1, 1.5), (4, 2, 0.5), (5, 2, 1.0),
    ]


def test_live_picture(spark, crossings):
    events = crossings([("A", 1, 0, 0, 90, 95.0), ("A", 1, 1, 30, 90, 80.0), ("B", 1, 0, 33, 90, 99.0), ("C", 2, 0, 40, 90, 10.0)])
    now = F.lit(T0 + dt.timedelta(seconds=36.5))
    vehicles = live.live_vehicles(events, now)
    assert {r["car_plate"]: (r["camera_id"], r["over"]) for r in vehicles.collect()} == {"A": (11, False), "B": (10, True)}
    assert [tuple(r) for r in live.vehicles_in_segment(vehicles).collect()] == [(1, 2)]
    assert [r["camera_id"] for r in live.camera_pulse(events, F.lit(T0 + dt.timedelta(seconds=33.8))).collect()] == [10]
    found = detect.detect_average(events, window="1 minute").unionByName(detect.detect_instantaneous(events))
    ledger = dedup.to_stored_violation(found, detected_at=F.col("timestamp_end"))
    marked = {r["car_plate"]: r["violation_type"] for r in live.mark_active_vehicles(vehicles, ledger).collect()}
    assert marked == {"A": "AVERAGE", "B": "INSTANTANEOUS"}
    newest = live.latest_n_per_lane(events.withColumn("event_id", F.monotonically_increasing_id()), 2)
    assert sorted(r["car_plate"] for r in newest.collect()) == ["A", "B", "C"]
    cameras = spark.createDataFrame([(10, 1, 1.0, 97.0)], CAMERA)
    bare = events.withColumn("speed_limit", F.when(F.col("car_plate") == "A", F.col("speed_limit")))
    assert {r["car_plate"]: r["over"] for r in live.over_limit(bare, cameras).collect()} == {"A": True, "B": True}
    assert live.route_by_lane(events).count() == 4 and live.route_by_lane(events, 2).count() == 1


def _days_of(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in sorted(path.rglob("*.parquet"))}


@pytest.fixture
def on_disk(spark, crossings, tmp_path):
    """Three days of violations by many plates, each day in two files."""
    path = tmp_path / "ledger"
    for part in (0, 1):
        rows = [(f"P{i}", 1, 0, 90_000 * day + 700 * i, 90, 120.0) for day in range(3) for i in range(part, 20, 2)]
        first = dedup.first_per_plate_window(detect.all_violations(crossings(rows))).drop("window_start")
        append_to_ledger(dedup.to_stored_violation(first, detected_at=F.col("timestamp_end") + F.expr("interval 1 second")), str(path), 30)
    return path


def test_a_delete_rewrites_only_the_days_it_touches(spark, on_disk):
    before = _days_of(on_disk)
    since = T0 + dt.timedelta(seconds=90_000 + 7000)
    days = sinks.delete_stored_violations(spark, str(on_disk), since)
    assert days == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    after = _days_of(on_disk)
    kept = {f: t for f, t in before.items() if f.startswith("date=2024-01-01")}
    assert kept and kept == {f: t for f, t in after.items() if f in kept} and not any("2024-01-03" in f for f in after)
    assert read_ledger(spark, str(on_disk)).count() == 20 + 10
    assert sinks.delete_stored_violations(spark, str(on_disk), since) == [] and _days_of(on_disk) == after
    sinks.delete_stored_violations(spark, str(on_disk))
    assert read_ledger(spark, str(on_disk)).count() == 0


def test_closed_days_are_compacted_once(spark, on_disk):
    path, today = str(on_disk), dt.date(2024, 1, 3)
    rows = sorted(map(str, read_ledger(spark, path).collect()))
    assert sinks.compact_ledger(spark, path, today) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    files = [f.split("/")[0] for f in _days_of(on_disk)]
    assert [files.count(f"date=2024-01-0{d}") for d in (1, 2, 3)] == [1, 1, 2]
    assert sorted(map(str, read_ledger(spark, path).collect())) == rows
    assert sinks.compact_ledger(spark, path, today) == [] == sinks.compact_ledger(spark, path + "-none", today)


def test_newest_rows_and_references_prune(spark, on_disk):
    ledger = read_ledger(spark, str(on_disk))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    for n in (1, 7, 25, 60, 100):
        assert L.newest_rows(ledger, n).collect() == L.recent_feed(ledger, n).collect()
    assert "GreaterThanOrEqual(detected_at" in plan(L.newest_rows(ledger, 7))
    assert "PushedFilters: [IsNotNull(detected_at), " in plan(L.page_violations(ledger, skip=5, limit=5))
    ref = L.with_violation_ref(ledger.where("car_plate = 'P3'")).orderBy("window_start").first()
    found = L.violation_by_ref(ledger, ref["ref"])
    assert [(r["car_plate"], r["window_start"]) for r in found.collect()] == [("P3", ref["window_start"])]
    assert "EqualTo(car_plate,P3)" in plan(found) and "(date" in plan(found).split("PartitionFilters")[1].split("PushedFilters")[0]
    for damaged in ("", "x", ref["ref"][:-1] + "z", "-".join(["GG", *ref["ref"].split("-")[1:]])):
        assert L.violation_by_ref(ledger, damaged).count() == 0


def test_references_hold_any_plate(spark):
    plates = ["A-1", "", "Ü|日本", "p" * 300]
    df = spark.createDataFrame([(p, T0) for p in plates], "p string, w timestamp").select(S.violation_ref(F.col("p"), F.col("w")).alias("r"))
    read = [S.read_violation_ref(row["r"]) for row in df.collect()]
    assert [(p, w.replace(tzinfo=None)) for p, w in read] == [(p, T0) for p in plates]


def test_history_pieces_are_bounded_and_whole(spark, on_disk):
    cars = spark.createDataFrame([("P1", "", "", "", ""), ("clean", "", "", "", "")], CAR)
    ledger = read_ledger(spark, str(on_disk))
    pieces = L.car_history_pieces(cars, ledger, 2).orderBy("car_plate", "month", "piece").collect()
    assert [(p["car_plate"], p["month"], p["piece"], len(p["violations"])) for p in pieces] == [
        ("P1", "2024-01", 0, 2), ("P1", "2024-01", 1, 1), ("clean", None, 0, 0)
    ]
    whole = L.car_with_violations(cars, ledger, "P1").first()["violations"]
    assert [v for p in pieces[:2] for v in p["violations"]] == whole


def test_lanes_are_routed_on_write(spark, crossings, tmp_path):
    rows = [("A", 1, 0, 5, 90, 80.0), ("B", 2, 0, 1, 90, 80.0), ("C", 1, 0, 2, 90, 80.0), ("D", None, 0, 2, 90, 80.0)]
    events = crossings([r for r in rows if r[1]]).unionByName(crossings([("D", 9, 0, 2, 90, 80.0)]).withColumn("lane_id", F.lit(None).cast("int")))
    sinks.write_by_lane(events, str(tmp_path / "lanes"))
    lane = spark.read.parquet(str(tmp_path / "lanes")).where("lane_id = 1")
    assert [r["car_plate"] for r in lane.collect()] == ["C", "A"]
    assert "isnotnull(lane_id" in lane._jdf.queryExecution().executedPlan().toString()
    assert spark.read.parquet(str(tmp_path / "lanes")).count() == 3
