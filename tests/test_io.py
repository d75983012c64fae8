from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lanewarden.operators import dedup, detect
from lanewarden.sources import events as sources
from lanewarden.sources import sinks


def test_bad_events_give_no_violation_and_no_error(spark):
    good = '{"event_id":"1","car_plate":"A","lane_id":1,"camera_id":1,"camera_index":0,"position_km":1.0,"speed_limit":90.0,"timestamp":"%s","speed_reading":%s}'
    texts = [good % ("2024-01-01T08:00:00+00:00", "120.0"), good % ("noon", "120.0"), good % ("2024-01-01T08:00:00", "null"), "{", ""]
    raw = spark.createDataFrame([(t.encode(),) for t in texts], "value binary")
    parsed = sources.parse_events(raw)
    assert parsed.count() == 5
    assert detect.all_violations(parsed).count() == 1


def test_kafka_needs_its_connector(spark):
    with pytest.raises(PySparkException, match="(?i)kafka"):
        sources.read_events(spark, {"kafka.bootstrap.servers": "none:9092", "subscribe": "camera-events"})


def test_read_events_from_any_stream(spark, tmp_path, crossings):
    events = crossings([("A", 1, 0, 0, 90, 120.0)])
    sources.to_wire(events).select(F.col("value").cast("string")).write.text(str(tmp_path / "topic"))
    stream = sources.read_events(spark, {"path": str(tmp_path / "topic")}, source="text")
    assert stream.isStreaming and "event_time" in stream.columns


def test_normalise_fills_missing_ids(spark):
    loose = spark.sql(
        "SELECT * FROM VALUES ('', 'A'), ('x', 'B') AS t(event_id, car_plate)"
    ).selectExpr("*", "'1' AS lane_id", "2.0D AS camera_id", "0 AS camera_index", "'1.5' AS position_km", "90 AS speed_limit",
                 "'2024-01-01T08:00:00' AS timestamp", "'80' AS speed_reading")
    rows = {r["car_plate"]: r for r in sources.normalise_event(loose).collect()}
    assert rows["B"]["event_id"] == "x" and len(rows["A"]["event_id"]) == 36
    assert (rows["A"]["lane_id"], rows["A"]["position_km"], rows["A"]["timestamp"]) == (1, 1.5, "2024-01-01T08:00:00")


def test_topic_count(spark):
    raw = spark.createDataFrame([(0, 4), (0, 9), (2, 0)], "partition int, offset long")
    assert sources.topic_event_count(raw).first().asDict() == {"events": 11, "partitions": 2}


def test_replay_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("timestamp,camera_id,car_plate,speed_reading\n2024-01-01 08:00:05,1,A,80\nbad,1,A,80\n")
    (tmp_path / "b.csv").write_text("timestamp,camera_id,car_plate,speed_reading\n2024-01-01 08:00:01,2.0,B,81.5\n2024-01-01 08:00:02,,B,80\n2024-01-01 08:00:03,1,B,\n")
    found = sources.read_replay_csv(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert [(r["car_plate"], r["camera_id"]) for r in sources.in_time_order(found).collect()] == [("B", 2), ("A", 1)]
    assert [r["car_plate"] for r in sources.in_time_order(found, 1).collect()] == ["B"]


def test_registry(spark, tmp_path):
    (tmp_path / "v.csv").write_text("car_plate,owner_name,owner_addr,vechicle_type,registration_date\nB,b,x,car,2020-01-01\nA,a,x,van,2021-01-01\n")
    cars = sources.read_vehicle_registry(spark, str(tmp_path / "v.csv"), limit=1)
    assert cars.collect()[0].asDict() == {
        "car_plate": "A", "owner_name": "a", "owner_addr": "x", "vehicle_type": "van", "registration_date": "2021-01-01",
    }


def test_ledger_writer_is_idempotent(spark, tmp_path, crossings):
    path, reports, sent = str(tmp_path / "ledger"), [], []
    found = detect.all_violations(
        crossings([("A", 1, 0, 0, 90, 120.0), ("A", 1, 1, 25, 90, 130.0), ("B", 1, 0, 90_000, 90, 95.0)])
    )
    writer = sinks.LedgerWriter(path, report=reports.append, publish=lambda df, _: sent.append(df.count()))
    writer(found, 0)
    before = sorted(map(tuple, sinks.read_ledger(spark, path).collect()))
    writer(found, 0)
    writer(found.where("false"), 1)
    assert sorted(map(tuple, sinks.read_ledger(spark, path).collect())) == before and len(before) == 2
    assert reports == [
        {"batch_id": 0, "violations": 4, "instant": 3, "average": 1, "new": 2, "duplicate": 2},
        {"batch_id": 0, "violations": 4, "instant": 3, "average": 1, "new": 0, "duplicate": 4},
    ]
    assert sent == [4, 4]


def test_crash_between_publish_and_write_is_repaired_by_the_replay(spark, tmp_path, crossings):
    path = str(tmp_path / "ledger")
    found = detect.detect_instantaneous(crossings([("A", 1, 0, 0, 90, 120.0), ("B", 1, 0, 5, 90, 120.0)]))

    def crash(df, number):
        raise RuntimeError("lost the broker")

    with pytest.raises(RuntimeError):
        sinks.LedgerWriter(path, publish=crash)(found, 0)
    assert sinks.read_ledger(spark, path).count() == 0
    sinks.LedgerWriter(path)(found.where("car_plate = 'A'"), 0)
    sinks.LedgerWriter(path)(found, 0)
    assert sorted(r["car_plate"] for r in sinks.read_ledger(spark, path).collect()) == ["A", "B"]


def test_ledger_scan_prunes_days(spark, tmp_path, crossings):
    path = str(tmp_path / "ledger")
    sinks.LedgerWriter(path)(detect.detect_instantaneous(crossings([("A", 1, 0, 86_400 * d, 90, 120.0) for d in range(3)])), 0)
    from lanewarden.operators.ledger import filter_violations

    day = filter_violations(sinks.read_ledger(spark, path), date="2024-01-02", car_plate="A")
    assert day.count() == 1
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "EqualTo(car_plate,A)" in plan


def test_export_and_copies(spark, tmp_path, crossings):
    stored = dedup.to_stored_violation(
        detect.detect_instantaneous(crossings([("A", 1, 0, 0, 90, 120.0), ("B", 1, 0, 60, 90, 121.0)])),
        detected_at=F.col("timestamp_end"),
    )
    sinks.export_violations_csv(stored, str(tmp_path / "csv"))
    text = sorted((tmp_path / "csv").glob("part-*.csv"))
    lines = [line for part in text for line in part.read_text().splitlines() if not line.startswith("car_plate,")]
    assert [line.split(",")[0] for line in lines] == ["B", "A"]
    header = text[0].read_text().splitlines()[0].split(",")
    assert len(header) == 14 and "window_start" not in header
    copy = sinks.overwrite_ledger_copy(dedup.for_ledger_table(stored), str(tmp_path / "copy"))
    assert sinks.read_ledger(spark, copy).count() == 2
    sent = sinks.republish_violations(stored).where("key = 'A'").first()
    assert '"timestamp_start":"2024-01-01T08:00:00"' in sent["value"]


def test_detectors_read_only_their_columns(spark, tmp_path, crossings):
    crossings([("A", 1, 0, 0, 90, 120.0)]).withColumn("note", F.lit("x")).write.parquet(str(tmp_path / "c"))
    events = spark.read.parquet(str(tmp_path / "c"))
    average = detect.detect_average(events)._jdf.queryExecution().executedPlan().toString()
    assert "speed_reading:double" not in average and "note" not in average
    spot = detect.detect_instantaneous(events)._jdf.queryExecution().executedPlan().toString()
    assert "camera_index" not in spot and "note" not in spot
    assert "IsNotNull(speed_reading)" in spot
