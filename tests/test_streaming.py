"""Streams against their batch twins, with late, repeated and resumed input."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from conftest import T0
from pyspark.sql import functions as F

from lanewarden.operators import dedup, detect
from lanewarden.plans import streams
from lanewarden.plans.streams import _rocksdb, replay
from lanewarden.sources.sinks import publisher, read_ledger
from lanewarden.streaming import jobs, stateful
from lanewarden.streaming.micro_batches import BatchDetector

SNEAKY = [("SNK", 1, 0, 0, 90, 80.0), ("SNK", 1, 1, 30, 90, 80.0), ("SNK", 1, 2, 60, 90, 80.0)]
FAST = [("SPD", 1, 0, 10, 90, 120.0), ("SPD", 1, 0, 7500, 90, 120.0)]
TICK = [("~", 9, 0, 90_000, 90, 1.0)]


def landing(crossings, rows):
    return crossings(rows).withColumn("event_id", F.lit("e"))


def run(spark, tmp_path, landings, transform, name="out"):
    """Replay the landings through ``transform``; the rows written and the progress of every batch."""
    out, checkpoint, progress = str(tmp_path / name), str(tmp_path / f"{name}-checkpoint"), []

    class Seen:
        def __init__(self, query):
            self.query = query

        def awaitTermination(self):
            self.query.awaitTermination()
            progress.extend(self.query.recentProgress)

    replay(spark, landings, lambda events: Seen(jobs.append_table(transform(events), out, checkpoint, once=True)))
    return spark.read.parquet(out), progress


def ledger(events):
    return jobs.ledger_stream(detect.all_violations(events))


def test_ledger_stream_equals_batch_and_drops_late_rows(spark, tmp_path, crossings):
    """Out-of-order rows count; a repeat after two hours is recorded; state is gone at the end."""
    first = landing(crossings, [SNEAKY[2], FAST[0], SNEAKY[0], SNEAKY[1]])
    late = landing(crossings, [("LATE", 1, 0, 20, 90, 130.0)])
    rows, progress = run(
        spark, tmp_path, [first, landing(crossings, FAST[1:]), late, landing(crossings, TICK)], ledger
    )
    batch = dedup.first_per_plate_window(detect.all_violations(crossings(SNEAKY + FAST)))
    order = ["car_plate", "window_start"]
    assert rows.orderBy(order).collect() == batch.select(rows.columns).orderBy(order).collect()
    assert rows.count() == 3
    assert sum(s.numRowsDroppedByWatermark for p in progress for s in p.stateOperators) > 0
    assert progress[-1].stateOperators[0].numRowsTotal == 0


def test_join_state_is_evicted(spark, tmp_path, crossings):
    rows, progress = run(
        spark, tmp_path, [landing(crossings, SNEAKY), landing(crossings, TICK)], detect.detect_average
    )
    assert rows.count() == 2
    assert progress[-1].stateOperators[0].numRowsTotal <= 3


def test_legal_crossings_advance_event_time(spark, tmp_path, crossings):
    """With the single-camera detector alone, only legal crossings come after the offence."""
    _, progress = run(
        spark, tmp_path, [landing(crossings, FAST[:1]), landing(crossings, TICK)],
        lambda events: jobs.flag_once_live(detect.detect_instantaneous(events)),
    )
    assert progress[-1].eventTime["watermark"].startswith("2024-01-02T08:50")


def test_live_flag_suppresses_within_the_delay_only(spark, tmp_path, crossings):
    repeats = [("SPD", 1, 0, s, 90, 120.0) for s in (60, 300)]
    rows, _ = run(
        spark, tmp_path,
        [landing(crossings, [("SPD", 1, 0, 0, 90, 120.0)]), landing(crossings, repeats), landing(crossings, TICK),
         landing(crossings, [("SPD", 1, 0, 100_000, 90, 120.0)])],
        lambda events: jobs.flag_once_live(detect.all_violations(events)),
    )
    starts = sorted((r["timestamp_start"] - T0).total_seconds() for r in rows.collect())
    assert starts == [0.0, 100_000.0]


def test_exact_rolling_flag(spark, tmp_path, crossings):
    at = (0, 599, 600, 700, 1199, 1200)
    with _rocksdb(spark):
        rows, _ = run(
            spark, tmp_path, [*[landing(crossings, [("A", 1, 0, s, 90, 120.0)]) for s in at], landing(crossings, TICK)],
            lambda events: stateful.rolling_flag_stream(detect.detect_instantaneous(events)),
        )
    start = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    assert sorted(r["start_us"] // 1_000_000 - start for r in rows.collect()) == [0, 600, 1200]


def test_rolling_flag_is_the_same_for_any_order_and_in_batch(spark, tmp_path, crossings):
    """A plate that offends every 37 seconds, then after a pause, in shuffled files."""
    seconds = [37 * i for i in range(300)] + [20_000 + 500 * i for i in range(12)]
    expected, last = [], None
    for s in seconds:
        if last is None or s - last >= 600:
            expected.append(s)
            last = s
    random.Random(5).shuffle(seconds)
    offences = landing(crossings, [("A", 1, 0, s, 90, 120.0) for s in seconds]).repartition(8)
    start = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    with _rocksdb(spark):
        rows, progress = run(
            spark, tmp_path, [offences, landing(crossings, TICK)],
            lambda events: stateful.rolling_flag_stream(detect.detect_instantaneous(events)),
        )
    batch = dedup.rolling_flag(detect.all_violations(offences))
    for found in (rows, batch):
        assert sorted(r["start_us"] // 1_000_000 - start for r in found.collect()) == expected


def test_live_vehicles_come_and_go(spark, tmp_path, crossings):
    with _rocksdb(spark):
        rows, _ = run(
            spark, tmp_path,
            [landing(crossings, [("A", 1, 0, 0, 90, 120.0), ("A", 1, 1, 5, 90, 80.0)]), landing(crossings, TICK)],
            stateful.live_vehicle_stream,
        )
    found = sorted((r["car_plate"], r["status"], r["camera_id"], r["over"]) for r in rows.collect())
    assert found == [("A", "gone", 11, False), ("A", "seen", 11, False), ("~", "seen", 90, False)]


def test_many_vehicles_share_a_bucket(spark, tmp_path, crossings):
    """Vehicles of one bucket: ties, a missing reading, one that goes before the other, one that is seen again."""
    first = [("A", 1, 0, 0, 90, 80.0), ("A", 1, 1, 0, 90, 120.0), ("B", 1, 0, 1, 90, None), ("C", 2, 0, 2, 90, 70.0)]
    second = [("B", 1, 1, 700, 90, 95.0), ("C", 2, 1, 1000, 90, 60.0)]
    with _rocksdb(spark):
        rows, _ = run(
            spark, tmp_path, [landing(crossings, first), landing(crossings, second), landing(crossings, TICK)],
            lambda events: stateful.live_vehicle_stream(events, ttl_s=300.0, buckets=1),
        )
    found = sorted((r["car_plate"], r["status"], r["camera_id"], r["speed_reading"], r["over"]) for r in rows.collect())
    assert found == [
        ("A", "gone", 11, 120.0, True), ("A", "seen", 11, 120.0, True),
        ("B", "gone", 11, 95.0, True), ("B", "seen", 10, None, False), ("B", "seen", 11, 95.0, True),
        ("C", "gone", 21, 60.0, False), ("C", "seen", 20, 70.0, False), ("C", "seen", 21, 60.0, False),
        ("~", "seen", 90, 1.0, False),
    ]


def test_next_after_equals_a_plain_statement():
    """Groups of different sizes, equal times, and times so far apart that no combined key would fit."""
    rng = random.Random(4)
    for far in (1, 10**17):
        rows = sorted((g, rng.randrange(40) * far) for g in range(6) for _ in range(rng.randrange(1, 30)))
        group, at = (np.array(x, np.int64) for x in zip(*rows))
        for width in (1, 5 * far, 50 * far):
            want = [next((j for j, (h, t) in enumerate(rows) if h == g and t >= s + width), len(rows)) for g, s in rows]
            assert stateful._next_after(group, at, width).tolist() == want


def test_detector_resumes_and_resets(spark, tmp_path, crossings):
    run_name, checkpoint, path = jobs.run_paths(str(tmp_path))
    reports = []

    def start(events):
        return jobs.start_detector(events, path, checkpoint, emit="window-close", report=reports.append, once=True)

    replay(spark, [landing(crossings, SNEAKY + FAST[:1]), landing(crossings, FAST[1:]), landing(crossings, TICK)], start)
    assert sorted(r["car_plate"] for r in read_ledger(spark, path).collect()) == ["SNK", "SPD", "SPD"]
    assert sum(r["new"] for r in reports) == 3 and all(r["duplicate"] == 0 for r in reports)
    assert jobs.run_paths(str(tmp_path), run_name) == (run_name, checkpoint, path)
    fresh = jobs.run_paths(str(tmp_path), run_name, reset=True)
    assert fresh[0] != run_name and read_ledger(spark, fresh[2]).count() == 0


def test_detector_stores_and_publishes_what_it_sees(spark, tmp_path, crossings):
    """No later crossing is needed; a repeat of the same plate and window adds nothing."""
    path, sent, log = str(tmp_path / "ledger"), str(tmp_path / "sent"), jobs.ProgressLog()
    again = [("SPD", 1, 0, 20, 90, 125.0)]
    for query in replay(
        spark, [landing(crossings, SNEAKY + FAST[:1]), landing(crossings, again)],
        lambda events: jobs.start_detector(
            events, path, str(tmp_path / "checkpoint"), publish=publisher("parquet", path=sent), hot_plates=["SNK"], once=True
        ),
    ):
        log.poll(query)
    found = {r["car_plate"]: r["speed_reading"] for r in read_ledger(spark, path).collect()}
    assert found == {"SNK": None, "SPD": 120.0} and read_ledger(spark, path).count() == 2
    assert spark.read.parquet(sent).count() == 4
    assert sum(r["input_rows"] for r in log.table(spark).collect()) == 5
    with pytest.raises(ValueError):
        jobs.start_detector(landing(crossings, again), path, "c", emit="never")


def test_batch_detector_equals_the_table_form(spark, tmp_path, crossings):
    """Random crossings dealt to batches out of order, one batch run twice: the violations of one table, once each."""
    draw = random.Random(11)
    rows = [(f"P{draw.randrange(6)}", draw.randrange(2), draw.randrange(4), draw.randrange(1800), 90, draw.choice([80.0, 120.0]))
            for _ in range(400)]
    events = crossings(rows)
    dealt = [crossings(rows[i::5]) for i in range(5)]
    for strategy in (detect.ADJACENT, detect.ALL_PAIRS):
        got: dict[int, list] = {}
        folder = str(tmp_path / strategy)

        def write(found, batch):
            got[batch] = [tuple(r) for r in found.collect()]

        detector = BatchDetector(folder, write, strategy=strategy, delay="1 hour", hot_cell_rows=20)
        for number, part in enumerate(dealt[:3]):
            detector(part, number)
        detector = BatchDetector(folder, write, strategy=strategy, delay="1 hour", hot_cell_rows=20)
        for number, part in list(enumerate(dealt))[2:]:
            detector(part, number)
        expected = sorted(str(tuple(r)) for r in detect.all_violations(events, strategy).collect())
        assert sorted(str(r) for rows_ in got.values() for r in rows_) == expected and detector.late == 0


def test_batch_detector_leaves_late_rows_out_and_forgets(spark, tmp_path, crossings):
    got = []
    detector = BatchDetector(str(tmp_path), lambda found, batch: got.extend(found.collect()), strategy=detect.ADJACENT)
    detector(crossings([("A", 1, 0, 0, 90, 80.0), (None, 1, 0, 0, 90, None), ("A", 1, 0, None, 90, 120.0)]), 0)
    detector(crossings([("A", 1, 1, 7200, 90, 80.0)]), 1)
    detector(crossings([("A", 1, 1, 30, 90, 120.0)]), 2)
    detector(crossings([("A", 1, 2, 7230, 90, 80.0)]), 3)
    detector(crossings([]), 4)
    assert detector.late == 1 and [r["camera_id_end"] for r in got] == [12]
    assert sorted(detector.open.newest) == [1, 3] and not (tmp_path / "open" / "batch=0").exists()


def test_windows_close_once_and_in_event_time(spark, tmp_path, crossings):
    """A later batch holds the window's first row; nothing leaves before time has passed the window."""
    got = []
    detector = BatchDetector(
        str(tmp_path), lambda found, batch: got.append((batch, [r["speed_reading"] for r in found.collect()])),
        strategy=detect.ADJACENT, close_windows="10 minutes",
    )
    detector(crossings([("A", 1, 0, 300, 90, 120.0)]), 0)
    detector(crossings([("A", 1, 0, 100, 90, 130.0), ("B", 1, 0, 700, 90, 140.0)]), 1)
    detector(crossings([("~", 1, 0, 1800, 90, 1.0)]), 2)
    detector(crossings([("~", 1, 0, 1801, 90, 1.0)]), 3)
    detector(crossings([("~", 1, 0, 9000, 90, 1.0)]), 4)
    assert [g for g in got if g[1]] == [(2, [130.0]), (4, [140.0])]


def test_progress_counts_rows_once(spark, tmp_path, crossings):
    log = jobs.ProgressLog()
    spark.streams.addListener(log)
    try:
        queries = replay(
            spark, [landing(crossings, SNEAKY), landing(crossings, FAST)],
            lambda events: jobs.append_table(
                detect.detect_instantaneous(events), str(tmp_path / "out"), str(tmp_path / "checkpoint"), once=True
            ),
        )
        for query in queries * 2:
            log.poll(query)
    finally:
        spark.streams.removeListener(log)
    found = log.table(spark).where("input_rows > 0").orderBy("batch_id").collect()
    assert [(r["input_rows"], r["total_rows"]) for r in found] == [(3, 3), (2, 5)]


def test_landings_cover_the_time_span(spark, crossings):
    rows = crossings([("A", 1, 0, 3600 * s, 90, 80.0) for s in range(100)])
    parts = streams._periods(rows.withColumn("event_id", F.lit(1)), closing=True, days=2)
    assert [p.count() for p in parts] == [40, 48, 13]


def test_window_must_divide_the_hour(spark, crossings):
    for width in ("7 minutes", "90 minutes", "30 seconds"):
        with pytest.raises(ValueError):
            jobs.ledger_stream(detect.all_violations(crossings(SNEAKY)), width)


def test_large_landings_are_dealt_to_many_files(spark, monkeypatch, crossings):
    """One file is written and decoded by one task; small landings stay as they are."""
    rows = crossings([("A", 1, i % 3, i, 90, 80.0) for i in range(90)]).withColumn("event_id", F.expr("uuid()")).coalesce(1)
    assert streams._dealt(rows) is rows
    monkeypatch.setattr(streams, "FILE_EVENTS", 20)
    dealt = streams._dealt(rows)
    assert dealt.rdd.getNumPartitions() == 5 and dealt.count() == 90
    assert sorted(map(tuple, dealt.drop("event_id").collect())) == sorted(map(tuple, rows.drop("event_id").collect()))


def test_landings_of_many_rows_are_cut_in_time_order(spark, crossings):
    hours = [0, 0, 1, 1, 1, 2, 30, 400, 400, 401]
    rows = [(f"A{i}", 1, 0, hour * 3600 + i, 90, 50.0) for i, hour in enumerate(hours)]
    given = crossings([*rows, ("N", 1, 0, None, 90, 50.0)])
    landed = [sorted(r["car_plate"] for r in x.collect()) for x in streams._bounded_periods(given, closing=True, most=4)]
    # Hours stay whole, the period of 16 days is a border too, the closing crossing comes last.
    assert landed == [["A0", "A1"], ["A2", "A3", "A4", "A5"], ["A6"], ["A7", "A8", "A9", "~"]]
    whole = [sorted(r["car_plate"] for r in x.collect()) for x in streams._bounded_periods(given, most=10)]
    assert whole == [sorted(r["car_plate"] for r in x.collect()) for x in streams._periods(given)] and len(whole) == 2


def test_late_rows_stay_late_when_landings_are_cut(spark, monkeypatch, crossings):
    rows = [(f"P{i % 3}", 1, i % 3, 3600 * (i // 9) + 37 * (i % 9), 90, 100.0 if i % 4 == 0 else 50.0) for i in range(36)]
    given = crossings(rows)
    monkeypatch.setattr(streams.bed, "crossings", lambda spark, sf: given)
    monkeypatch.setattr(streams._bounded_periods, "__defaults__", (False, streams.PERIOD_DAYS, 10))
    landings = []
    monkeypatch.setattr(streams, "to_wire", lambda x, to_wire=streams.to_wire: landings.append(x.count()) or to_wire(x))
    got = streams.late_rows_dropped(spark, "unused")
    want = dedup.first_per_plate_window(detect.all_violations(given))
    assert sorted(map(tuple, got.select(want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert landings == [9, 9, 9, 10, 36]
