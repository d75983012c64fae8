"""Row patterns and last crossings, in tables and streams, against plain statements of their results."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from conftest import T0
from pyspark.sql import functions as F

from lanewarden.operators import chains, patterns, trips
from lanewarden.operators.patterns import Step
from lanewarden.plans.streams import _rocksdb, replay
from lanewarden.streaming import jobs, stateful

TICK = [("~", 9, 0, 200_000, 90, 1.0)]
FAST, QUIET = "speed_reading > speed_limit", "speed_reading <= speed_limit"
SHAPES = {
    "one": ([(FAST, False)], "f"),
    "burst": ([(FAST, True)], "f+"),
    "pair": ([(FAST, False), (FAST, False)], "ff"),
    "braking": ([(FAST, True), (QUIET, False)], "f+q"),
    "turn": ([(QUIET, True), (FAST, True), (QUIET, True)], "q+f+q+"),
    "any then quiet": ([("speed_reading is not null", True), (QUIET, False)], ".+q"),
}


def history(rng, n, spread):
    rows = []
    for _ in range(n):
        reading = rng.choice([80.0, 80.0, 100.0, 100.0, None])
        rows.append((rng.choice(["A", "A", "A", "B"]), rng.choice([1, 1, 2]), rng.randrange(3), rng.randrange(spread), 90, reading))
    return rows


def plain_matches(rows, shape, within):
    """Leftmost, longest, not overlapping, of rows that are told by their readings."""
    import re

    groups: dict = {}
    for plate, lane, index, at, limit, reading in set(rows):
        groups.setdefault((plate, lane), []).append((at, index, reading))
    found = []
    for (plate, lane), some in groups.items():
        some.sort(key=lambda r: r[:2])
        text = "".join("x" if r is None else "f" if r > 90 else "q" for _, _, r in some)
        at = 0
        while at < len(some):
            ends = [e for e in range(at + 1, len(some) + 1) if some[e - 1][0] <= some[at][0] + within and re.fullmatch(shape.replace(".", "[fq]"), text[at:e])]
            if ends:
                found.append((plate, lane, some[at][0], some[ends[-1] - 1][0], ends[-1] - at))
                at = ends[-1]
            else:
                at += 1
    return sorted(found)


def seconds(rows):
    return sorted((r["car_plate"], r["lane_id"], int((r["match_start"] - T0).total_seconds()), int((r["match_end"] - T0).total_seconds()), r["n_rows"]) for r in rows)


def unique_moments(rows):
    """One row for each vehicle, time and camera, so that a plain order is the order."""
    return list({(r[0], r[1], r[2], r[3]): r for r in rows}.values())


@pytest.mark.parametrize("name", SHAPES)
def test_matches_equal_a_plain_statement(spark, crossings, name):
    steps, shape = SHAPES[name]
    rows = unique_moments(history(random.Random(name), 500, 9000))
    rows += rows[:40] + [(None, 1, 0, 5, 90, 100.0), ("A", 1, 0, None, 90, 100.0)]
    found = patterns.match_rows(crossings(rows), [Step(c, r) for c, r in steps], within="1 minute")
    usable = [r for r in rows if r[0] is not None and r[3] is not None]
    want = plain_matches(usable, shape, 60)
    assert want and seconds(found.collect()) == want


def test_long_chains_of_matches(spark, crossings):
    """Every start lies inside an earlier run, so one end decides the next for the whole history."""
    rows = [("A", 1, 0, 20 * i, 90, 100.0) for i in range(700)]
    found = patterns.match_rows(crossings(rows), [Step(FAST), Step(FAST), Step(FAST)], within="1 minute")
    assert seconds(found.collect()) == [("A", 1, 60 * i, 60 * i + 40, 3) for i in range(233)]


def test_pattern_limits(spark, crossings):
    with pytest.raises(ValueError, match="steps"):
        patterns.match_rows(crossings([]), [])
    assert patterns.match_rows(crossings([]), [Step(FAST)]).count() == 0


def test_conditions_on_the_crossing_before(spark, crossings):
    sneaky = [("S", 1, i, 30 * i, 90, 80.0) for i in range(3)] + [("S", 1, 0, 5000, 90, 80.0), ("S", 1, 1, 5100, 90, 80.0)]
    rushed = f"{QUIET} and prev_segment_speed > speed_limit"
    found = patterns.match_rows(crossings(sneaky), [Step(QUIET), Step(rushed, repeat=True)])
    assert seconds(found.collect()) == [("S", 1, 0, 60, 3)]


def streamed(spark, tmp_path, landings, transform):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    with _rocksdb(spark):
        runs = replay(spark, landings, lambda events: jobs.append_table(transform(events), out, checkpoint, once=True))
    return spark.read.parquet(out), runs


def landings_of(crossings, rows, rng, cut):
    """Rows before and after ``cut`` seconds, each landing in any order, then the tick."""
    parts = [[r for r in rows if r[3] < cut], [r for r in rows if r[3] >= cut], TICK]
    for part in parts:
        rng.shuffle(part)
    return [crossings(part).withColumn("event_id", F.lit("e")).repartition(3) for part in parts]


def test_stream_matches_equal_the_table(spark, tmp_path, crossings):
    rng = random.Random(5)
    rows = unique_moments(history(rng, 400, 9000))
    rows += rows[:30]
    steps = [Step(FAST, True), Step(QUIET)]
    found, _ = streamed(
        spark, tmp_path, landings_of(crossings, rows, rng, 4500), lambda events: stateful.pattern_stream(events, steps, within="1 minute", buckets=3)
    )
    want = plain_matches(rows, "f+q", 60)
    assert want and seconds(found.collect()) == want
    assert seconds(patterns.match_rows(crossings(rows), steps, within="1 minute").collect()) == want


def test_last_crossing_stream_equals_the_table(spark, tmp_path, crossings):
    rng = random.Random(6)
    rows = [(f"P{rng.randrange(12)}", rng.choice([1, 2]), i, rng.randrange(20_000), 90, 80.0) for i in [0, 1, 2] * 150]
    rows = unique_moments(rows) + [("HOT", 1, i % 3, 13 * i, 90, 80.0) for i in range(600)]
    found, runs = streamed(
        spark, tmp_path, landings_of(crossings, list(rows), rng, 9000), lambda events: stateful.last_crossing_stream(events, buckets=4)
    )
    columns = ["car_plate", "lane_id", "camera_id_start", "camera_id_end", "timestamp_start", "timestamp_end", "speed_limit", "avg_speed", "violation_type"]
    want = trips.detect_average_last_crossing(crossings(rows))
    assert want.count() > 300
    assert sorted(tuple(r) for r in found.select(columns).collect()) == sorted(tuple(r) for r in want.select(columns).collect())
    # A watermark later, only the closing crossing is held.
    last = [s for s in runs[-1].lastProgress.stateOperators]
    assert sum(s.numRowsTotal for s in last) <= 8


def test_last_crossing_of_the_past_meets_later_landings(spark, tmp_path, crossings):
    """Pairs across landings; a missed camera leaves no gap; a gap over the window makes no pair."""
    early = [("V", 1, 0, 0, 90, 80.0), ("W", 1, 0, 0, 90, 80.0)]
    late = [("V", 1, 2, 60, 90, 80.0), ("W", 1, 1, 700, 90, 80.0)]
    frames = [crossings(part).withColumn("event_id", F.lit("e")) for part in (early, late, TICK)]
    found, _ = streamed(spark, tmp_path, frames, stateful.last_crossing_stream)
    row, = found.collect()
    assert (row["car_plate"], row["camera_id_end"], row["avg_speed"], row["timestamp_end"]) == ("V", 12, 120.0, T0 + dt.timedelta(seconds=60))


def test_follow_links(spark):
    nodes = [("k", i, i % 100 == 0, i + 3 if i + 3 < 500 else None) for i in range(500)]
    found = chains.follow(spark.createDataFrame(nodes, "g string, at long, _sure boolean, _next long"), ["g"], "at")
    want = {i for s in range(0, 500, 100) for i in range(s, 500, 3)}
    assert {r["at"] for r in found.collect()} == want


def test_runs_end_with_their_histories():
    """Runs are as long as their steps allow, whatever lies within the reach; those cut by the end are alive."""
    automaton = patterns.Automaton.of([Step(FAST), Step(FAST, True), Step(QUIET)])
    flags = np.array([3, 3, 3, 4, 3, 4, 3, 3, 3, 3, 3, 4])
    group = np.array([0] * 8 + [1] * 4)
    starts, last, alive = patterns.longest_runs(np.arange(12), flags, patterns.group_ends(group), 100, automaton)
    assert starts.tolist() == [0, 1, 2, 4, 6, 7, 8, 9, 10] and last.tolist() == [3, 3, -1, -1, -1, -1, 11, 11, -1]
    assert alive.tolist() == [False] * 4 + [True] * 2 + [True, True, False]


def test_dense_histories_are_matched_without_lists_of_a_window(spark, crossings):
    """A window that holds thousands of crossings: no row gathers those within its reach."""
    rng = random.Random(11)
    rows = unique_moments([("A", 1, rng.randrange(3), rng.randrange(1800), 90, rng.choice([80.0, 100.0])) for _ in range(6000)])
    found = patterns.match_rows(crossings(rows), [Step(FAST), Step(FAST, True), Step(QUIET)])
    assert seconds(found.collect()) == plain_matches(rows, "ff+q", 600)


def test_state_of_many_rows_is_few_values():
    """One value of state holds many rows, and gives them back as they were."""
    import pandas as pd

    table = pd.DataFrame({"car_plate": [f"P{i % 7}" for i in range(250_000)], "at_us": range(250_000), "judged": [i % 2 == 0 for i in range(250_000)]})
    packed = stateful._packed(table)
    assert len(packed) == 3
    pd.testing.assert_frame_equal(stateful._unpacked(iter(packed)), table)
    assert stateful._packed(table[:0]) == [] and stateful._unpacked(iter([])) is None
