"""Detectors on small fixtures whose right answer is known, and against brute force."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from conftest import T0

from lanewarden.operators import detect

NINE = [
    *[("NRM 1", 1, i, 50 * i, 90, r) for i, r in enumerate((80.0, 82.0, 79.0))],
    *[("SPD 1", 1, i, 25 * i, 90, r) for i, r in enumerate((130.0, 132.0, 128.0))],
    *[("SNK 1", 1, i, 30 * i, 90, r) for i, r in enumerate((80.0, 82.0, 79.0))],
]


def plates(df):
    return sorted(r["car_plate"] for r in df.collect())


def test_nine_rows(crossings):
    events = crossings(NINE)
    assert plates(detect.detect_instantaneous(events)) == ["SPD 1"] * 3
    assert plates(detect.detect_average(events, "adjacent")) == ["SNK 1"] * 2 + ["SPD 1"] * 2
    assert plates(detect.detect_average(events, "all-pairs")) == ["SNK 1"] * 3 + ["SPD 1"] * 3
    for strategy in ("adjacent", "all-pairs"):
        assert plates(detect.build_violations(events, strategy)) == ["SNK 1", "SPD 1"]
    assert {r["avg_speed"] for r in detect.detect_average(events).where("car_plate = 'SNK 1'").collect()} == {120.0}
    assert detect.compare_strategies(events).count() == 0
    assert detect.same_plates(
        detect.build_violations(events, "adjacent"), detect.build_violations(events, "all-pairs")
    ).first().asDict() == {"n_different": 0, "same_plates": True}


def test_unified_shape(crossings):
    events = crossings(NINE)
    spot, average = detect.detect_instantaneous(events), detect.detect_average(events)
    assert spot.columns == average.columns == detect.VIOLATION_COLUMNS
    assert [t for _, t in spot.dtypes] == [t for _, t in average.dtypes]
    assert all(r["avg_speed"] is None and r["camera_id_start"] == r["camera_id_end"] for r in spot.collect())
    assert all(r["speed_reading"] is None for r in average.collect())


def test_unknown_strategy(crossings):
    with pytest.raises(ValueError, match="adjacent.*all-pairs"):
        detect.detect_average(crossings(NINE), "nearest")


@pytest.mark.parametrize(
    ("rows", "adjacent", "all_pairs"),
    [
        # limits 110/110/90: each segment legal, the whole over the last limit
        ([("A", 1, 0, 0, 110, 80.0), ("A", 1, 1, 35, 110, 80.0), ("A", 1, 2, 77, 90, 80.0)], 0, 1),
        # average exactly at the limit
        ([("A", 1, 0, 0, 90, 90.0), ("A", 1, 1, 40, 90, 90.0)], 0, 0),
        # the second camera at exactly ten minutes, then a millisecond later
        ([("A", 1, 0, 0, 5, 1.0), ("A", 1, 1, 600, 5, 1.0)], 1, 1),
        ([("A", 1, 0, 0, 5, 1.0), ("A", 1, 1, 600.001, 5, 1.0)], 0, 0),
        # a fifth of a second across a full second counts as one second
        ([("A", 1, 0, 0.9, 90, 80.0), ("A", 1, 1, 1.1, 90, 80.0)], 1, 1),
        # the same second
        ([("A", 1, 0, 0.1, 90, 80.0), ("A", 1, 1, 0.9, 90, 80.0)], 0, 0),
        # reverse travel: the camera reached second sets the limit
        ([("A", 1, 2, 0, 90, 80.0), ("A", 1, 1, 30, 90, 80.0), ("A", 1, 0, 60, 150, 80.0)], 1, 1),
        # the middle camera missed
        ([("A", 1, 0, 0, 90, 80.0), ("A", 1, 2, 60, 90, 80.0)], 0, 1),
        # another lane, another plate
        ([("A", 1, 0, 0, 90, 80.0), ("A", 2, 1, 20, 90, 80.0)], 0, 0),
        ([("A", 1, 0, 0, 90, 80.0), ("B", 1, 1, 20, 90, 80.0)], 0, 0),
        # a pair across the border of two time slices
        ([("A", 1, 0, 3590, 90, 80.0), ("A", 1, 1, 3610, 90, 80.0)], 1, 1),
        # crossings without a time
        ([("A", 1, 0, None, 90, 80.0), ("A", 1, 1, 20, 90, 80.0)], 0, 0),
    ],
)
def test_pairs(crossings, rows, adjacent, all_pairs):
    events = crossings(rows)
    assert detect.detect_average(events, "adjacent").count() == adjacent
    assert detect.detect_average(events, "all-pairs").count() == all_pairs


def test_limit_and_missing_values(crossings):
    events = crossings([("A", 1, 0, 0, 90, 90.0), ("A", 1, 0, 5, 90, None), ("A", 1, 0, None, 90, 120.0)])
    assert detect.detect_instantaneous(events).count() == 0


@pytest.mark.parametrize("k", [3, 5, 10, 15])
def test_join_cost_model(crossings, k):
    events = crossings([(f"CAR {v:05d}", 1, i, 30 * i, 90, 80.0) for v in range(20) for i in range(k)])
    assert detect.detect_average(events, "adjacent").count() == 20 * (k - 1)
    assert detect.detect_average(events, "all-pairs").count() == 20 * k * (k - 1) // 2


def brute_force(rows, strategy):
    found = Counter()
    for pa, la, ia, ta, _, _ in rows:
        for pb, lb, ib, tb, limit, _ in rows:
            near = abs(ib - ia) == 1 if strategy == "adjacent" else ia != ib
            if (pa, la) != (pb, lb) or not near or not 0 < tb - ta <= 600:
                continue
            dt_s = int(tb) - int(ta)
            if dt_s > 0 and abs(ib - ia) * 3600.0 / dt_s > limit:
                found[(pa, la, ia, ib, ta, tb)] += 1
    return found


@pytest.mark.parametrize("strategy", ["adjacent", "all-pairs"])
@pytest.mark.parametrize("options", [{}, {"slice_width": "10 minutes"}, {"slice_width": "1 minute"}, {"hot_plates": ["HOT"], "hot_splits": 5}])
def test_against_brute_force(crossings, strategy, options):
    """One plate holds half of the rows; slices, salting and their widths change nothing."""
    draw = random.Random(7)
    rows = [
        ("HOT" if draw.random() < 0.5 else f"C{draw.randrange(4)}", draw.randrange(1, 3), draw.randrange(4),
         draw.randrange(0, 40_000) / 4, draw.choice((20, 60, 90)), 50.0)
        for _ in range(400)
    ]
    found = Counter(
        (r["car_plate"], r["lane_id"], int(r["position_start_km"]) - 1, int(r["position_end_km"]) - 1,
         (r["timestamp_start"] - T0) / dt.timedelta(seconds=1), (r["timestamp_end"] - T0) / dt.timedelta(seconds=1))
        for r in detect.detect_average(crossings(rows), strategy, **options).collect()
    )
    assert found == brute_force(rows, strategy) and found


def test_frequent_plates(crossings):
    rows = [("HOT", 1, i % 3, i, 90, 80.0) for i in range(300)] + [(f"P{i}", 1, 0, i, 90, 80.0) for i in range(600)]
    assert detect.frequent_plates(crossings(rows), 0.1) == ["HOT"]


def test_join_plan_has_time_slices(crossings):
    plan = detect.detect_average(crossings(NINE))._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan and "Join Inner" in plan


def hot_history(rng):
    rows = [("HOT", 1, rng.randrange(3), rng.randrange(7200), 90, 80.0) for _ in range(1500)]
    return rows + [(f"P{rng.randrange(60)}", rng.randrange(3), rng.randrange(3), rng.randrange(7200), 90, 80.0) for _ in range(3000)]


@pytest.mark.parametrize("strategy", ["adjacent", "all-pairs"])
def test_hot_slices_are_found_and_split(spark, crossings, strategy):
    """The same rows as without a split, and no join key that holds much more than the bound."""
    events = crossings(hot_history(random.Random(9)))
    whole = detect.detect_average(events, strategy, split_hot=False)
    split = detect.detect_average(events, strategy, hot_cell_rows=60)
    assert Counter(map(tuple, split.collect())) == Counter(map(tuple, whole.collect()))
    cells = detect.hot_cells(events, 3600, 100, 60)
    assert cells.count() == 2 and detect.hot_cells(events, 3600, 100, 10_000).count() == 0
    _, second, keys = detect.join_sides(events, hot_cell_rows=60)
    largest = max(r["count"] for r in second.groupBy(*keys).count().collect())
    _, second, keys = detect.join_sides(events, split_hot=False)
    assert max(r["count"] for r in second.groupBy(*keys).count().collect()) > 600 and largest < 60


def test_hot_cells_are_few_and_take_salts(spark, crossings):
    events = crossings([("HOT", 1, i % 3, i % 300, 90, 80.0) for i in range(4000)] + [(None, 1, 0, 5, 90, 80.0), ("A", 1, 0, None, 90, 80.0)])
    cell, = detect.hot_cells(events, 3600, 100, 50).collect()
    assert cell["_salts"] == 3
    first, second, keys = detect.join_sides(events, hot_cell_rows=50)
    assert second.select(*keys).distinct().count() > 3 and first.where("_salt = 2").count() > 0
    assert "BroadcastHashJoin" in second._jdf.queryExecution().toString()


@pytest.mark.parametrize("strategy, reach", [("adjacent", 42), ("all-pairs", 82)])
def test_hot_slices_are_cut_by_what_a_segment_can_reach(spark, crossings, strategy, reach):
    """Crossings meet little beyond the reach of the lane's longest segment, not a window of ten minutes."""
    events = crossings([("HOT", 1, i % 3, i // 5, 90, 80.0) for i in range(6000)])
    assert detect.lane_reach(events, events, strategy, 600).collect() == [(1, reach)]
    first, second, keys = detect.join_sides(events, hot_cell_rows=40, strategy=strategy)
    met = first.groupBy(*keys).count().withColumnRenamed("count", "n").join(second.groupBy(*keys).count(), keys)
    assert met.selectExpr("sum(n * count)").first()[0] < 6000 * 5 * 1.7 * reach
    whole = detect.detect_average(events, strategy, split_hot=False)
    assert Counter(map(tuple, detect.detect_average(events, strategy, hot_cell_rows=40).collect())) == Counter(map(tuple, whole.collect()))


def test_salts_follow_the_share_of_a_cell(spark, crossings):
    """Many hot cells keep all tasks busy as they are; salts would copy their rows for nothing."""
    events = crossings([(f"P{i % 50}", 1, i % 3, i % 300, 90, 80.0) for i in range(10_000)])
    assert {r["_salts"] for r in detect.hot_cells(events, 3600, 100, 1).collect()} == {1}


@pytest.mark.parametrize("strategy", ["adjacent", "all-pairs"])
def test_odd_limits_and_positions_bound_nothing(spark, crossings, strategy):
    nan = float("nan")
    odd = [(1, 0, 90.0, 1.0), (1, 1, 0.0, 2.0), (2, 0, 90.0, nan), (2, 1, 90.0, 2.0), (3, 0, 90.0, 1.0), (4, 0, 90.0, None), (4, 1, None, 2.0)]
    events = crossings([("H", lane, index, 10 * k, nan if limit is None else limit, 80.0, nan if km is None else km) for lane, index, limit, km in odd for k in range(60)])
    assert dict(map(tuple, detect.lane_reach(events, events, "adjacent", 600).collect())) == {1: 600, 2: 600, 3: 0, 4: 600}
    whole = detect.detect_average(events, strategy, split_hot=False)
    split = detect.detect_average(events, strategy, hot_cell_rows=20)
    plain = lambda df: Counter(map(repr, df.collect()))  # noqa: E731  (a NaN differs from itself)
    assert whole.count() and plain(split) == plain(whole)
