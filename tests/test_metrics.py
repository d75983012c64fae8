from __future__ import annotations

import datetime as dt
import random
import statistics

import pytest
from conftest import T0
from pyspark.sql import functions as F

from lanewarden.functions.ordering import floor_rank, global_ordinal, nearest_rank, values_at_ranks
from lanewarden.functions.scalars import latency_cap
from lanewarden.operators import metrics


@pytest.mark.parametrize("spread", [10, 100_000, 10**13])
def test_ranks_match_a_sort(spark, spread):
    draw = random.Random(spread)
    values = [draw.randrange(-spread, spread) for _ in range(700)] + [spread // 2] * 400
    df = spark.createDataFrame([(v,) for v in values], "v long")
    quantiles = (0.0, 0.01, 0.5, 0.95, 0.99, 1.0)
    ordered, n = sorted(values), len(values)
    found = values_at_ranks(df, "v", {f"q{i}": nearest_rank(q) for i, q in enumerate(quantiles)}).first()
    assert list(found) == [ordered[min(n - 1, round(q * (n - 1)))] for q in quantiles]
    found = values_at_ranks(df, "v", {f"q{i}": floor_rank(q) for i, q in enumerate(quantiles)}).first()
    assert list(found) == [ordered[min(n - 1, int(q * n))] for q in quantiles]


def test_ranks_of_nothing(spark):
    assert values_at_ranks(spark.createDataFrame([], "v long"), "v", {"p": nearest_rank(0.5)}).first()["p"] is None


def test_global_ordinal(spark):
    rows = [(i * 7919 % 1000, i) for i in range(1000)] + [(5, 1000 + i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(7)
    found = {r["b"]: r["ordinal"] for r in global_ordinal(df, F.col("a").desc(), F.col("b").asc()).collect()}
    assert found == {b: i for i, (_, b) in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}


@pytest.fixture
def ledger(spark):
    delays = [0.5, 0.614, 1.242, 1.242, 2.114, -3.0, 661.0]
    rows = [
        (f"P{i}", "AVERAGE" if i % 2 else "INSTANTANEOUS", T0, T0 + dt.timedelta(seconds=d), T0) for i, d in enumerate(delays)
    ]
    return spark.createDataFrame(
        rows, "car_plate string, violation_type string, timestamp_end timestamp, detected_at timestamp, window_start timestamp"
    )


def test_latency(ledger):
    summary = metrics.latency_summary(ledger).first()
    plausible = [0.5, 0.614, 1.242, 1.242, 2.114]
    assert (summary["n"], summary["min_s"], summary["max_s"]) == (5, 0.5, 2.114)
    assert (summary["p50_s"], summary["p95_s"], summary["p99_s"]) == (1.242, 2.114, 2.114)
    assert summary["mean_s"] == pytest.approx(statistics.mean(plausible))
    assert metrics.latency_median(ledger).first()["median_s"] == 1.242
    assert metrics.latency_median(ledger.where("car_plate < 'P4'")).first()["median_s"] == (0.614 + 1.242) / 2
    assert metrics.latency_percentiles_floor(ledger).first()["p95_s"] == 661.0
    assert latency_cap(20.0) == 660.0 and latency_cap(100.0) == 700.0


def test_histogram(ledger):
    bins = metrics.latency_histogram(ledger, 4).orderBy("bin").collect()
    assert [r["n"] for r in bins] == [2, 2, 0, 1]
    assert bins[0]["from_s"] == 0.5
    one_value = metrics.latency_histogram(ledger.where("car_plate = 'P0'"), 30).where("n > 0").collect()
    assert [(r["bin"], r["n"]) for r in one_value] == [(15, 1)]
    assert metrics.latency_histogram(ledger.where("false"), 30).count() == 0


def test_rates(ledger):
    start = F.lit(T0)
    run = metrics.throughput(ledger, start, 6610).first()
    assert (run["violations"], run["instant"], run["average"], run["drain_s"], run["events_per_s"]) == (6, 4, 2, 661.0, 10.0)
    nothing = metrics.throughput(ledger, F.lit(T0 + dt.timedelta(days=1)), 10).first()
    assert nothing["violations"] == 0 and nothing["events_per_s"] is None
    rates = metrics.run_rates(ledger, 664).first()
    assert (rates["window_s"], rates["events_per_s"]) == (664.0, 1.0)
    assert metrics.run_rates(ledger.where("car_plate = 'P0'"), 1).first()["window_s"] == 1e-9


def test_batch_report(spark, ledger):
    batch = ledger.unionByName(ledger.where("car_plate = 'P1'"))
    report = metrics.batch_report(batch, ledger.where("car_plate = 'P0'")).first().asDict()
    assert report == {"violations": 8, "instant": 4, "average": 4, "new": 6, "duplicate": 2}


def test_latest_per_key(spark):
    rows = spark.createDataFrame([(3, "a", 1), (3, "a", 2), (5, "a", 1)], "k int, strategy string, ran_at int")
    assert sorted(tuple(r) for r in metrics.latest_per_key(rows, ["k", "strategy"], ["ran_at"]).collect()) == [(3, "a", 2), (5, "a", 1)]
