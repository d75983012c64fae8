"""Headline queries, timed. Prints one JSON line.

Every query runs to its end on all rows: batch queries into the no-op sink, the streaming detector
from topic files to the ledger table. ``value`` is the sum of the medians in seconds.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from datetime import datetime

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lanewarden.operators import dedup, detect, ledger, metrics, trips  # noqa: E402
from lanewarden.plans import catalog, streams  # noqa: E402
from lanewarden.plans import testbed as bed  # noqa: E402
from lanewarden.session import build_session, materialize, scratch_path  # noqa: E402
from lanewarden.sources.events import parse_events, to_wire  # noqa: E402
from lanewarden.sources.sinks import read_ledger  # noqa: E402
from lanewarden.streaming import jobs  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def finish(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, runs: int = RUNS) -> float:
    seconds = []
    for _ in range(runs):
        started = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - started)
    return round(statistics.median(seconds), 3)


def landing_latency(spark, crossings, landings: int = 15) -> dict[str, float]:
    """Seconds from the moment a small file has landed to the end of the batch that stored its violation."""
    offence = materialize(crossings.where("speed_reading > speed_limit").orderBy("event_id").limit(1), "bench-offence")
    topic, path = scratch_path(spark, "bench-live"), scratch_path(spark, "bench-live-ledger")
    landed: dict[str, float] = {}

    def land(plate: str) -> None:
        to_wire(offence.withColumn("car_plate", F.lit(plate))).write.mode("append").parquet(topic)
        landed[plate] = time.time()

    land("warm-up")
    events = parse_events(spark.readStream.schema("key string, value binary").parquet(topic))
    query = jobs.start_detector(events, path, scratch_path(spark, "bench-live-checkpoint"))
    query.processAllAvailable()
    for i in range(landings):
        land(f"L{i}")
        time.sleep(1.0)
    query.processAllAvailable()
    query.stop()
    begun = [(datetime.fromisoformat(p["timestamp"]).timestamp(), p["durationMs"]["triggerExecution"] / 1000) for p in query.recentProgress]
    waits = []
    for row in read_ledger(spark, path).where("car_plate like 'L%'").select("car_plate", F.unix_millis("detected_at").alias("ms")).collect():
        start, took = max(b for b in begun if b[0] <= row["ms"] / 1000)
        waits.append(start + took - landed[row["car_plate"]])
    waits.sort()
    return {name: round(waits[min(len(waits) - 1, int(q * len(waits)))], 3) for name, q in (("p50", 0.5), ("p95", 0.95))}


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=CPUS,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    # The stored inputs a deployment has: parsed crossings, the ledger, and the topic.
    crossings = materialize(bed.crossings(spark, SF_DIR).repartition(int(CPUS)), "bench-crossings")
    stored = materialize(bed.ledger(spark, SF_DIR), "bench-ledger")
    n_events = crossings.count()
    finish(dedup.first_per_plate_window(detect.all_violations(crossings)))

    cameras, lanes, cars = bed.cameras(spark), bed.lanes(spark), bed.cars(spark, SF_DIR)
    batch = {
        "w6_expand_trips": lambda: bed.crossings(spark, SF_DIR),
        "p1_detect_instantaneous": lambda: detect.detect_instantaneous(crossings),
        "j1_detect_average_adjacent": lambda: detect.detect_average(crossings, detect.ADJACENT),
        "j2_detect_average_all_pairs": lambda: detect.detect_average(crossings, detect.ALL_PAIRS),
        "u1_all_violations": lambda: detect.all_violations(crossings),
        "u4_build_violations": lambda: detect.build_violations(crossings),
        "w5_first_per_plate_window": lambda: dedup.first_per_plate_window(detect.all_violations(crossings)),
        "j12_compare_strategies": lambda: detect.compare_strategies(crossings),
        "a5_trip_summary": lambda: trips.trip_summary(trips.consecutive_segments(crossings, ["trip_id"]), ["trip_id"]),
        "a5_summary_by_gap": lambda: trips.trip_summary(
            trips.consecutive_segments(trips.assign_trips(crossings)), ["car_plate", "lane_id", "trip_start"]
        ),
        "j5_lanes_summary": lambda: ledger.lanes_summary(lanes, cameras, stored),
        "j7_car_with_violations": lambda: ledger.car_with_violations(cars, stored),
        "l1_page_violations": lambda: ledger.page_violations(stored, lane_id=2, skip=100, limit=50),
        "a7_latency_summary": lambda: metrics.latency_summary(stored),
        "a10_latency_histogram": lambda: metrics.latency_histogram(stored),
        "a11_join_cost": lambda: catalog.queries()["a11_join_cost"](spark, SF_DIR),
    }
    seconds = {name: timed(lambda make=make: finish(make())) for name, make in batch.items()}

    topic = scratch_path(spark, "bench-topic")
    to_wire(crossings).unionByName(to_wire(streams._closing(crossings))).write.parquet(topic)

    def stream(emit: str) -> None:
        events = parse_events(spark.readStream.schema("key string, value binary").parquet(topic))
        ledger_path, checkpoint = scratch_path(spark, "bench-ledger"), scratch_path(spark, "bench-checkpoint")
        jobs.start_detector(events, ledger_path, checkpoint, emit=emit, once=True).awaitTermination()

    seconds["t6_detector_to_ledger"] = timed(lambda: stream("window-close"), 2)
    seconds["t6_detector_first_seen"] = timed(lambda: stream("first-seen"), 2)
    latency = landing_latency(spark, crossings)

    rate = {name: round(n_events / seconds[name]) for name in ("w5_first_per_plate_window", "t6_detector_to_ledger")}
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "events": n_events,
                "events_per_second": rate,
                "landing_to_ledger_s": latency,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
