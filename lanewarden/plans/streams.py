"""Registered queries: streaming jobs over crossings that land as files, slice by slice.

A replay lands the crossings of one period, runs the job on all that is new, stops it, lands the
next period and resumes on the same checkpoint. A last crossing far in the future moves the
watermark past the data, so that every window closes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager
from itertools import chain

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lanewarden.operators import dedup, detect
from lanewarden.operators.detect import VIOLATION_COLUMNS
from lanewarden.plans import testbed as bed
from lanewarden.plans.detection import BRAKING, BRAKING_SQL
from lanewarden.plans.registry import ORACLE, query
from lanewarden.plans.views_sql import with_views
from lanewarden.schemas import CAMERA, VIOLATION
from lanewarden.session import delete_path, scratch_path
from lanewarden.settings import VEHICLE_TTL_S
from lanewarden.sources.events import read_events, to_wire
from lanewarden.sources.sinks import read_ledger
from lanewarden.streaming import jobs, stateful

# The middle of the driver tables' month, where some scenarios change.
_CUT = "2024-01-16"
# The span of one landing.
PERIOD_DAYS = 16
# A topic file holds about so many events, so that large landings are written and decoded by many tasks.
FILE_EVENTS = 200_000
# A landing cut by rows has about so many crossings, so that the state of a stateful join stays as small.
LANDING_ROWS = 5_000_000
_HOUR_US = 3_600_000_000
_TOPIC = "key string, value binary"
_UNIFIED = ", ".join(VIOLATION_COLUMNS)
_STORED = f"SELECT {_UNIFIED}, window_start, CAST(CAST(timestamp_start AS DATE) AS VARCHAR) AS date FROM first_rows"


def _periods(crossings: DataFrame, closing: bool = False, days: int = PERIOD_DAYS) -> list[DataFrame]:
    """The crossings in time order, one landing for each ``days`` days that the table covers.

    A landing is one micro-batch, whose rows enter the state before the watermark moves. With
    ``closing``, the last landing has the closing crossing.
    """
    day = 86_400_000_000
    at = F.unix_micros("event_time")
    low, high = crossings.agg(F.min(at), F.max(at)).first()
    starts = range(low - low % day, high + 1, days * day)
    landings = [crossings.where((at >= start) & (at < start + days * day)) for start in starts]
    if closing:
        landings[-1] = landings[-1].unionByName(_closing(crossings), allowMissingColumns=True)
    return landings


def _bounded_periods(
    crossings: DataFrame, closing: bool = False, days: int = PERIOD_DAYS, most: int = LANDING_ROWS
) -> Iterator[DataFrame]:
    """The landings of :func:`_periods`, those of over ``most`` crossings cut at full hours into several.

    The rows that enter the state before the watermark moves are then those of a few landings, however large the
    table. The crossings are stored once by landing, so that each is read alone, and deleted when the next one is due.
    """
    spark, at = crossings.sparkSession, F.unix_micros("event_time")
    hour = F.floor(at / _HOUR_US)
    counts = crossings.where(at.isNotNull()).groupBy(hour.alias("hour")).agg(F.count(F.lit(1)).alias("n")).orderBy("hour").collect()
    if sum(row["n"] for row in counts) <= most:
        yield from _periods(crossings, closing, days)
        return
    first_day = counts[0]["hour"] // 24
    starts, period, held = [], None, 0
    for row in counts:
        its = (row["hour"] // 24 - first_day) // days
        if its != period or held + row["n"] > most:
            starts.append(row["hour"])
            period, held = its, 0
        held += row["n"]
    bounds = F.array(*[F.lit(x).cast("long") for x in starts])
    path = scratch_path(spark, "landings")
    landing = F.size(F.filter(bounds, lambda x: x <= hour)) - 1
    crossings.where(at.isNotNull()).withColumn("landing", landing).write.partitionBy("landing").parquet(path)
    for i in range(len(starts)):
        stored = spark.read.schema(crossings.schema).parquet(f"{path}/landing={i}")
        last = i == len(starts) - 1
        yield stored.unionByName(_closing(crossings), allowMissingColumns=True) if closing and last else stored
        delete_path(spark, f"{path}/landing={i}")


def _closing(crossings: DataFrame) -> DataFrame:
    """One legal crossing, a day after all others."""
    last = crossings.agg(F.max("event_time").alias("t"))
    return last.select(
        F.lit(-1).cast("long").alias("event_id"), F.lit("~").alias("car_plate"), F.lit(0).alias("lane_id"),
        F.lit(0).alias("camera_id"), F.lit(0).alias("camera_index"), F.lit(0.0).alias("position_km"),
        F.lit(1.0).alias("speed_limit"), F.lit(0.0).alias("speed_reading"),
        F.timestamp_micros(F.unix_micros("t") + 86_400_000_000).alias("event_time"),
    )


def _dealt(crossings: DataFrame) -> DataFrame:
    """The crossings of a landing in as many partitions as it has files; a small one stays as it is."""
    files = -(-crossings.count() // FILE_EVENTS)
    return crossings if files < 2 else crossings.repartition(files, "event_id", "event_time")


def replay(
    spark: SparkSession, landings: Iterable[DataFrame], start: Callable[[DataFrame], StreamingQuery]
) -> list[StreamingQuery]:
    """Land each frame of crossings in a topic folder and run ``start`` on it to its end, in turn."""
    topic, runs = scratch_path(spark, "topic"), []
    for crossings in landings:
        to_wire(_dealt(crossings)).write.mode("append").parquet(topic)
        runs.append(start(read_events(spark, {"path": topic}, source="parquet", schema=_TOPIC)))
        runs[-1].awaitTermination()
    return runs


def _replayed_table(spark, sf, transform: Callable[[DataFrame], DataFrame], closing: bool = False) -> DataFrame:
    """The table a job appends to over the whole replay."""
    crossings = bed.crossings(spark, sf)
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    replay(spark, _periods(crossings, closing), lambda events: jobs.append_table(transform(events), out, checkpoint, once=True))
    return spark.read.parquet(out)


def _ledger_rows(table: DataFrame) -> DataFrame:
    """The ledger without the time of writing, its day as text."""
    return table.drop("detected_at").withColumn("date", F.col("date").cast("string"))


@contextmanager
def _set_for(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def _rocksdb(spark: SparkSession):
    return _set_for(spark, {"spark.sql.streaming.stateStore.providerClass": stateful.ROCKSDB})


def _snapshots(spark: SparkSession):
    """State is stored whole often, so that a run that resumes does not load what earlier landings added and
    removed again; stores of runs that have ended are let go as often."""
    prefix = "spark.sql.streaming.stateStore."
    return _set_for(spark, {f"{prefix}minDeltasForSnapshot": "1", f"{prefix}maintenanceInterval": "5s"})


@query("s1_read_events", with_views("""
SELECT CAST(event_id AS VARCHAR) AS event_id, car_plate, lane_id, camera_id, camera_index, position_km, speed_limit,
       event_time, speed_reading FROM crossings"""))
def read_topic(spark, sf):
    """The parsed stream itself, as a table."""
    return _replayed_table(spark, sf, lambda events: events.drop("timestamp"))


@query("t1_stream_instantaneous", with_views("SELECT * FROM inst"))
def stream_instantaneous(spark, sf):
    return _replayed_table(spark, sf, detect.detect_instantaneous)


@query("t2_stream_join_adjacent", with_views("SELECT * FROM avg_adj"))
def stream_join(spark, sf):
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    with _snapshots(spark):
        replay(
            spark, _bounded_periods(bed.crossings(spark, sf)),
            lambda events: jobs.append_table(detect.detect_average(events), out, checkpoint, once=True),
        )
    return spark.read.parquet(out)


@query("t2_stream_join_hot", with_views("SELECT * FROM avg_hot"))
def stream_join_hot(spark, sf):
    """A third of the crossings under one plate; each batch finds the hot slices by itself."""
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")

    def write(found: DataFrame, batch: int) -> None:
        found.write.mode("overwrite").parquet(f"{out}/batch={batch}")

    replay(
        spark, _periods(bed.hot_crossings(spark, sf), days=1),
        lambda events: jobs.start_detection(events, write, checkpoint, spots=False, hot_cell_rows=40, once=True),
    )
    return spark.read.schema(VIOLATION).parquet(f"{out}/*")


@query("t10_stream_union", with_views("SELECT * FROM violations"))
def stream_union(spark, sf):
    return _replayed_table(spark, sf, detect.all_violations)


@query("t3_flag_once_live")
def flag_once_live(spark, sf):
    """Which of a plate's repeats pass depends on batch borders, so there is no SQL for it."""
    return _replayed_table(spark, sf, lambda events: jobs.flag_once_live(detect.all_violations(events)))


def _rolling(source: str) -> str:
    """The flags of ``source``, one plate's chain a recursion."""
    return with_views(f"""
SELECT f.car_plate, min(v.violation_type) AS violation_type, f.t AS start_us
FROM (WITH RECURSIVE s AS (SELECT DISTINCT car_plate, epoch_us(timestamp_start) AS t FROM {source}),
  chain AS (SELECT car_plate, min(t) AS t FROM s GROUP BY car_plate
            UNION ALL SELECT c.car_plate, min(s.t) FROM chain c JOIN s ON s.car_plate = c.car_plate AND s.t >= c.t + 600000000
            GROUP BY c.car_plate)
  SELECT * FROM chain) f
JOIN (SELECT car_plate, violation_type, epoch_us(timestamp_start) AS t FROM {source}) v ON v.car_plate = f.car_plate AND v.t = f.t
GROUP BY f.car_plate, f.t""")


@query("t3_rolling_flag", _rolling("violations"))
def rolling_flag(spark, sf):
    return dedup.rolling_flag(bed.violations(spark, sf))


@query("t3_rolling_flag_stream", _rolling("inst"))
def rolling_flag_stream(spark, sf):
    with _rocksdb(spark):
        return _replayed_table(
            spark, sf, lambda events: stateful.rolling_flag_stream(detect.detect_instantaneous(events)), closing=True
        )


@query("x1_last_crossing_stream", ORACLE["x1_detect_average_last_crossing"])
def last_crossing_stream(spark, sf):
    """The rows of the table form; the misread crossings land with the others."""
    crossings = bed.misread_crossings(spark, sf)
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    with _rocksdb(spark):
        replay(
            spark, _periods(crossings, closing=True),
            lambda events: jobs.append_table(stateful.last_crossing_stream(events), out, checkpoint, once=True),
        )
    return spark.read.parquet(out)


@query("x4_row_pattern_stream", BRAKING_SQL)
def row_pattern_stream(spark, sf):
    crossings = bed.crowded_crossings(spark, sf)
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    with _rocksdb(spark):
        replay(
            spark, _periods(crossings, closing=True, days=1),
            lambda events: jobs.append_table(stateful.pattern_stream(events, BRAKING), out, checkpoint, once=True),
        )
    return spark.read.parquet(out)


@query("t4_ledger_stream", with_views(f"SELECT {_UNIFIED}, window_start FROM first_rows"))
def ledger_stream(spark, sf):
    return _replayed_table(spark, sf, lambda events: jobs.ledger_stream(detect.all_violations(events)), closing=True)


@query("t5_late_rows_dropped", with_views(f"SELECT {_UNIFIED}, window_start FROM first_rows"))
def late_rows_dropped(spark, sf):
    """After all windows have closed, the first period lands again under other plates: too late."""
    crossings = bed.crossings(spark, sf)
    late = crossings.where(F.col("event_time") < F.lit(_CUT).cast("timestamp")).withColumn("car_plate", F.concat(F.lit("LATE"), F.col("car_plate")))
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    with _snapshots(spark):
        replay(
            spark,
            chain(_bounded_periods(crossings, closing=True), [late]),
            lambda events: jobs.append_table(jobs.ledger_stream(detect.all_violations(events)), out, checkpoint, once=True),
        )
    return spark.read.parquet(out)


@query("t6_detector_to_ledger", with_views(_STORED))
def detector(spark, sf):
    """The whole job, from topic to ledger table."""
    crossings = bed.crossings(spark, sf)
    ledger, checkpoint = scratch_path(spark, "ledger"), scratch_path(spark, "checkpoint")
    replay(
        spark,
        _periods(crossings, closing=True),
        lambda events: jobs.start_detector(events, ledger, checkpoint, emit="window-close", once=True),
    )
    return _ledger_rows(read_ledger(spark, ledger))


@query("t6_detector_first_seen", with_views("SELECT car_plate, window_start FROM first_rows"))
def detector_first_seen(spark, sf):
    """Stored as detected, without a closing crossing. Landings decide a key's row, so only keys compare."""
    ledger, checkpoint = scratch_path(spark, "ledger"), scratch_path(spark, "checkpoint")
    replay(
        spark,
        _periods(bed.crossings(spark, sf)),
        lambda events: jobs.start_detector(events, ledger, checkpoint, once=True),
    )
    return read_ledger(spark, ledger).select("car_plate", "window_start")


_LANDED = with_views(f"""
SELECT batch_id, input_rows, CAST(sum(input_rows) OVER (ORDER BY batch_id) AS BIGINT) AS total_rows
FROM (SELECT CAST(event_time >= TIMESTAMP '{_CUT}' AS BIGINT) AS batch_id, count(*) AS input_rows FROM crossings GROUP BY ALL)""")


def _progress(spark, sf, log: jobs.ProgressLog, start: Callable[[DataFrame], StreamingQuery]) -> DataFrame:
    """One record per micro-batch with input, from a table; the measured rates are left out."""
    crossings, cut = bed.crossings(spark, sf), F.lit(_CUT).cast("timestamp")
    halves = [crossings.where(F.col("event_time") < cut), crossings.where(F.col("event_time") >= cut)]
    path = scratch_path(spark, "progress")
    for run in replay(spark, halves, start):
        log.poll(run)
        log.flush(spark, path)
    return spark.read.schema(jobs.PROGRESS).parquet(path).where("input_rows > 0").select("batch_id", "input_rows", "total_rows")


@query("t7_progress_report", _LANDED)
def progress_report(spark, sf):
    out, checkpoint = scratch_path(spark, "out"), scratch_path(spark, "checkpoint")
    return _progress(
        spark, sf, jobs.ProgressLog(),
        lambda events: jobs.append_table(detect.detect_instantaneous(events), out, checkpoint, once=True),
    )


@query("t7_detector_progress", f"SELECT input_rows, total_rows FROM ({_LANDED})")
def detector_progress(spark, sf):
    """The detector reads its events once, so its report counts them as they are."""
    ledger, checkpoint = scratch_path(spark, "ledger"), scratch_path(spark, "checkpoint")
    log = jobs.ProgressLog()
    records = _progress(spark, sf, log, lambda events: jobs.start_detector(events, ledger, checkpoint, once=True))
    return records.select("input_rows", "total_rows")


# Each landing is one batch; its watermark is its newest crossing less ten minutes, and the last one ends with
# the closing crossing a day later.
_LIVE_UPDATES = with_views(f"""
SELECT car_plate, u.status, lane_id, camera_id, position_km, speed_reading, speed_reading > speed_limit AS over, seen_us
FROM (SELECT *, lead(landing) OVER (PARTITION BY car_plate ORDER BY landing) AS next_landing
      FROM (SELECT *, row_number() OVER (PARTITION BY car_plate, landing ORDER BY seen_us DESC, camera_id DESC, lane_id DESC) AS rn,
                   max(seen_us) OVER (PARTITION BY landing) // 1000 * 1000 - 600000000 AS passed_us
            FROM (SELECT *, epoch_us(event_time) AS seen_us,
                         date_diff('day', CAST(min(event_time) OVER () AS DATE), CAST(event_time AS DATE)) // {PERIOD_DAYS} AS landing
                  FROM crossings))
      WHERE rn = 1),
  (VALUES ('seen'), ('gone')) AS u(status)
WHERE u.status = 'seen' OR next_landing IS NULL OR next_landing > landing + 1 OR seen_us + {round(VEHICLE_TTL_S * 1_000_000)} < passed_us
UNION ALL SELECT '~', 'seen', 0, 0, 0.0, 0.0, false, epoch_us(max(event_time)) + 86400000000 FROM crossings""")


@query("t8_live_vehicle_stream", _LIVE_UPDATES)
def live_vehicle_stream(spark, sf):
    """One ``seen`` per vehicle and landing, and one ``gone`` if it is not seen again in time."""
    with _rocksdb(spark):
        return _replayed_table(spark, sf, stateful.live_vehicle_stream, closing=True)


@query("t11_camera_refresh", with_views(f"""
SELECT event_id, car_plate, lane_id, camera_id, camera_index, position_km, speed_limit, event_time, speed_reading
FROM crossings WHERE event_time >= TIMESTAMP '{_CUT}' OR camera_id % 3 <> 0"""))
def camera_refresh(spark, sf):
    """The last camera of each lane is added to the camera table between two runs."""
    out, table = scratch_path(spark, "enriched"), scratch_path(spark, "cameras")
    checkpoint, topic = scratch_path(spark, "checkpoint"), scratch_path(spark, "raw")
    columns = ["event_id", "car_plate", "camera_id", "event_time", "speed_reading"]
    raw = bed.crossings(spark, sf).select(columns)
    known = [bed.cameras(spark).where("camera_id % 3 <> 0"), bed.cameras(spark).where("camera_id % 3 = 0")]
    cut = F.lit(_CUT).cast("timestamp")
    halves = [raw.where(F.col("event_time") < cut), raw.where(F.col("event_time") >= cut)]
    for period, cameras in zip(halves, known):
        cameras.write.mode("append").parquet(table)
        period.write.mode("append").parquet(topic)
        jobs.start_enrichment(
            spark.readStream.schema(raw.schema).parquet(topic),
            lambda session: session.read.schema(CAMERA).parquet(table),
            lambda batch, number: batch.write.mode("overwrite").parquet(f"{out}/batch={number}"),
            checkpoint,
            once=True,
        ).awaitTermination()
    return spark.read.parquet(out).select(
        *columns, "lane_id", "camera_index", "position_km", "speed_limit"
    )


@query("t12_stop_and_resume", with_views(_STORED))
def stop_and_resume(spark, sf):
    """A first run is abandoned by a reset; the second is stopped between periods and resumed."""
    crossings = bed.crossings(spark, sf)
    root = scratch_path(spark, "runs")
    abandoned, checkpoint, ledger = jobs.run_paths(root)
    early = crossings.where(F.col("event_time") < F.lit("2024-01-03").cast("timestamp"))
    replay(spark, [early], lambda e: jobs.start_detector(e, ledger, checkpoint, emit="window-close", once=True))
    run, _, _ = jobs.run_paths(root, abandoned, reset=True)

    def resume(events: DataFrame) -> StreamingQuery:
        _, checkpoint, ledger = jobs.run_paths(root, run)
        return jobs.start_detector(events, ledger, checkpoint, emit="window-close", once=True)

    replay(spark, _periods(crossings, closing=True), resume)
    return _ledger_rows(read_ledger(spark, jobs.run_paths(root, run)[2]))
