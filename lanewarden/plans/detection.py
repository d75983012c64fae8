"""Registered queries: sources, detectors, joins, dedup and trips."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanewarden.functions import scalars as S
from lanewarden.functions.ordering import global_ordinal
from lanewarden.operators import dedup, detect, geometry, ledger, live, patterns, trips
from lanewarden.plans import testbed as bed
from lanewarden.plans.registry import query
from lanewarden.plans.views_sql import with_views
from lanewarden.session import scratch_path
from lanewarden.sources import events as sources

_UNIFIED = ", ".join(detect.VIOLATION_COLUMNS)
_WIRE = "car_plate, lane_id, camera_id, camera_index, position_km, speed_limit, event_time, speed_reading"


def _crossing_rows(df):
    return df.select(*_WIRE.split(", "))


@query("s2_parse_events", with_views(f"SELECT CAST(event_id AS VARCHAR) AS event_id, {_WIRE} FROM crossings"))
def parse_events(spark, sf):
    parsed = sources.parse_events(sources.to_wire(bed.crossings(spark, sf)))
    return parsed.select("event_id", *_WIRE.split(", "))


@query("s3_read_replay_csv", with_views("""
SELECT event_time, camera_id, car_plate, speed_reading FROM crossings
WHERE event_id % 11 <> 0 AND event_id % 13 <> 0 ORDER BY event_time"""))
def replay_csv(spark, sf):
    """Crossings written as CSV in two folders, with bad stamps and empty readings, and read back."""
    text = bed.crossings(spark, sf).select(
        F.when(F.col("event_id") % 11 == 0, "not a time").otherwise(S.iso_text(F.col("event_time"))).alias("timestamp"),
        F.col("camera_id").cast("string").alias("camera_id"),
        "car_plate",
        F.when(F.col("event_id") % 13 == 0, None).otherwise(F.col("speed_reading").cast("string")).alias("speed_reading"),
    )
    root = scratch_path(spark, "replay")
    for half in (0, 1):
        text.where(F.col("camera_id").cast("int") % 2 == half).write.option("header", True).csv(f"{root}/{half}")
    return sources.in_time_order(sources.read_replay_csv(spark, [f"{root}/0", f"{root}/1"]))


@query("s4_read_vehicle_registry", with_views("SELECT * FROM cars ORDER BY car_plate LIMIT 500"))
def vehicle_registry(spark, sf):
    path = scratch_path(spark, "registry")
    bed.cars(spark, sf).withColumnRenamed("vehicle_type", "vechicle_type").write.option("header", True).csv(path)
    return sources.read_vehicle_registry(spark, path, limit=500)


@query("s10_topic_event_count", with_views("""
SELECT CAST(sum(n) AS BIGINT) AS events, count(*) AS partitions
FROM (SELECT camera_id, max(trip_id) + 1 AS n FROM crossings GROUP BY camera_id)"""))
def topic_event_count(spark, sf):
    raw = bed.crossings(spark, sf).select(F.col("camera_id").alias("partition"), F.col("trip_id").alias("offset"))
    return sources.topic_event_count(raw)


@query("p1_detect_instantaneous", with_views("SELECT * FROM inst"))
def instantaneous(spark, sf):
    return detect.detect_instantaneous(bed.crossings(spark, sf))


@query("p2_to_unified", with_views("""
SELECT car_plate, lane_id, 'AVERAGE' AS violation_type, camera_id AS camera_id_start, camera_id + 1 AS camera_id_end,
       position_km AS position_start_km, position_km + 1 AS position_end_km, event_time AS timestamp_start,
       event_time AS timestamp_end, speed_limit, CAST(NULL AS DOUBLE) AS speed_reading, speed_reading AS avg_speed
FROM crossings"""))
def unified(spark, sf):
    """A detector's own columns, in another order and without a spot reading, in the shared shape."""
    found = bed.crossings(spark, sf).select(
        F.col("speed_reading").alias("avg_speed"), "lane_id", "car_plate", "speed_limit",
        F.col("camera_id").alias("camera_id_start"), (F.col("camera_id") + 1).alias("camera_id_end"),
        F.col("position_km").alias("position_start_km"), (F.col("position_km") + 1).alias("position_end_km"),
        F.col("event_time").alias("timestamp_start"), F.col("event_time").alias("timestamp_end"),
    )
    return detect.to_unified(found, "AVERAGE")


@query("p3_to_stored_violation", with_views("SELECT * FROM ledger"))
def stored_violation(spark, sf):
    return bed.ledger(spark, sf)


@query("p4_window_start", with_views("""
SELECT event_id, event_time,
       date_trunc('hour', event_time) + CAST(minute(event_time) // 10 * 10 AS INTEGER) * INTERVAL 1 MINUTE AS w10,
       date_trunc('hour', event_time) + CAST(minute(event_time) // 7 * 7 AS INTEGER) * INTERVAL 1 MINUTE AS w7,
       date_trunc('hour', event_time) AS w90
FROM crossings"""))
def window_starts(spark, sf):
    at = F.col("event_time")
    return bed.crossings(spark, sf).select(
        "event_id", "event_time",
        *[S.window_start(at, m).alias(f"w{m}") for m in (10, 7, 90)],
    )


@query("p5_date_bucket", with_views("""
SELECT event_id, CAST(date_trunc('day', event_time) AS TIMESTAMP) AS date, CAST(CAST(event_time AS DATE) AS VARCHAR) AS day FROM crossings"""))
def date_bucket(spark, sf):
    at = F.col("event_time")
    return bed.crossings(spark, sf).select("event_id", S.day_start(at).alias("date"), S.day_of(at).cast("string").alias("day"))


@query("p13_over_limit", with_views("""
SELECT event_id, camera_id, speed_reading, speed_reading > coalesce(e.l, c.speed_limit) AS over
FROM (SELECT event_id, CASE WHEN trip_id % 5 = 0 THEN camera_id + 100 ELSE camera_id END AS camera_id, speed_reading,
             CASE WHEN trip_id % 3 = 0 THEN NULL ELSE speed_limit - 5 END AS l FROM crossings) e
JOIN cameras c USING (camera_id)"""))
def over_limit(spark, sf):
    gaps = bed.crossings(spark, sf).select(
        "event_id",
        F.when(F.col("trip_id") % 5 == 0, F.col("camera_id") + 100).otherwise(F.col("camera_id")).alias("camera_id"),
        "speed_reading",
        F.when(F.col("trip_id") % 3 == 0, None).otherwise(F.col("speed_limit") - 5).alias("speed_limit"),
    )
    return live.over_limit(gaps, bed.cameras(spark)).drop("speed_limit")


@query("p14_route_by_lane", with_views(f"SELECT event_id, {_WIRE} FROM crossings WHERE lane_id = 2"))
def route_by_lane(spark, sf):
    return live.route_by_lane(bed.crossings(spark, sf), 2).select("event_id", *_WIRE.split(", "))


@query("p15_normalise_event", with_views("""
SELECT CAST(event_id AS VARCHAR) AS event_id, car_plate, lane_id, camera_id, camera_index, position_km, speed_limit,
       strftime(event_time, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN epoch_us(event_time) % 1000000 = 0 THEN ''
                 ELSE '.' || lpad(CAST(epoch_us(event_time) % 1000000 AS VARCHAR), 6, '0') END AS timestamp,
       speed_reading
FROM crossings"""))
def normalise_event(spark, sf):
    loose = bed.crossings(spark, sf).select(
        "event_id", "car_plate", F.col("lane_id").cast("string"), F.col("camera_id").cast("double"), "camera_index",
        F.col("position_km").cast("string"), F.col("speed_limit").cast("int"),
        F.col("event_time").alias("timestamp"), F.col("speed_reading").cast("string"),
    )
    return sources.normalise_event(loose)


@query("p15_missing_event_ids", with_views("""
SELECT CAST(36 AS INTEGER) AS id_length, car_plate, strftime(event_time, '%Y-%m-%dT%H:%M:%S')
         || CASE WHEN epoch_us(event_time) % 1000000 = 0 THEN ''
                 ELSE '.' || lpad(CAST(epoch_us(event_time) % 1000000 AS VARCHAR), 6, '0') END AS timestamp
FROM crossings"""))
def missing_event_ids(spark, sf):
    """Events without an identifier; the new ones are random, so their length is compared."""
    loose = bed.crossings(spark, sf).withColumn("timestamp", F.col("event_time")).drop("event_id")
    return sources.normalise_event(loose).select(F.length("event_id").alias("id_length"), "car_plate", "timestamp")


@query("p17_parse_utc", with_views("""
SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL
                      WHEN event_id % 4 = 2 THEN date_trunc('second', event_time) - INTERVAL 150 MINUTE
                      ELSE date_trunc('second', event_time) END AS parsed
FROM crossings"""))
def parse_utc(spark, sf):
    plain = F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss")
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, plain).when(kind == 1, F.concat(plain, F.lit("Z")))
        .when(kind == 2, F.concat(plain, F.lit("+02:30"))).otherwise(F.concat(F.lit("at "), plain))
    )
    return bed.crossings(spark, sf).select("event_id", S.parse_utc(text).alias("parsed"))


@query("j1_detect_average_adjacent", with_views("SELECT * FROM avg_adj"))
def average_adjacent(spark, sf):
    return detect.detect_average(bed.crossings(spark, sf), detect.ADJACENT)


@query("j2_detect_average_all_pairs", with_views("SELECT * FROM avg_all"))
def average_all_pairs(spark, sf):
    return detect.detect_average(bed.crossings(spark, sf), detect.ALL_PAIRS)


@query("x2_detect_average_hot_plates", with_views("SELECT * FROM avg_all"))
def average_hot_plates(spark, sf):
    """The all-pairs join with the plates that hold over half a percent of the rows salted."""
    crossings = bed.crossings(spark, sf)
    hot = detect.frequent_plates(crossings, 0.005)
    return detect.detect_average(crossings, detect.ALL_PAIRS, hot_plates=hot)


@query("x2_self_found_hot_cells", with_views("SELECT * FROM avg_hot"))
def self_found_hot_cells(spark, sf):
    """A third of the rows on one plate; the slices of it to split are found, with a bound fit for small tables."""
    return detect.detect_average(bed.hot_crossings(spark, sf), hot_cell_rows=40)


@query("x1_detect_average_last_crossing", with_views("""
SELECT car_plate, lane_id, 'AVERAGE' AS violation_type, camera_id AS camera_id_start, next_camera_id AS camera_id_end,
       position_km AS position_start_km, next_position_km AS position_end_km, event_time AS timestamp_start,
       next_event_time AS timestamp_end, next_speed_limit AS speed_limit, CAST(NULL AS DOUBLE) AS speed_reading, v AS avg_speed
FROM (SELECT *, abs(next_position_km - position_km) * CAST(3600 AS DOUBLE)
               / nullif(date_diff('second', event_time, next_event_time), 0) AS v
      FROM (SELECT *, lead(camera_id) OVER w AS next_camera_id, lead(position_km) OVER w AS next_position_km,
                   lead(speed_limit) OVER w AS next_speed_limit, lead(event_time) OVER w AS next_event_time
            FROM (SELECT * REPLACE (CASE WHEN camera_index = 1 AND trip_id % 4 = 0 THEN concat('M', car_plate) ELSE car_plate END
                                    AS car_plate) FROM crossings)
            WINDOW w AS (PARTITION BY car_plate, lane_id ORDER BY event_time, camera_index))
      WHERE next_event_time <= event_time + INTERVAL 10 MINUTE)
WHERE v > next_speed_limit"""))
def average_last_crossing(spark, sf):
    """A quarter of the trips are misread at their middle camera; the segment then spans the gap."""
    return trips.detect_average_last_crossing(bed.misread_crossings(spark, sf))


_QUIET, _FAST = "speed_reading <= speed_limit", "speed_reading > speed_limit"
# A quiet crossing, then one or more that were reached too fast without a reading over the limit.
SNEAKING = [patterns.Step(_QUIET), patterns.Step(f"{_QUIET} AND prev_segment_speed > speed_limit", repeat=True)]
# Two or more readings over the limit, then a quiet one.
BRAKING = [patterns.Step(_FAST), patterns.Step(_FAST, repeat=True), patterns.Step(_QUIET)]


def pattern_sql(conditions: list[str], moves: str, source: str = "crossings") -> str:
    """All matches by recursion: runs crossing by crossing, the longest per start, then left to right.

    ``conditions`` by step number; ``moves`` are the pairs of steps that may follow one another.
    """
    meets = " ".join(f"WHEN {i} THEN coalesce({c}, false)" for i, c in enumerate(conditions))
    return with_views(f"""
SELECT c.car_plate, c.lane_id, c.match_start, c.match_end, c.n_rows FROM (
WITH RECURSIVE timed AS (
  SELECT *, row_number() OVER w AS rn, lag(event_time) OVER w AS t, lag(position_km) OVER w AS km
  FROM {source} WINDOW w AS (PARTITION BY car_plate, lane_id ORDER BY event_time, camera_index)),
rows_ AS (
  SELECT *, CASE WHEN t >= event_time - INTERVAL 10 MINUTE AND date_diff('second', t, event_time) > 0
    THEN abs(position_km - km) * CAST(3600 AS DOUBLE) / date_diff('second', t, event_time) END AS v FROM timed),
meets AS (SELECT car_plate, lane_id, rn, event_time, step FROM rows_, (SELECT unnest(range({len(conditions)})) AS step)
          WHERE CASE step {meets} END),
moves AS (SELECT * FROM (VALUES {moves}) AS m(a, b)),
runs AS (
  SELECT car_plate, lane_id, rn AS s, rn AS e, step, event_time AS began, event_time AS ended FROM meets WHERE step = 0
  UNION
  SELECT r.car_plate, r.lane_id, r.s, m.rn, m.step, r.began, m.event_time
  FROM runs r JOIN moves v ON v.a = r.step
  JOIN meets m ON m.car_plate = r.car_plate AND m.lane_id = r.lane_id AND m.rn = r.e + 1 AND m.step = v.b
  WHERE m.event_time <= r.began + INTERVAL 10 MINUTE),
longest AS (
  SELECT car_plate, lane_id, s, max(e) AS e, min(began) AS match_start, max(ended) AS match_end
  FROM runs WHERE step = {len(conditions) - 1} GROUP BY ALL),
taken AS (
  SELECT car_plate, lane_id, min(s) AS s FROM longest GROUP BY car_plate, lane_id
  UNION ALL
  SELECT l.car_plate, l.lane_id, min(n.s) FROM taken k
  JOIN longest l ON l.car_plate = k.car_plate AND l.lane_id = k.lane_id AND l.s = k.s
  JOIN longest n ON n.car_plate = l.car_plate AND n.lane_id = l.lane_id AND n.s > l.e
  GROUP BY l.car_plate, l.lane_id)
SELECT car_plate, lane_id, match_start, match_end, e - s + 1 AS n_rows FROM longest JOIN taken USING (car_plate, lane_id, s)) c""")


BRAKING_SQL = pattern_sql([_FAST, _FAST, _QUIET], "(0, 1), (1, 1), (1, 2)", "crowded")


@query("x4_row_pattern", pattern_sql([_QUIET, f"{_QUIET} AND v > speed_limit"], "(0, 1), (1, 1)"))
def row_pattern(spark, sf):
    return patterns.match_rows(bed.crossings(spark, sf), SNEAKING)


@query("x4_row_pattern_crowded", BRAKING_SQL)
def row_pattern_crowded(spark, sf):
    """Runs go on from trip to trip, and overlap."""
    return patterns.match_rows(bed.crowded_crossings(spark, sf), BRAKING)


@query("j4_enrich_crossings", with_views(f"SELECT event_id, {_WIRE} FROM crossings"))
def enrich_crossings(spark, sf):
    raw = bed.crossings(spark, sf).select("event_id", "car_plate", "camera_id", "event_time", "speed_reading")
    return trips.enrich_crossings(raw, bed.cameras(spark)).select("event_id", *_WIRE.split(", "))


@query("j4_unknown_cameras", with_views("SELECT count(*) AS skipped FROM crossings WHERE trip_id % 5 = 0"))
def unknown_cameras(spark, sf):
    camera = F.when(F.col("trip_id") % 5 == 0, F.col("camera_id") + 100).otherwise(F.col("camera_id"))
    return trips.unknown_camera_count(bed.crossings(spark, sf).withColumn("camera_id", camera), bed.cameras(spark))


@query("u1_all_violations", with_views("SELECT * FROM violations"))
def all_violations(spark, sf):
    return bed.violations(spark, sf)


@query("u2_replay_files", with_views("""
SELECT car_plate, count(*) AS crossings, min(event_time) AS first_seen FROM crossings GROUP BY car_plate"""))
def replay_files(spark, sf):
    """The files of each lane read as one frame."""
    text = bed.crossings(spark, sf).select(
        S.iso_text(F.col("event_time")).alias("timestamp"), F.col("camera_id").cast("string"),
        "car_plate", F.col("speed_reading").cast("string"), "lane_id",
    )
    root = scratch_path(spark, "files")
    text.write.partitionBy("lane_id").option("header", True).csv(root)
    replay = sources.read_replay_csv(spark, [f"{root}/lane_id={lane}" for lane, _ in bed.LANES])
    return replay.groupBy("car_plate").agg(
        F.count(F.lit(1)).alias("crossings"), F.min("event_time").alias("first_seen")
    )


@query("u4_build_violations", with_views(f"""
SELECT {_UNIFIED} FROM (SELECT *, row_number() OVER (PARTITION BY car_plate ORDER BY timestamp_start, violation_type,
  timestamp_end, camera_id_start, camera_id_end) AS rn FROM violations) WHERE rn = 1"""))
def build_violations(spark, sf):
    return detect.build_violations(bed.crossings(spark, sf))


@query("u5_same_plates", with_views("""
SELECT count(*) AS n_different, count(*) = 0 AS same_plates
FROM (SELECT car_plate FROM violations GROUP BY car_plate) a
FULL JOIN (SELECT car_plate FROM avg_all UNION SELECT car_plate FROM inst) b ON a.car_plate = b.car_plate
WHERE a.car_plate IS NULL OR b.car_plate IS NULL"""))
def same_plates(spark, sf):
    return detect.same_plates(bed.violations(spark, sf), bed.violations(spark, sf, detect.ALL_PAIRS))


# Half of the trips are misread at their middle camera, so the two strategies disagree on some vehicles.
_TRIP_PLATES = """
SELECT trip_id, concat(CASE WHEN camera_index = 1 AND trip_id % 2 = 1 THEN 'M' ELSE 'T' END, CAST(trip_id AS VARCHAR)) AS car_plate,
       lane_id, camera_id, camera_index, position_km, speed_limit, event_time, speed_reading FROM crossings"""
_PAIR = """
SELECT DISTINCT a.car_plate FROM c a JOIN c b ON a.car_plate = b.car_plate AND a.lane_id = b.lane_id AND {pair}
 AND b.event_time > a.event_time AND b.event_time <= a.event_time + INTERVAL 10 MINUTE
WHERE date_diff('second', a.event_time, b.event_time) > 0
  AND abs(b.position_km - a.position_km) * CAST(3600 AS DOUBLE) / date_diff('second', a.event_time, b.event_time) > b.speed_limit
UNION SELECT car_plate FROM c WHERE speed_reading > speed_limit"""


@query("j12_compare_strategies", with_views(f"""
SELECT coalesce(a.car_plate, b.car_plate) AS car_plate, a.car_plate IS NOT NULL AS flagged_adjacent,
       b.car_plate IS NOT NULL AS flagged_all_pairs
FROM (WITH c AS ({_TRIP_PLATES}) {_PAIR.format(pair='abs(a.camera_index - b.camera_index) = 1')}) a
FULL JOIN (WITH c AS ({_TRIP_PLATES}) {_PAIR.format(pair='a.camera_index <> b.camera_index')}) b ON a.car_plate = b.car_plate
WHERE a.car_plate IS NULL OR b.car_plate IS NULL"""))
def compare_strategies(spark, sf):
    misread = (F.col("camera_index") == 1) & (F.col("trip_id") % 2 == 1)
    plate = F.concat(F.when(misread, "M").otherwise("T"), F.col("trip_id").cast("string"))
    return detect.compare_strategies(bed.crossings(spark, sf).withColumn("car_plate", plate))


@query("w1_camera_index", with_views("""
SELECT *, CAST(row_number() OVER (PARTITION BY lane_id ORDER BY position_km, camera_id) - 1 AS INTEGER) AS camera_index
FROM net_cameras"""))
def camera_index(spark, sf):
    return trips.index_cameras(bed.network_cameras(spark, sf))


_SEGMENT = "event_id, next_event_time, distance_km, dt_seconds, segment_speed"


@query("w2_consecutive_segments", with_views(f"SELECT {_SEGMENT}, coalesce(next_camera_id, 0) AS next_camera_id FROM segments"))
def segments_by_trip(spark, sf):
    segments = trips.consecutive_segments(bed.crossings(spark, sf), ["trip_id"])
    return segments.na.fill(0, ["next_camera_id"]).select(*_SEGMENT.split(", "), "next_camera_id")


@query("w2_segments_by_gap", with_views("""
SELECT event_id, trip_start,
       CASE WHEN dt <= 600 THEN next_camera_id ELSE 0 END AS next_camera_id, CASE WHEN dt <= 600 THEN dt END AS dt_seconds
FROM (SELECT *, (epoch_us(lead(event_time) OVER w) - epoch_us(event_time)) / CAST(1000000 AS DOUBLE) AS dt,
             lead(camera_id) OVER w AS next_camera_id
      FROM gap_trips WINDOW w AS (PARTITION BY car_plate, lane_id ORDER BY event_time, camera_index))"""))
def segments_by_gap(spark, sf):
    named = trips.assign_trips(bed.crossings(spark, sf))
    segments = trips.consecutive_segments(named).na.fill(0, ["next_camera_id"])
    return segments.select("event_id", "trip_start", "next_camera_id", "dt_seconds")


@query("w5_first_per_plate_window", with_views(f"SELECT {_UNIFIED}, window_start FROM first_rows"))
def first_per_plate_window(spark, sf):
    return dedup.first_per_plate_window(bed.violations(spark, sf))


@query("w6_expand_trips", with_views("SELECT * FROM crossings"))
def expand_trips(spark, sf):
    return bed.crossings(spark, sf)


@query("a5_trip_summary", with_views("""
SELECT * EXCLUDE (behavior), CASE WHEN expect_instantaneous AND expect_average THEN 'INSTANT+AVG'
  WHEN expect_instantaneous THEN 'INSTANT' WHEN expect_average THEN 'AVERAGE' ELSE 'clean' END AS label FROM trip_sums"""))
def trip_summary(spark, sf):
    return trips.trip_summary(trips.consecutive_segments(bed.crossings(spark, sf), ["trip_id"]), ["trip_id"])


@query("a5_summary_by_gap", with_views("""
SELECT car_plate, lane_id, trip_start, count(*) AS n_events, round_even(max(speed_reading), 1) AS max_spot,
       bool_or(speed_reading > speed_limit) AS expect_instantaneous
FROM gap_trips GROUP BY car_plate, lane_id, trip_start"""))
def summary_by_gap(spark, sf):
    named = trips.assign_trips(bed.crossings(spark, sf))
    keys = ["car_plate", "lane_id", "trip_start"]
    sums = trips.trip_summary(trips.consecutive_segments(named), keys)
    return sums.select(*keys, "n_events", "max_spot", "expect_instantaneous")


@query("p18_trip_label", with_views("""
SELECT CASE WHEN expect_instantaneous AND expect_average THEN 'INSTANT+AVG' WHEN expect_instantaneous THEN 'INSTANT'
            WHEN expect_average THEN 'AVERAGE' ELSE 'clean' END AS label, count(*) AS trips
FROM trip_sums GROUP BY ALL"""))
def trip_labels(spark, sf):
    sums = trips.trip_summary(trips.consecutive_segments(bed.crossings(spark, sf), ["trip_id"]), ["trip_id"])
    return sums.groupBy("label").agg(F.count(F.lit(1)).alias("trips"))


@query("a12_traffic_stats", with_views("""
SELECT behavior, count(*) AS trips, CAST(sum(n_events) AS BIGINT) AS events,
       count(*) FILTER (expect_instantaneous) AS expect_instantaneous, count(*) FILTER (expect_average) AS expect_average
FROM trip_sums GROUP BY behavior"""))
def traffic_stats(spark, sf):
    segments = trips.consecutive_segments(bed.crossings(spark, sf), ["trip_id"])
    return trips.trip_summary(segments, ["trip_id", "behavior"]).groupBy("behavior").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("n_events").alias("events"),
        F.count_if("expect_instantaneous").alias("expect_instantaneous"),
        F.count_if("expect_average").alias("expect_average"),
    )


@query("l6_first_events", with_views("""
SELECT event_time, camera_id, car_plate, speed_reading FROM crossings ORDER BY event_time, camera_id, car_plate LIMIT 1000"""))
def first_events(spark, sf):
    rows = bed.crossings(spark, sf).select("event_time", "camera_id", "car_plate", "speed_reading")
    return sources.in_time_order(rows, 1000)


# --- geometry -------------------------------------------------------------------------------

@query("s5_lay_out_cameras", with_views("""
SELECT CAST(row_number() OVER (ORDER BY lane_id, slot) AS INTEGER) AS camera_id, lane_id,
       round(slot * CAST(1 AS DOUBLE), 3) AS position_km, speed_limit
FROM (SELECT CAST(s_suppkey + 1 AS INTEGER) AS lane_id, CAST(80 + s_nationkey AS DOUBLE) AS speed_limit,
             unnest(generate_series(1, s_nationkey % 5)) AS slot FROM supplier)"""))
def lay_out_cameras(spark, sf):
    plan = bed.table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1).cast("int").alias("lane_id"),
        (F.col("s_nationkey") % 5).alias("camera_count"),
        (F.col("s_nationkey") + 80).cast("double").alias("speed_limit"),
    )
    return geometry.lay_out_cameras(plan)


@query("w3_append_cameras", with_views("""
SELECT CAST((SELECT max(camera_id) FROM net_cameras) + row_number() OVER (ORDER BY request_id) AS INTEGER) AS camera_id,
       lane_id, round(coalesce(last_km, 0) + k * CAST(1 AS DOUBLE), 3) AS position_km,
       coalesce(speed_limit, greatest(coalesce(top_limit, CASE WHEN first_limit IS NULL THEN CAST(100 AS DOUBLE) END), earlier)) AS speed_limit
FROM (SELECT r.*, c.last_km, c.top_limit, row_number() OVER w AS k, first_value(r.speed_limit) OVER w AS first_limit,
             max(r.speed_limit) OVER (PARTITION BY r.lane_id ORDER BY r.request_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
      FROM requests r JOIN net_lanes l ON r.lane_id = l.lane_id
      LEFT JOIN (SELECT lane_id, max(position_km) AS last_km, max(speed_limit) AS top_limit
                 FROM net_cameras GROUP BY lane_id) c ON r.lane_id = c.lane_id
      WINDOW w AS (PARTITION BY r.lane_id ORDER BY r.request_id))"""))
def append_cameras(spark, sf):
    return geometry.append_cameras(
        bed.network_cameras(spark, sf), bed.network_lanes(spark, sf), bed.camera_requests(spark, sf)
    )


_CHAINS = """
SELECT *, count(*) OVER (PARTITION BY lane_id) AS n,
       row_number() OVER (PARTITION BY lane_id ORDER BY position_km DESC, camera_id DESC) AS rn FROM net_cameras"""
_ASKED = """
SELECT lane_id, count(*) AS asked FROM requests WHERE lane_id IN (SELECT lane_id FROM net_lanes) GROUP BY lane_id"""


def _removal_inputs(spark, sf):
    return bed.network_cameras(spark, sf), bed.network_lanes(spark, sf), bed.camera_requests(spark, sf).select("lane_id")


@query("w4_remove_last_camera", with_views(f"""
SELECT camera_id, lane_id, position_km, speed_limit FROM ({_CHAINS})
JOIN ({_ASKED}) USING (lane_id) WHERE rn <= least(asked, n - 2)"""))
def remove_last(spark, sf):
    return geometry.remove_last_cameras(*_removal_inputs(spark, sf))


@query("w4_refused_removals", with_views(f"""
SELECT * FROM (SELECT lane_id, CAST(asked - greatest(0, least(asked, coalesce(n, 0) - 2)) AS BIGINT) AS refused
  FROM ({_ASKED}) LEFT JOIN (SELECT lane_id, count(*) AS n FROM net_cameras GROUP BY lane_id) USING (lane_id))
WHERE refused > 0"""))
def refused_removals(spark, sf):
    return geometry.refused_removals(*_removal_inputs(spark, sf))


@query("w4_cameras_after_removal", with_views(f"""
SELECT camera_id, lane_id, position_km, speed_limit FROM ({_CHAINS}) LEFT JOIN ({_ASKED}) USING (lane_id)
WHERE NOT coalesce(rn <= least(asked, n - 2), false)"""))
def after_removal(spark, sf):
    return geometry.cameras_after_removal(*_removal_inputs(spark, sf))


@query("j9_unknown_lane_requests", with_views("""
SELECT * FROM requests WHERE lane_id NOT IN (SELECT lane_id FROM net_lanes)"""))
def unknown_lanes(spark, sf):
    return geometry.unknown_lane_requests(bed.camera_requests(spark, sf), bed.network_lanes(spark, sf))


@query("j13_camera_config_diff", with_views("""
SELECT coalesce(a.lane_id, b.lane_id) AS lane_id, coalesce(a.n, 0) AS cameras_before, coalesce(b.n, 0) AS cameras_after
FROM (SELECT CASE WHEN camera_id % 7 = 0 THEN 0 ELSE lane_id END AS lane_id, count(*) AS n FROM net_cameras GROUP BY 1) a
FULL JOIN (SELECT CASE WHEN camera_id % 5 = 0 THEN 0 ELSE lane_id END AS lane_id, count(*) AS n FROM net_cameras GROUP BY 1) b
  ON a.lane_id = b.lane_id
WHERE a.n IS DISTINCT FROM b.n"""))
def camera_config_diff(spark, sf):
    """Some cameras stand in a yard, lane 0; others do at the second read."""
    cameras = bed.network_cameras(spark, sf)
    before, after = (
        cameras.withColumn("lane_id", F.when(F.col("camera_id") % n == 0, 0).otherwise(F.col("lane_id"))) for n in (7, 5)
    )
    return geometry.camera_config_diff(before, after).na.fill(0)


@query("p10_cameras_of_lane", with_views("SELECT * FROM net_cameras WHERE lane_id = 3"))
def cameras_of_lane(spark, sf):
    return geometry.cameras_of_lane(bed.network_cameras(spark, sf), 3)


@query("p10_all_cameras", with_views("SELECT * FROM net_cameras"))
def all_cameras(spark, sf):
    return geometry.cameras_of_lane(bed.network_cameras(spark, sf))


@query("a2_camera_counts_by_lane", with_views("SELECT lane_id, count(*) AS camera_count FROM net_cameras GROUP BY lane_id"))
def camera_counts(spark, sf):
    return ledger.camera_counts_by_lane(bed.network_cameras(spark, sf))


@query("a13_lane_limits", with_views("""
SELECT lane_id, string_agg(CAST(CAST(speed_limit AS INTEGER) AS VARCHAR), ',' ORDER BY speed_limit) AS limits
FROM (SELECT DISTINCT lane_id, speed_limit FROM net_cameras) GROUP BY lane_id"""))
def lane_limits(spark, sf):
    limits = geometry.lane_limits(bed.network_cameras(spark, sf))
    whole = F.transform("limits", lambda x: x.cast("int").cast("string"))
    return limits.select("lane_id", F.array_join(whole, ",").alias("limits"))


@query("a14_lane_span", with_views("""
SELECT lane_id, max(position_km) AS span_km, count(*) AS camera_count FROM net_cameras GROUP BY lane_id"""))
def lane_span(spark, sf):
    return geometry.lane_span(bed.network_cameras(spark, sf))


@query("x3_global_ordinal", with_views("""
SELECT event_id, row_number() OVER (ORDER BY event_time DESC, event_id) - 1 AS ordinal FROM crossings"""))
def ordinal(spark, sf):
    rows = bed.crossings(spark, sf).select("event_id", "event_time")
    return global_ordinal(rows, F.col("event_time").desc(), F.col("event_id").asc()).select("event_id", "ordinal")
