"""Registered queries: the ledger, its questions, its figures, and the live picture."""

from __future__ import annotations

from pyspark.sql import functions as F

from lanewarden.functions import scalars as S
from lanewarden.functions.ordering import nearest_rank, values_at_ranks
from lanewarden.operators import ledger as L
from lanewarden.operators import live, metrics
from lanewarden.operators.detect import VIOLATION_COLUMNS
from lanewarden.plans import testbed as bed
from lanewarden.plans.registry import query
from lanewarden.plans.views_sql import with_views
from lanewarden.session import materialize, scratch_path
from lanewarden.sources import sinks

_UNIFIED = ", ".join(VIOLATION_COLUMNS)
_NEWEST = "ORDER BY detected_at DESC, car_plate, window_start"
_ISO = (
    "strftime({0}, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us({0}) % 1000000 = 0 THEN '' "
    "ELSE '.' || lpad(CAST(epoch_us({0}) % 1000000 AS VARCHAR), 6, '0') END"
)
_NOW = "2024-01-20 12:00:00"
_ROAD_TTL_S = 6 * 3600.0


def _summary(spark, sf):
    return L.lanes_summary(bed.lanes(spark), bed.cameras(spark), bed.ledger(spark, sf))


# --- filters, lookups, pages ----------------------------------------------------------------

@query("p6_filter_violations", with_views("""
SELECT * FROM ledger WHERE lane_id = 1 AND violation_type = 'AVERAGE' AND date >= TIMESTAMP '2024-01-15'
  AND date < TIMESTAMP '2024-01-16'"""))
def filter_violations(spark, sf):
    return L.filter_violations(
        bed.ledger(spark, sf), lane_id=1, violation_type="AVERAGE", car_plate="", date="2024-01-15"
    )


@query("p6_filter_by_plate", with_views("SELECT * FROM ledger WHERE car_plate = 'P7'"))
def filter_by_plate(spark, sf):
    return L.filter_violations(bed.ledger(spark, sf), car_plate="P7", violation_type="", date="")


@query("p8_search_cars", with_views("SELECT * FROM cars WHERE starts_with(lower(car_plate), 'p11')"))
def search_cars(spark, sf):
    return L.search_cars(bed.cars(spark, sf), "p11")


@query("p9_car_by_plate", with_views("SELECT * FROM cars WHERE car_plate = 'P42'"))
def car_by_plate(spark, sf):
    return L.car_by_plate(bed.cars(spark, sf), "P42")


@query("p9_lane_by_id", with_views("SELECT * FROM net_lanes WHERE lane_id = 5"))
def lane_by_id(spark, sf):
    return L.lane_by_id(bed.network_lanes(spark, sf), 5)


_IDS = "SELECT *, sha256(concat_ws('|', car_plate, CAST(epoch_us(window_start) AS VARCHAR))) AS id FROM ledger"


@query("p9_violation_ids", with_views(_IDS))
def violation_ids(spark, sf):
    return L.with_violation_id(bed.ledger(spark, sf))


@query("p9_violation_by_id", with_views(
    f"SELECT * FROM ({_IDS}) ORDER BY car_plate <> 'P7', window_start LIMIT 1"))
def violation_by_id(spark, sf):
    """The first violation of one plate, found by its identifier."""
    ledger = bed.ledger_table(spark, sf)
    first = ledger.where(F.col("car_plate") == "P7").agg(F.min("window_start").alias("w"))
    return L.violation_by_id(ledger, first.select(S.violation_id(F.lit("P7"), F.col("w"))).scalar())


@query("p11_violation_speed", with_views("""
SELECT car_plate, timestamp_start, violation_type,
       CASE WHEN violation_type = 'AVERAGE' THEN avg_speed ELSE speed_reading END AS speed FROM violations"""))
def violation_speed(spark, sf):
    speed = S.violation_speed(F.col("violation_type"), F.col("avg_speed"), F.col("speed_reading"))
    return bed.violations(spark, sf).select("car_plate", "timestamp_start", "violation_type", speed.alias("speed"))


_KEY = f"concat_ws('|', car_plate, violation_type, {_ISO.format('timestamp_start')}, CAST(camera_id_start AS VARCHAR))"


@query("p12_violation_key", with_views(f"SELECT {_KEY} AS violation_key FROM violations"))
def violation_key(spark, sf):
    key = S.violation_key(
        F.col("car_plate"), F.col("violation_type"), F.col("timestamp_start"), F.col("camera_id_start")
    )
    return bed.violations(spark, sf).select(key.alias("violation_key"))


_JSON_SAFE = ", ".join(
    f"{_ISO.format(c)} AS {c}" if c.startswith("timestamp") else c for c in VIOLATION_COLUMNS
) + "".join(f", {_ISO.format(c)} AS {c}" for c in ("window_start", "date", "detected_at"))


@query("p16_to_json_safe", with_views(f"SELECT {_JSON_SAFE} FROM ledger"))
def to_json_safe(spark, sf):
    return L.to_json_safe(bed.ledger(spark, sf))


@query("p19_plausible_latency", with_views("""
SELECT us AS latency_us, us / CAST(1000000 AS DOUBLE) AS latency_s FROM delays"""))
def plausible_latency(spark, sf):
    return metrics.latencies(bed.ledger(spark, sf))


@query("p20_car_plates", with_views("SELECT car_plate FROM cars"))
def car_plates(spark, sf):
    return L.car_plates(bed.cars(spark, sf))


@query("l1_page_violations", with_views(f"SELECT * FROM ledger WHERE lane_id = 2 {_NEWEST} LIMIT 50 OFFSET 100"))
def page_violations(spark, sf):
    return L.page_violations(bed.ledger_table(spark, sf), lane_id=2, skip=100, limit=50)


@query("l1_deep_page", with_views(f"SELECT * FROM ledger {_NEWEST} LIMIT 500 OFFSET 1000"))
def deep_page(spark, sf):
    return L.page_violations(bed.ledger_table(spark, sf), skip=1000, limit=500)


@query("l2_page_cars", with_views("""
SELECT * FROM cars WHERE starts_with(lower(car_plate), 'p1') ORDER BY car_plate LIMIT 40 OFFSET 20"""))
def page_cars(spark, sf):
    return L.page_cars(bed.cars(spark, sf), "p1", skip=20, limit=40)


@query("l3_recent_feed", with_views(f"SELECT * FROM ledger {_NEWEST} LIMIT 60"))
def recent_feed(spark, sf):
    return L.recent_feed(bed.ledger(spark, sf))


@query("l3_recent_feed_of_lane", with_views(f"SELECT * FROM ledger WHERE lane_id = 3 {_NEWEST} LIMIT 60"))
def recent_feed_of_lane(spark, sf):
    return L.recent_feed(bed.ledger(spark, sf), lane_id=3)


@query("l4_latest_n_per_lane", with_views("""
SELECT event_id, lane_id, event_time FROM (
  SELECT *, row_number() OVER (PARTITION BY lane_id ORDER BY event_time DESC, event_id DESC) AS rn FROM crossings)
WHERE rn <= 90"""))
def latest_n_per_lane(spark, sf):
    return live.latest_n_per_lane(bed.crossings(spark, sf)).select("event_id", "lane_id", "event_time")


@query("u3_merge_feed", with_views(f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY violation_key ORDER BY source, detected_at) AS rn FROM (
    SELECT {_KEY} AS violation_key, 0 AS source, * FROM ledger WHERE lane_id <> 2
    UNION ALL SELECT {_KEY} AS violation_key, 1 AS source, * FROM ledger WHERE lane_id <> 1))
WHERE rn = 1 ORDER BY detected_at DESC, violation_key LIMIT 60""").replace("EXCLUDE (rn)", "EXCLUDE (rn, source)"))
def merge_feed(spark, sf):
    ledger = bed.ledger_table(spark, sf)
    return L.merge_feed(ledger.where("lane_id <> 2"), ledger.where("lane_id <> 1"))


@query("a17_matching_total", with_views("SELECT count(*) AS total FROM ledger WHERE lane_id = 2"))
def matching_total(spark, sf):
    return L.matching_total(bed.ledger(spark, sf), lane_id=2)


# --- tallies and documents ------------------------------------------------------------------

@query("a1_violation_counts_by_lane", with_views("SELECT * FROM lane_tally"))
def counts_by_lane(spark, sf):
    return L.violation_counts_by_lane(bed.ledger(spark, sf))


@query("a3_network_totals", with_views("""
SELECT count(*) AS lanes, CAST(sum(total) AS BIGINT) AS total, CAST(sum(instantaneous) AS BIGINT) AS instantaneous,
       CAST(sum(average) AS BIGINT) AS average, CAST(sum(camera_count) AS BIGINT) AS cameras FROM summary"""))
def network_totals(spark, sf):
    return L.network_totals(_summary(spark, sf))


@query("a4_type_share_by_lane", with_views("""
SELECT lane_id, instantaneous / greatest(total, 1) * CAST(100 AS DOUBLE) AS instantaneous_pct,
       average / greatest(total, 1) * CAST(100 AS DOUBLE) AS average_pct FROM summary"""))
def type_share(spark, sf):
    return L.type_share_by_lane(_summary(spark, sf))


@query("j5_lanes_summary", with_views("SELECT * FROM summary"))
def lanes_summary(spark, sf):
    return _summary(spark, sf)


@query("j5_network_summary", with_views("""
SELECT l.lane_id, l.name, coalesce(c.n, 0) AS camera_count, coalesce(t.total, 0) AS total,
       coalesce(t.instantaneous, 0) AS instantaneous, coalesce(t.average, 0) AS average
FROM net_lanes l LEFT JOIN (SELECT lane_id, count(*) AS n FROM net_cameras GROUP BY lane_id) c ON l.lane_id = c.lane_id
LEFT JOIN lane_tally t ON l.lane_id = t.lane_id"""))
def network_summary(spark, sf):
    return L.lanes_summary(bed.network_lanes(spark, sf), bed.network_cameras(spark, sf), bed.ledger(spark, sf))


@query("j6_lane_detail", with_views("""
SELECT l.lane_id, l.name, coalesce(c.cameras, '') AS cameras, coalesce(t.total, 0) AS total,
       coalesce(t.instantaneous, 0) AS instantaneous, coalesce(t.average, 0) AS average
FROM net_lanes l
LEFT JOIN (SELECT lane_id, string_agg(concat(camera_id, '@', CAST(round(position_km * 1000) AS BIGINT)), ','
                                      ORDER BY position_km, camera_id) AS cameras FROM net_cameras GROUP BY lane_id) c
  ON l.lane_id = c.lane_id
LEFT JOIN lane_tally t ON l.lane_id = t.lane_id"""))
def lane_detail(spark, sf):
    """Every lane's document, with the camera list as text."""
    detail = L.lane_detail(bed.network_lanes(spark, sf), bed.network_cameras(spark, sf), bed.ledger(spark, sf))
    camera = lambda c: F.concat(c["camera_id"], F.lit("@"), F.round(c["position_km"] * 1000).cast("long"))
    return detail.withColumn("cameras", F.array_join(F.transform("cameras", camera), ","))


@query("j7_car_with_violations", with_views("""
SELECT c.car_plate, c.owner_name, coalesce(v.n, 0) AS n_violations, coalesce(v.seen, '') AS violations
FROM cars c LEFT JOIN (
  SELECT car_plate, CAST(count(*) AS INTEGER) AS n,
         string_agg(CAST(epoch_us(detected_at) AS VARCHAR), ',' ORDER BY detected_at DESC) AS seen
  FROM ledger GROUP BY car_plate) v ON c.car_plate = v.car_plate"""))
def car_with_violations(spark, sf):
    """Every car's document, with the detection times as text."""
    documents = L.car_with_violations(bed.cars(spark, sf), bed.ledger(spark, sf))
    seen = F.transform("violations", lambda v: F.unix_micros(v["detected_at"]).cast("string"))
    return documents.select(
        "car_plate", "owner_name", F.size("violations").alias("n_violations"), F.array_join(seen, ",").alias("violations")
    )


_INCOMING = """
SELECT CASE WHEN c_custkey % 2 = 0 THEN concat('P', CAST(c_custkey AS VARCHAR)) ELSE concat('N', CAST(c_custkey % 400 AS VARCHAR)) END
       AS car_plate, c_name AS owner_name FROM customer"""


def _incoming(spark, sf):
    customer = bed.table(spark, sf, "customer")
    plate = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("P"), F.col("c_custkey"))).otherwise(
        F.concat(F.lit("N"), F.col("c_custkey") % 400)
    )
    return customer.select(
        plate.alias("car_plate"), F.col("c_name").alias("owner_name"), F.lit("address").alias("owner_addr"),
        F.lit("car").alias("vehicle_type"), F.lit("2024-01-01").alias("registration_date"),
    )


@query("j8_register_cars", with_views(f"""
SELECT car_plate, min(owner_name) AS owner_name, 'address' AS owner_addr, 'car' AS vehicle_type, '2024-01-01' AS registration_date
FROM ({_INCOMING}) WHERE car_plate NOT IN (SELECT car_plate FROM cars) GROUP BY car_plate"""))
def register_cars(spark, sf):
    return L.register_cars(bed.cars(spark, sf), _incoming(spark, sf))[0]


@query("j8_refused_cars", with_views(f"""
SELECT * FROM (SELECT i.car_plate, CAST(count(*) - CASE WHEN max(c.car_plate) IS NULL THEN 1 ELSE 0 END AS BIGINT) AS refused
FROM ({_INCOMING}) i LEFT JOIN cars c ON i.car_plate = c.car_plate GROUP BY i.car_plate) WHERE refused > 0"""))
def refused_cars(spark, sf):
    return L.register_cars(bed.cars(spark, sf), _incoming(spark, sf))[1]


@query("j10_latest_capture", with_views(f"""
SELECT v.*, c.* EXCLUDE (car_plate) FROM (SELECT * FROM ledger {_NEWEST} LIMIT 1) v LEFT JOIN cars c ON v.car_plate = c.car_plate"""))
def latest_capture(spark, sf):
    return L.latest_capture(bed.ledger(spark, sf), bed.cars(spark, sf))


# --- the ledger as it is stored ---------------------------------------------------------------

_STORED = with_views("SELECT * REPLACE (CAST(CAST(timestamp_start AS DATE) AS VARCHAR) AS date) FROM ledger")


def _stored(spark, sf):
    return sinks.read_ledger(spark, bed.stored_ledger(spark, sf))


def _day_as_text(ledger):
    return ledger.withColumn("date", F.col("date").cast("string"))


@query("l3_newest_rows_stored", f"SELECT * FROM ({_STORED}) {_NEWEST} LIMIT 60")
def newest_rows_stored(spark, sf):
    return _day_as_text(L.newest_rows(_stored(spark, sf), 60))


_REF = "hex(car_plate) || '-' || CAST(epoch_us(window_start) // 60000000 AS VARCHAR)"


@query("p9_violation_refs", f"SELECT car_plate, window_start, {_REF} || '-' || left(md5({_REF}), 8) AS ref FROM ({_STORED})")
def violation_refs(spark, sf):
    return L.with_violation_ref(bed.ledger(spark, sf)).select("car_plate", "window_start", "ref")


@query("p9_violation_by_ref", f"SELECT * FROM ({_STORED}) ORDER BY car_plate <> 'P7', window_start LIMIT 1")
def violation_by_ref(spark, sf):
    """The first violation of one plate, found by the identifier that carries its key."""
    ledger = _stored(spark, sf)
    first = L.with_violation_ref(ledger.where(F.col("car_plate") == "P7")).agg(F.min_by("ref", "window_start").alias("ref")).first()
    return _day_as_text(L.violation_by_ref(ledger, first["ref"]))


@query("s7_compacted_ledger", _STORED)
def compacted_ledger(spark, sf):
    """Two appends leave two files and more in each day; the days before the last are compacted."""
    path = scratch_path(spark, "ledger")
    rows = bed.ledger_table(spark, sf)
    for part in (0, 1):
        sinks.append_to_ledger(rows.where(F.pmod(F.xxhash64("car_plate"), F.lit(2)) == part), path)
    ledger = sinks.read_ledger(spark, path)
    sinks.compact_ledger(spark, path, ledger.agg(F.max("date")).first()[0])
    return _day_as_text(sinks.read_ledger(spark, path))


@query("s12_delete_stored", f"SELECT * FROM ({_STORED}) WHERE NOT (detected_at >= TIMESTAMP '{_NOW}')")
def delete_stored(spark, sf):
    path = bed.stored_ledger(spark, sf)
    sinks.delete_stored_violations(spark, path, _NOW)
    return _day_as_text(sinks.read_ledger(spark, path))


@query("j7_car_history_pieces", with_views("""
SELECT c.car_plate, v.month, coalesce(v.piece, 0) AS piece, coalesce(v.n, 0) AS n_violations, coalesce(v.seen, '') AS violations
FROM cars c LEFT JOIN (
  SELECT car_plate, month, piece, CAST(count(*) AS INTEGER) AS n,
         string_agg(CAST(epoch_us(detected_at) AS VARCHAR), ',' ORDER BY detected_at DESC) AS seen
  FROM (SELECT *, CAST((row_number() OVER (PARTITION BY car_plate, month ORDER BY detected_at DESC) - 1) // 5 AS INTEGER) AS piece
        FROM (SELECT *, strftime(window_start, '%Y-%m') AS month FROM ledger))
  GROUP BY ALL) v ON c.car_plate = v.car_plate"""))
def car_history_pieces(spark, sf):
    pieces = L.car_history_pieces(bed.cars(spark, sf), bed.ledger(spark, sf), 5)
    seen = F.transform("violations", lambda v: F.unix_micros(v["detected_at"]).cast("string"))
    return pieces.select(
        "car_plate", "month", "piece", F.size("violations").alias("n_violations"), F.array_join(seen, ",").alias("violations")
    )


@query("p14_route_all_lanes", with_views("""
SELECT event_id, car_plate, lane_id, camera_id, event_time, speed_reading FROM crossings"""))
def route_all_lanes(spark, sf):
    path = scratch_path(spark, "lanes")
    sinks.write_by_lane(bed.crossings(spark, sf), path)
    return spark.read.parquet(path).select("event_id", "car_plate", "lane_id", "camera_id", "event_time", "speed_reading")


# --- table upkeep ---------------------------------------------------------------------------

@query("s6_upsert_by_key", with_views(f"""
SELECT * FROM cars WHERE car_plate NOT IN (SELECT car_plate FROM ({_INCOMING}))
UNION ALL SELECT car_plate, min(owner_name), 'address', 'car', '2024-01-01' FROM ({_INCOMING}) GROUP BY car_plate"""))
def upsert(spark, sf):
    path = sinks.overwrite_copy(
        L.upsert_by_key(bed.cars(spark, sf), _incoming(spark, sf), "car_plate"), scratch_path(spark, "cars")
    )
    return spark.read.parquet(path)


@query("s6_upsert_counts", with_views(f"""
SELECT count(*) FILTER (car_plate NOT IN (SELECT car_plate FROM cars)) AS inserted,
       count(*) FILTER (car_plate IN (SELECT car_plate FROM cars)) AS updated
FROM (SELECT DISTINCT car_plate FROM ({_INCOMING}))"""))
def upsert_counts(spark, sf):
    return L.upsert_counts(bed.cars(spark, sf), _incoming(spark, sf), "car_plate")


def _ledger_rows(table):
    """The table without the time of writing, its day as text."""
    return table.drop("detected_at").withColumn("date", F.col("date").cast("string"))


@query("s7_write_violations", with_views(f"SELECT {_UNIFIED}, window_start, CAST(CAST(timestamp_start AS DATE) AS VARCHAR) AS date FROM first_rows"))
def write_violations(spark, sf):
    """Two batches and a replay of the second go to a fresh ledger; it holds each key once."""
    found = materialize(bed.violations(spark, sf), "violations")
    path = scratch_path(spark, "ledger")
    writer = sinks.LedgerWriter(path)
    early = F.col("timestamp_start") < F.lit("2024-01-15").cast("timestamp")
    for number, batch in enumerate([found.where(early), found.where(~early), found.where(~early)]):
        writer(batch, number)
    return _ledger_rows(sinks.read_ledger(spark, path))


@query("s8_republish_violations", with_views(f"""
SELECT car_plate AS key, car_plate, lane_id, violation_type, {_ISO.format('timestamp_start')} AS timestamp_start,
       {_ISO.format('window_start')} AS window_start, avg_speed FROM ledger"""))
def republish(spark, sf):
    """The published messages, decoded again."""
    sent = sinks.republish_violations(bed.ledger(spark, sf))
    body = F.from_json(
        "value",
        "car_plate string, lane_id int, violation_type string, timestamp_start string, window_start string, avg_speed double",
    )
    return sent.select("key", body.alias("v")).select("key", "v.*")


@query("s9_export_violations_csv", with_views(f"""
SELECT car_plate, lane_id, violation_type, {_ISO.format('timestamp_start')} AS timestamp_start, speed_limit, speed_reading,
       avg_speed, {_ISO.format('date')} AS date, {_ISO.format('detected_at')} AS detected_at
FROM ledger WHERE violation_type = 'INSTANTANEOUS'"""))
def export_csv(spark, sf):
    """The export read back, most of its columns."""
    path = scratch_path(spark, "export")
    sinks.export_violations_csv(bed.ledger(spark, sf), path, violation_type="INSTANTANEOUS")
    text = spark.read.option("header", True).csv(path)
    return text.select(
        "car_plate", F.col("lane_id").cast("int"), "violation_type", "timestamp_start", F.col("speed_limit").cast("double"),
        F.col("speed_reading").cast("double"), F.col("avg_speed").cast("double"), "date", "detected_at",
    )


@query("s11_table_counts", with_views("""
SELECT 'lanes' AS table_name, count(*) AS n FROM net_lanes UNION ALL SELECT 'cameras', count(*) FROM net_cameras
UNION ALL SELECT 'cars', count(*) FROM cars UNION ALL SELECT 'violations', count(*) FROM ledger"""))
def table_counts(spark, sf):
    return L.table_counts(
        {
            "lanes": bed.network_lanes(spark, sf),
            "cameras": bed.network_cameras(spark, sf),
            "cars": bed.cars(spark, sf),
            "violations": bed.ledger(spark, sf),
        }
    )


@query("s12_delete_violations", with_views("SELECT * FROM ledger WHERE NOT (detected_at >= TIMESTAMP '2024-01-20 12:00:00')"))
def delete_violations(spark, sf):
    return L.without_violations(bed.ledger(spark, sf), since=_NOW)


# --- figures --------------------------------------------------------------------------------

@query("a6_batch_report", with_views("""
SELECT b.batch_id, CAST(sum(b.n) AS BIGINT) AS violations, CAST(sum(b.i) AS BIGINT) AS instant, CAST(sum(b.a) AS BIGINT) AS average,
       count(*) FILTER (s.car_plate IS NULL) AS new, CAST(sum(b.n) - count(*) FILTER (s.car_plate IS NULL) AS BIGINT) AS duplicate
FROM (SELECT day(timestamp_start) % 6 AS batch_id, car_plate, window_start, count(*) AS n,
             count(*) FILTER (violation_type = 'INSTANTANEOUS') AS i, count(*) FILTER (violation_type = 'AVERAGE') AS a
      FROM (SELECT *, date_trunc('hour', timestamp_start) + CAST(minute(timestamp_start) // 10 * 10 AS INTEGER) * INTERVAL 1 MINUTE
                   AS window_start FROM violations) GROUP BY ALL) b
LEFT JOIN (SELECT car_plate, window_start FROM ledger WHERE lane_id = 1) s
  ON b.car_plate = s.car_plate AND b.window_start = s.window_start
GROUP BY b.batch_id"""))
def batch_report(spark, sf):
    found = materialize(bed.violations(spark, sf), "violations")
    batch = found.select(
        F.dayofmonth("timestamp_start").cast("long").alias("_day"), "car_plate", "violation_type",
        S.window_start(F.col("timestamp_start"), 10).alias("window_start"),
    ).withColumn("batch_id", F.col("_day") % 6)
    return metrics.batch_report(batch, bed.ledger_of(found).where("lane_id = 1"), "batch_id")


_NEAREST = (
    "(SELECT us FROM (SELECT us, row_number() OVER (ORDER BY us) - 1 AS r, count(*) OVER () AS n FROM {0}) "
    "WHERE r = least(n - 1, CAST({1} AS BIGINT))) / CAST(1000000 AS DOUBLE)"
)


@query("a7_latency_summary", with_views(f"""
SELECT count(*) AS n, min(us) / CAST(1000000 AS DOUBLE) AS min_s, avg(us) / CAST(1000000 AS DOUBLE) AS mean_s,
       max(us) / CAST(1000000 AS DOUBLE) AS max_s,
       {_NEAREST.format('delays', 'round_even(CAST(0.5 AS DOUBLE) * (n - 1), 0)')} AS p50_s,
       {_NEAREST.format('delays', 'round_even(CAST(0.95 AS DOUBLE) * (n - 1), 0)')} AS p95_s,
       {_NEAREST.format('delays', 'round_even(CAST(0.99 AS DOUBLE) * (n - 1), 0)')} AS p99_s
FROM delays"""))
def latency_summary(spark, sf):
    return metrics.latency_summary(bed.ledger_table(spark, sf))


@query("a7_latency_median", with_views("""
SELECT (min(us) / CAST(1000000 AS DOUBLE) + max(us) / CAST(1000000 AS DOUBLE)) / 2 AS median_s
FROM (SELECT us, row_number() OVER (ORDER BY us) - 1 AS r, count(*) OVER () AS n FROM delays)
WHERE r IN ((n - 1) // 2, n // 2)"""))
def latency_median(spark, sf):
    return metrics.latency_median(bed.ledger_table(spark, sf))


@query("w7_percentiles_floor_rank", with_views(f"""
SELECT {_NEAREST.format('(SELECT us FROM delays_all WHERE us >= 0)', 'floor(CAST(0.5 AS DOUBLE) * n)')} AS p50_s,
       {_NEAREST.format('(SELECT us FROM delays_all WHERE us >= 0)', 'floor(CAST(0.95 AS DOUBLE) * n)')} AS p95_s"""))
def percentiles_floor(spark, sf):
    return metrics.latency_percentiles_floor(bed.ledger_table(spark, sf))


@query("w7_event_value_percentiles", """
WITH v AS (SELECT CAST(round(value * 1000000) AS BIGINT) AS us FROM events)
SELECT (SELECT us FROM (SELECT us, row_number() OVER (ORDER BY us) - 1 AS r, count(*) OVER () AS n FROM v)
        WHERE r = CAST(round_even(CAST(0.9 AS DOUBLE) * (n - 1), 0) AS BIGINT)) AS p90,
       (SELECT us FROM (SELECT us, row_number() OVER (ORDER BY us) - 1 AS r, count(*) OVER () AS n FROM v)
        WHERE r = CAST(round_even(CAST(0.1 AS DOUBLE) * (n - 1), 0) AS BIGINT)) AS p10""")
def value_percentiles(spark, sf):
    """Nearest ranks of a measured column of the events table itself."""
    micro = F.round(F.col("value") * 1_000_000).cast("long").alias("us")
    return values_at_ranks(
        bed.table(spark, sf, "events").select(micro), "us", {"p90": nearest_rank(0.9), "p10": nearest_rank(0.1)}
    )


@query("a10_latency_histogram", with_views("""
SELECT b.bin, (lo + b.bin * (hi - lo) / CAST(30 AS DOUBLE)) / CAST(1000000 AS DOUBLE) AS from_s, coalesce(c.n, 0) AS n
FROM (SELECT unnest(generate_series(0, 29)) AS bin) b
JOIN (SELECT min(us) AS lo, max(us) AS hi FROM delays) m ON true
LEFT JOIN (SELECT least((us - lo) * 30 // (hi - lo), 29) AS bin, count(*) AS n
           FROM delays JOIN (SELECT min(us) AS lo, max(us) AS hi FROM delays) ON true GROUP BY ALL) c ON b.bin = c.bin"""))
def latency_histogram(spark, sf):
    return metrics.latency_histogram(bed.ledger_table(spark, sf))


@query("a8_throughput", with_views("""
SELECT count(*) AS violations, count(*) FILTER (violation_type = 'INSTANTANEOUS') AS instant,
       count(*) FILTER (violation_type = 'AVERAGE') AS average,
       (epoch_us(max(detected_at)) - epoch_us(TIMESTAMP '2024-01-20 12:00:00')) / CAST(1000000 AS DOUBLE) AS drain_s,
       (SELECT count(*) FROM crossings)
         / ((epoch_us(max(detected_at)) - epoch_us(TIMESTAMP '2024-01-20 12:00:00')) / CAST(1000000 AS DOUBLE)) AS events_per_s
FROM ledger WHERE detected_at >= TIMESTAMP '2024-01-20 12:00:00'"""))
def throughput(spark, sf):
    n = bed.crossings(spark, sf).agg(F.count(F.lit(1)).alias("n")).scalar()
    return metrics.throughput(bed.ledger(spark, sf), F.lit(_NOW).cast("timestamp"), n)


@query("a9_run_rates", with_views("""
SELECT violations, first_detected, last_detected, window_s,
       (SELECT count(*) FROM crossings) / window_s AS events_per_s, violations / window_s AS violations_per_s
FROM (SELECT count(*) AS violations, min(detected_at) AS first_detected, max(detected_at) AS last_detected,
             greatest(CAST(1e-9 AS DOUBLE), (epoch_us(max(detected_at)) - epoch_us(min(detected_at))) / CAST(1000000 AS DOUBLE)) AS window_s
      FROM ledger)"""))
def run_rates(spark, sf):
    n = bed.crossings(spark, sf).agg(F.count(F.lit(1)).alias("n")).scalar()
    return metrics.run_rates(bed.ledger(spark, sf), n)


_JOURNEYS = """
WITH t AS (SELECT event_id, ts, CAST([3, 5, 10, 15][event_id % 4 + 1] AS BIGINT) AS k FROM events),
c AS (SELECT concat('C', CAST(event_id AS VARCHAR)) AS plate, k, i, ts + i * INTERVAL 30 SECOND AS at
      FROM (SELECT *, unnest(generate_series(0, k - 1)) AS i FROM t)),
pairs AS (SELECT a.k, a.i AS i, b.i AS j FROM c a JOIN c b ON a.plate = b.plate AND b.at > a.at
          AND b.at <= a.at + INTERVAL 10 MINUTE),
counts AS (SELECT k, 'adjacent' AS strategy, count(*) AS join_rows FROM pairs WHERE abs(j - i) = 1 GROUP BY k
           UNION ALL SELECT k, 'all-pairs', count(*) FROM pairs WHERE i <> j GROUP BY k),
v AS (SELECT k, count(*) AS vehicles FROM t GROUP BY k)
SELECT k, vehicles, strategy, join_rows,
       CASE WHEN strategy = 'adjacent' THEN vehicles * (k - 1) ELSE vehicles * k * (k - 1) // 2 END AS expected_rows,
       join_rows / CAST(max(join_rows) FILTER (strategy = 'adjacent') OVER (PARTITION BY k) AS DOUBLE) AS surplus
FROM counts JOIN v USING (k)"""


@query("a11_join_cost", _JOURNEYS)
def join_cost(spark, sf):
    """Each event is one journey past 3, 5, 10 or 15 cameras, 30 seconds and one kilometre apart."""
    k = F.element_at(F.array(*[F.lit(n).cast("long") for n in (3, 5, 10, 15)]), (F.col("event_id") % 4 + 1).cast("int"))
    journeys = bed.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("t0"), k.alias("k"))
    i = F.col("i").cast("int")
    crossings = journeys.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("k") - 1))).select(
        F.concat(F.lit("C"), F.col("event_id")).alias("car_plate"),
        F.col("k").cast("int").alias("lane_id"),
        (i + 1).alias("camera_id"),
        i.alias("camera_index"),
        (i + 1).cast("double").alias("position_km"),
        F.lit(90.0).alias("speed_limit"),
        F.timestamp_micros(F.unix_micros("t0") + i.cast("long") * 30_000_000).alias("event_time"),
        F.lit(80.0).alias("speed_reading"),
    )
    vehicles = journeys.groupBy("k").agg(F.count(F.lit(1)).alias("vehicles"))
    lanes = vehicles.select("k", F.col("k").cast("int").alias("lane_id"))
    return metrics.join_cost(crossings, vehicles, lanes)


@query("w8_latest_per_key", with_views(f"""
SELECT {_UNIFIED}, detected_at FROM (
  SELECT *, row_number() OVER (PARTITION BY lane_id, violation_type ORDER BY detected_at DESC, car_plate DESC) AS rn FROM ledger)
WHERE rn = 1"""))
def latest_per_key(spark, sf):
    newest = metrics.latest_per_key(bed.ledger(spark, sf), ["lane_id", "violation_type"], ["detected_at", "car_plate"])
    return newest.select(*VIOLATION_COLUMNS, "detected_at")


# --- the live picture -----------------------------------------------------------------------

_LIVE = f"""
SELECT car_plate, event_time AS last_seen, camera_id, lane_id, position_km, speed_reading, speed_reading > speed_limit AS over
FROM (SELECT *, row_number() OVER (PARTITION BY car_plate ORDER BY event_time DESC, camera_id DESC, lane_id DESC) AS rn
      FROM crossings WHERE event_time <= TIMESTAMP '{_NOW}')
WHERE rn = 1 AND event_time >= TIMESTAMP '{_NOW}' - INTERVAL 6 HOUR"""


def _vehicles(spark, sf):
    return live.live_vehicles(bed.crossings(spark, sf), F.lit(_NOW).cast("timestamp"), _ROAD_TTL_S)


@query("t8_live_vehicles", with_views(_LIVE))
def live_vehicles(spark, sf):
    return _vehicles(spark, sf)


@query("t9_camera_pulse", with_views(f"""
SELECT camera_id, max(event_time) AS last_crossed FROM crossings
WHERE event_time BETWEEN TIMESTAMP '{_NOW}' - INTERVAL 1 HOUR AND TIMESTAMP '{_NOW}' GROUP BY camera_id"""))
def camera_pulse(spark, sf):
    return live.camera_pulse(bed.crossings(spark, sf), F.lit(_NOW).cast("timestamp"), 3600.0)


@query("a16_vehicles_in_segment", with_views(f"SELECT lane_id, count(*) AS vehicles FROM ({_LIVE}) GROUP BY lane_id"))
def vehicles_in_segment(spark, sf):
    return live.vehicles_in_segment(_vehicles(spark, sf))


@query("j11_mark_active_vehicles", with_views(f"""
SELECT v.*, CASE WHEN k.avg THEN 'AVERAGE' WHEN k.car_plate IS NOT NULL OR v.over THEN 'INSTANTANEOUS' END AS violation_type
FROM ({_LIVE}) v LEFT JOIN (
  SELECT car_plate, bool_or(violation_type = 'AVERAGE') AS avg FROM (
    SELECT * FROM ledger WHERE detected_at < TIMESTAMP '{_NOW}' {_NEWEST} LIMIT 12) GROUP BY car_plate) k
  ON v.car_plate = k.car_plate"""))
def mark_active_vehicles(spark, sf):
    past = bed.ledger(spark, sf).where(F.col("detected_at") < F.lit(_NOW).cast("timestamp"))
    return live.mark_active_vehicles(_vehicles(spark, sf), past)
