"""The testbed views in SQL, and a builder that puts the needed ones in front of a query."""

from __future__ import annotations

import re

_UNIFIED = (
    "car_plate, lane_id, violation_type, camera_id_start, camera_id_end, position_start_km, position_end_km, "
    "timestamp_start, timestamp_end, speed_limit, speed_reading, avg_speed"
)


def _average(pair: str, source: str = "crossings") -> str:
    return f"""
SELECT * FROM (
  SELECT a.car_plate, a.lane_id, 'AVERAGE' AS violation_type,
         a.camera_id AS camera_id_start, b.camera_id AS camera_id_end,
         a.position_km AS position_start_km, b.position_km AS position_end_km,
         a.event_time AS timestamp_start, b.event_time AS timestamp_end,
         b.speed_limit, CAST(NULL AS DOUBLE) AS speed_reading,
         abs(b.position_km - a.position_km) * CAST(3600 AS DOUBLE)
           / date_diff('second', a.event_time, b.event_time) AS avg_speed
  FROM {source} a JOIN {source} b
    ON a.car_plate = b.car_plate AND a.lane_id = b.lane_id AND {pair}
   AND b.event_time > a.event_time AND b.event_time <= a.event_time + INTERVAL 10 MINUTE
  WHERE date_diff('second', a.event_time, b.event_time) > 0)
WHERE avg_speed > speed_limit"""


def _window_start(ts: str) -> str:
    return f"date_trunc('hour', {ts}) + CAST(minute({ts}) // 10 * 10 AS INTEGER) * INTERVAL 1 MINUTE"


VIEWS = {
    "lanes": """
SELECT * FROM (VALUES (1, 'North Highway'), (2, 'Coastal Expressway'), (3, 'City Bypass')) AS v(lane_id, name)""",
    "cameras": """
SELECT camera_id, lane_id, CAST(position_km AS DOUBLE) AS position_km, CAST(speed_limit AS DOUBLE) AS speed_limit
FROM (VALUES (1,1,1,90), (2,1,2,90), (3,1,3,90), (4,2,1,100), (5,2,2,100), (6,2,3,100), (7,3,1,80), (8,3,2,80), (9,3,3,80))
  AS v(camera_id, lane_id, position_km, speed_limit)""",
    "trips": """
SELECT event_id AS trip_id, concat('P', CAST(user_id AS VARCHAR)) AS car_plate, ts AS start_time,
       CAST(event_id % 3 + 1 AS INTEGER) AS lane_id,
       CASE WHEN event_id % 10 < 7 THEN 'normal' WHEN event_id % 10 < 9 THEN 'speeder' ELSE 'sneaky' END AS behavior,
       CAST((CASE WHEN event_id % 10 < 7 THEN 70 WHEN event_id % 10 < 9 THEN 115 ELSE 120 END)
            + (event_id * 7) % 26 AS DOUBLE) / 100 AS f
FROM events""",
    "crossings": """
SELECT t.trip_id, t.trip_id * 10 + c.camera_id AS event_id, t.car_plate, c.lane_id, c.camera_id,
       CAST(row_number() OVER (PARTITION BY t.trip_id ORDER BY c.position_km) - 1 AS INTEGER) AS camera_index,
       c.position_km, c.speed_limit,
       t.start_time + CAST(round((c.position_km - 1) * CAST(3600000 AS DOUBLE) / (t.f * c.speed_limit)) AS BIGINT)
         * INTERVAL 1 MILLISECOND AS event_time,
       round(CASE WHEN t.behavior = 'normal' THEN least(t.f * c.speed_limit, c.speed_limit - 1)
                  WHEN t.behavior = 'speeder' THEN t.f * c.speed_limit + 1
                  ELSE CAST(0.9 AS DOUBLE) * c.speed_limit END, 1) AS speed_reading,
       t.behavior
FROM trips t JOIN cameras c ON t.lane_id = c.lane_id""",
    "crowded": """
SELECT * REPLACE (concat('C', CAST(trip_id % 2 AS VARCHAR)) AS car_plate,
  TIMESTAMP '2024-01-01' + to_microseconds((epoch_us(event_time) - epoch_us(TIMESTAMP '2024-01-01')) // 20) AS event_time)
FROM crossings""",
    "hot": """
SELECT * REPLACE (CASE WHEN trip_id % 3 = 0 THEN 'HOT' ELSE car_plate END AS car_plate,
  TIMESTAMP '2024-01-01' + to_microseconds((epoch_us(event_time) - epoch_us(TIMESTAMP '2024-01-01')) // 20) AS event_time)
FROM crossings""",
    "avg_hot": _average("abs(b.camera_index - a.camera_index) = 1", "hot"),
    "inst": """
SELECT car_plate, lane_id, 'INSTANTANEOUS' AS violation_type, camera_id AS camera_id_start, camera_id AS camera_id_end,
       position_km AS position_start_km, position_km AS position_end_km,
       event_time AS timestamp_start, event_time AS timestamp_end,
       speed_limit, speed_reading, CAST(NULL AS DOUBLE) AS avg_speed
FROM crossings WHERE speed_reading > speed_limit""",
    "avg_adj": _average("abs(b.camera_index - a.camera_index) = 1"),
    "avg_all": _average("a.camera_index <> b.camera_index"),
    "violations": "SELECT * FROM inst UNION ALL SELECT * FROM avg_adj",
    "first_rows": f"""
SELECT {_UNIFIED}, window_start FROM (
  SELECT *, row_number() OVER (PARTITION BY car_plate, window_start ORDER BY timestamp_start, violation_type,
                               timestamp_end, camera_id_start, camera_id_end) AS rn
  FROM (SELECT *, {_window_start('timestamp_start')} AS window_start FROM violations))
WHERE rn = 1""",
    "ledger": f"""
SELECT {_UNIFIED}, window_start, CAST(date_trunc('day', timestamp_start) AS TIMESTAMP) AS date,
       timestamp_end + CAST(500 + ((epoch_us(timestamp_end) // 1000) * 7919 + camera_id_end * 31) % 2500
         + CASE WHEN (epoch_us(timestamp_end) // 1000) % 97 = 0 THEN 700000
                WHEN (epoch_us(timestamp_end) // 1000) % 101 = 0 THEN -5000 ELSE 0 END AS BIGINT)
         * INTERVAL 1 MILLISECOND AS detected_at
FROM first_rows""",
    "cars": """
SELECT concat('P', CAST(c_custkey AS VARCHAR)) AS car_plate, c_name AS owner_name,
       concat('Nation ', CAST(c_nationkey AS VARCHAR)) AS owner_addr, lower(c_mktsegment) AS vehicle_type,
       concat('2020-01-', lpad(CAST(c_custkey % 28 + 1 AS VARCHAR), 2, '0')) AS registration_date
FROM customer""",
    "net_lanes": "SELECT CAST(s_suppkey + 1 AS INTEGER) AS lane_id, s_name AS name FROM supplier",
    "net_cameras": """
SELECT CAST(p_partkey + 1 AS INTEGER) AS camera_id, CAST(p_partkey // 25 + 1 + handed AS INTEGER) AS lane_id,
       round((p_partkey % 25) * CAST(0.75 AS DOUBLE) + 1 + handed * CAST(18.75 AS DOUBLE), 3) AS position_km,
       CAST(p_size % 7 * 10 + 60 AS DOUBLE) AS speed_limit
FROM (SELECT *, CASE WHEN p_partkey // 25 % 4 = 0 AND p_size > 3 THEN 1 ELSE 0 END AS handed FROM part)""",
    "requests": """
SELECT o_orderkey AS request_id,
       CAST(o_custkey // 15 + 1 + CASE WHEN o_orderkey % 7 = 0 THEN 1000000 ELSE 0 END AS INTEGER) AS lane_id,
       CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(60 + o_orderkey % 5 * 10 AS DOUBLE) END AS speed_limit
FROM orders""",
    "lane_tally": """
SELECT lane_id, count(*) AS total, count(*) FILTER (violation_type = 'INSTANTANEOUS') AS instantaneous,
       count(*) FILTER (violation_type = 'AVERAGE') AS average
FROM ledger GROUP BY lane_id""",
    "summary": """
SELECT l.lane_id, l.name, coalesce(c.camera_count, 0) AS camera_count, coalesce(t.total, 0) AS total,
       coalesce(t.instantaneous, 0) AS instantaneous, coalesce(t.average, 0) AS average
FROM lanes l
LEFT JOIN (SELECT lane_id, count(*) AS camera_count FROM cameras GROUP BY lane_id) c ON l.lane_id = c.lane_id
LEFT JOIN lane_tally t ON l.lane_id = t.lane_id""",
    "delays_all": """
SELECT epoch_us(detected_at) - epoch_us(timestamp_end) AS us FROM ledger""",
    "delays": "SELECT us FROM delays_all WHERE us BETWEEN 0 AND 660000000",
    "segments": """
SELECT *, abs(next_position_km - position_km) AS distance_km, dt AS dt_seconds,
       CASE WHEN dt > 0 THEN abs(next_position_km - position_km) * CAST(3600 AS DOUBLE) / dt END AS segment_speed
FROM (SELECT *, (epoch_us(next_event_time) - epoch_us(event_time)) / CAST(1000000 AS DOUBLE) AS dt FROM (
  SELECT *, lead(camera_id) OVER w AS next_camera_id, lead(position_km) OVER w AS next_position_km,
         lead(speed_limit) OVER w AS next_speed_limit, lead(event_time) OVER w AS next_event_time
  FROM crossings WINDOW w AS (PARTITION BY trip_id ORDER BY event_time, camera_index)))""",
    "gap_trips": """
SELECT *, max(CASE WHEN opens THEN event_time END)
            OVER (PARTITION BY car_plate, lane_id ORDER BY event_time, camera_index) AS trip_start
FROM (SELECT *, coalesce(epoch_us(event_time) - epoch_us(lag(event_time)
        OVER (PARTITION BY car_plate, lane_id ORDER BY event_time, camera_index)) > 600000000, true) AS opens
      FROM crossings)""",
    "trip_sums": """
SELECT trip_id, behavior, count(*) AS n_events, round_even(max(speed_reading), 1) AS max_spot,
       round_even(coalesce(max(segment_speed), 0), 1) AS max_avg,
       bool_or(speed_reading > speed_limit) AS expect_instantaneous,
       bool_or(coalesce(segment_speed > next_speed_limit, false)) AS expect_average
FROM segments GROUP BY trip_id, behavior""",
}


def with_views(body: str) -> str:
    """``body`` behind the views it names, each after the ones it names itself."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                visit(VIEWS[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body.strip()
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in needed)
    return f"WITH {ctes}\n{body.strip()}"
