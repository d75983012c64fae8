"""Fixed schemas of the enforcement data model."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampType()

# A camera event as it travels: JSON in the `value` column, keyed by plate.
WIRE_EVENT = _fields(
    ("event_id", _S), ("car_plate", _S), ("lane_id", _I), ("camera_id", _I), ("camera_index", _I),
    ("position_km", _D), ("speed_limit", _D), ("timestamp", _S), ("speed_reading", _D),
)

# The columns the detectors need from a parsed crossing.
CROSSING = _fields(
    ("car_plate", _S), ("lane_id", _I), ("camera_id", _I), ("camera_index", _I),
    ("position_km", _D), ("speed_limit", _D), ("event_time", _TS), ("speed_reading", _D),
)

VIOLATION = _fields(
    ("car_plate", _S), ("lane_id", _I), ("violation_type", _S),
    ("camera_id_start", _I), ("camera_id_end", _I),
    ("position_start_km", _D), ("position_end_km", _D),
    ("timestamp_start", _TS), ("timestamp_end", _TS),
    ("speed_limit", _D), ("speed_reading", _D), ("avg_speed", _D),
)
VIOLATION_COLUMNS = VIOLATION.fieldNames()

# The ledger row; `date` is the partition column, the UTC day of the start time.
STORED_VIOLATION = T.StructType(
    VIOLATION.fields
    + [
        T.StructField("window_start", _TS),
        T.StructField("detected_at", _TS),
        T.StructField("date", T.DateType()),
    ]
)
LEDGER_KEY = ["car_plate", "window_start"]

# The columns of the CSV export, in order.
EXPORT_COLUMNS = VIOLATION_COLUMNS + ["date", "detected_at"]

LANE = _fields(("lane_id", _I), ("name", _S))
CAMERA = _fields(("camera_id", _I), ("lane_id", _I), ("position_km", _D), ("speed_limit", _D))
CAR = _fields(
    ("car_plate", _S), ("owner_name", _S), ("owner_addr", _S),
    ("vehicle_type", _S), ("registration_date", _S),
)

# Replay files carry text; the columns are coerced after reading so that bad values become null.
REPLAY_CSV = _fields(("timestamp", _S), ("camera_id", _S), ("car_plate", _S), ("speed_reading", _S))

# The registry file spells its type column "vechicle_type".
REGISTRY_CSV = _fields(
    ("car_plate", _S), ("owner_name", _S), ("owner_addr", _S),
    ("vechicle_type", _S), ("registration_date", _S),
)
