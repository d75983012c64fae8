"""Default parameters. Every operator takes them as arguments; nothing reads the environment."""

from __future__ import annotations

# Defaults of the enforcement domain.
WATERMARK = "10 minutes"
JOIN_WINDOW = "10 minutes"
DEDUP_WINDOW = "10 minutes"
CAMERA_SPACING_KM = 1.0
EMPTY_LANE_LIMIT = 100.0
MIN_CAMERAS_PER_LANE = 2
PAGE_LIMIT_MAX = 500
FEED_LENGTH = 60
LANE_QUEUE_LENGTH = 90
MARKED_VIOLATIONS = 12
LATENCY_CAP_S = 660.0
LATENCY_BINS = 30
VEHICLE_TTL_S = 6.5
CAMERA_PULSE_S = 0.8

INSTANTANEOUS = "INSTANTANEOUS"
AVERAGE = "AVERAGE"
VIOLATION_TYPES = (INSTANTANEOUS, AVERAGE)

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def duration_seconds(text: str) -> int:
    """Whole seconds of a duration such as ``"10 minutes"`` or ``"1 hour"``."""
    amount, unit = text.split()
    name = unit.lower().rstrip("s")
    if name not in _UNIT_SECONDS:
        raise ValueError(f"unknown duration unit {unit!r} in {text!r}")
    return int(amount) * _UNIT_SECONDS[name]


def duration_minutes(text: str) -> int:
    """Whole minutes of a duration; ``"1 hour"`` is 60, units are honoured."""
    return duration_seconds(text) // 60
