"""Time slices: how unbounded per-vehicle histories are split across tasks.

A vehicle's history on a lane is unbounded, and one plate may own a large share of all crossings.
Every operator here looks at most a fixed span ahead or back, so a history can be cut into slices
of event time, with the rows near a border copied into the neighbouring slice. The slice is part of
the shuffle key; the results do not change.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SLICE = "_slice"
HOME = "_home"


def _micros(seconds: int | Column) -> Column:
    return (seconds if isinstance(seconds, Column) else F.lit(seconds)).cast("long") * 1_000_000


def slice_of(ts: Column, width_s: int | Column) -> Column:
    """Start, in epoch microseconds, of the slice holding ``ts``; the width may differ by row."""
    micros = F.unix_micros(ts)
    return micros - F.pmod(micros, _micros(width_s))


def slices_reached(ts: Column, back_s: int, ahead_s: int, width_s: int | Column) -> Column:
    """Starts of every slice that meets ``[ts - back, ts + ahead]``."""
    width, micros = _micros(width_s), F.unix_micros(ts)
    low, high = micros - _micros(back_s), micros + _micros(ahead_s)
    return F.sequence(low - F.pmod(low, width), high - F.pmod(high, width), width)


def with_slices(df: DataFrame, ts: str, *, back_s: int, ahead_s: int, width_s: int) -> DataFrame:
    """Copy each row into every slice its reach touches; ``_home`` marks the one it belongs to.

    With reach ``r`` and width ``w`` a row is copied ``1 + r/w`` times on average.
    """
    reached = slices_reached(F.col(ts), back_s, ahead_s, width_s)
    copied = df.withColumn(SLICE, F.explode(reached))
    return copied.withColumn(HOME, F.col(SLICE) == slice_of(F.col(ts), width_s))
