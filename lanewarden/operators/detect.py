"""Violation detection over crossings, for tables and for streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewarden.functions.scalars import seconds_between, segment_speed
from lanewarden.functions.timeline import SLICE, slice_of, slices_reached
from lanewarden.schemas import VIOLATION, VIOLATION_COLUMNS
from lanewarden.settings import AVERAGE, INSTANTANEOUS, JOIN_WINDOW, duration_seconds

# The order that decides which of several violations is the first.
FIRST_ORDER = ["timestamp_start", "violation_type", "timestamp_end", "camera_id_start", "camera_id_end"]

ADJACENT = "adjacent"
ALL_PAIRS = "all-pairs"


def _second_camera(strategy: str, first: Column, second: Column) -> Column:
    if strategy == ADJACENT:
        return F.abs(second - first) == 1
    if strategy == ALL_PAIRS:
        return first != second
    raise ValueError(f"unknown join strategy {strategy!r}; expected one of {[ADJACENT, ALL_PAIRS]}")


def to_unified(df: DataFrame, kind: str) -> DataFrame:
    """The shared violation shape; columns the detector does not have become typed nulls."""
    typed = df.withColumn("violation_type", F.lit(kind))
    present = set(typed.columns)
    return typed.select(
        *[
            F.col(f.name) if f.name in present else F.lit(None).cast(f.dataType).alias(f.name)
            for f in VIOLATION.fields
        ]
    )


def detect_instantaneous(events: DataFrame) -> DataFrame:
    """Crossings read over their own camera's limit. One row per offending crossing, no shuffle.

    On a stream the test mentions the event time, so that it is not moved below the watermark:
    legal crossings must advance event time too.
    """
    speeding = F.col("speed_reading") > F.col("speed_limit")
    if events.isStreaming:
        offences = events.where(F.when(speeding, F.col("event_time")).isNotNull())
    else:
        offences = events.where(speeding & F.col("event_time").isNotNull())
    return to_unified(
        offences.select(
            "car_plate",
            "lane_id",
            F.col("camera_id").alias("camera_id_start"),
            F.col("camera_id").alias("camera_id_end"),
            F.col("position_km").alias("position_start_km"),
            F.col("position_km").alias("position_end_km"),
            F.col("event_time").alias("timestamp_start"),
            F.col("event_time").alias("timestamp_end"),
            "speed_limit",
            "speed_reading",
        ),
        INSTANTANEOUS,
    )


# Cells of plate, lane and slice that are split: at most so many, from so many rows on, into so many salts.
HOT_CELLS = 256
HOT_CELL_ROWS = 5_000
MOST_SALTS = 32
_TRACKED = 8_192


def _cell(slice_start: Column) -> Column:
    return F.xxhash64("car_plate", "lane_id", slice_start)


def hot_cells(events: DataFrame, width_s: int, fine_s: int, rows: int = HOT_CELL_ROWS) -> DataFrame:
    """``_cell, _salts`` of the cells (plate, lane and slice of time) that hold more than ``rows`` rows.

    One map-side sketch of bounded size finds the most frequent cells, so there are at most
    :data:`HOT_CELLS`. A hash names a cell: two that share one are merely both split. ``_salts`` is how many
    keys each fine slice of a cell is spread over, at most in proportion to the cell's share of all rows: each salt
    copies the earlier side once more, and the other cells keep other tasks busy.
    """
    known = events.dropna(subset=["car_plate", "lane_id", "event_time"])
    sketch = known.select(_cell(slice_of(F.col("event_time"), width_s)).alias("cell")).agg(
        F.expr(f"approx_top_k(cell, {HOT_CELLS}, {_TRACKED})").alias("top"), F.count(F.lit(1)).alias("n")
    )
    per_slice = F.ceil(F.col("count") * fine_s / (width_s * rows))
    by_share = F.ceil(F.col("count") * MOST_SALTS / F.col("n"))
    found = sketch.select("n", F.inline("top")).where(F.col("count") > rows)
    salts = F.least(F.lit(MOST_SALTS), per_slice, by_share).cast("int")
    return found.select(F.col("item").alias("_cell"), salts.alias("_salts"))


def lane_reach(events: DataFrame, later: DataFrame, strategy: str, span_s: int) -> DataFrame:
    """``lane_id, _reach``: seconds after which no later crossing of the lane can end an offending segment.

    A segment is over a limit only while it takes less than its length at that limit, so the longest segment of
    the lane and its least limit bound the time; ``span_s`` is the bound where they say nothing. One row per
    lane, from one row per camera.
    """
    columns = ["lane_id", "camera_index", "position_km", "speed_limit"]
    both = events.select(columns) if later is events else events.select(columns).unionByName(later.select(columns))
    keys = ["lane_id", "camera_index"] if strategy == ADJACENT else ["lane_id"]
    seen = both.dropna(subset=["lane_id", "camera_index"]).groupBy(*keys).agg(
        F.min("position_km").alias("low"), F.max("position_km").alias("high"), F.min("speed_limit").alias("limit")
    )
    length, limit, paired = F.col("high") - F.col("low"), F.col("limit"), F.lit(True)
    if strategy == ADJACENT:
        order = Window.partitionBy("lane_id").orderBy("camera_index")
        following = {c: F.lead(c).over(order) for c in ("camera_index", "low", "high", "limit")}
        seen = seen.select("*", *[c.alias(f"next_{n}") for n, c in following.items()])
        length = F.greatest(F.col("next_high") - F.col("low"), F.col("high") - F.col("next_low"))
        limit, paired = F.least("limit", "next_limit"), F.col("next_camera_index") == F.col("camera_index") + 1
    seconds = F.try_divide(F.abs(length) * F.lit(3600.0), limit)
    told = (limit > 0) & ~F.isnan(seconds)
    # Whole seconds of a difference may be one less than the time between.
    reach = F.when(told, F.least(F.lit(float(span_s)), F.ceil(F.least(seconds, F.lit(1e9))) + 2)).otherwise(F.lit(float(span_s)))
    return seen.groupBy("lane_id").agg(F.coalesce(F.max(F.when(paired, reach)), F.lit(0.0)).cast("int").alias("_reach"))


def join_sides(
    events: DataFrame, later: DataFrame | None = None, *, window: str = JOIN_WINDOW, slice_width: str | None = None,
    hot_plates: Sequence[str] = (), hot_splits: int = 4, split_hot: bool = True, hot_cell_rows: int = HOT_CELL_ROWS,
    strategy: str = ADJACENT,
) -> tuple[DataFrame, DataFrame, list[str]]:
    """The earlier and the later crossings of :func:`offending_segments`, and the keys on which they meet."""
    later = events if later is None else later
    span = duration_seconds(window)
    width = duration_seconds(slice_width) if slice_width else 6 * span
    fine = max(1, span // 6)
    hot = F.col("car_plate").isin(list(hot_plates))
    reached = F.when(hot, fine).otherwise(width) if hot_plates else width
    first = events.select(
        "car_plate", "lane_id", "camera_id", "camera_index", "position_km", "event_time",
        F.explode(slices_reached(F.col("event_time"), 0, span, reached)).alias(SLICE),
    )
    second = later.select(
        "car_plate", "lane_id", "camera_id", "camera_index", "position_km", "speed_limit", "event_time",
        slice_of(F.col("event_time"), reached).alias(SLICE),
    )
    keys = ["car_plate", "lane_id", SLICE]
    salt = F.xxhash64("event_time", "camera_id")
    if hot_plates:
        salts = F.when(hot, F.sequence(F.lit(0), F.lit(hot_splits - 1))).otherwise(F.array(F.lit(0)))
        first = first.withColumn("_salt", F.explode(salts))
        second = second.withColumn("_salt", F.when(hot, F.pmod(salt, F.lit(hot_splits)).cast("int")).otherwise(0))
        keys.append("_salt")
    elif split_hot and not events.isStreaming:
        cells = F.broadcast(hot_cells(events, width, fine, hot_cell_rows))
        lanes = F.broadcast(lane_reach(events, later, strategy, span))
        first = first.withColumn("_cell", _cell(F.col(SLICE))).join(cells, "_cell", "left").join(lanes, "lane_id", "left")
        second = second.withColumn("_cell", _cell(F.col(SLICE))).join(cells, "_cell", "left").join(lanes, "lane_id", "left")
        # Two parts reach as far as a segment can, so a crossing meets hardly more than it can pair with.
        at, step = F.unix_micros("event_time"), F.greatest(F.lit(1), F.floor(F.col("_reach") / 2)) * 1_000_000
        low = F.greatest(at, F.col(SLICE))
        high = F.least(at + F.col("_reach").cast("long") * 1_000_000, F.col(SLICE) + width * 1_000_000 - 1)
        split = F.col("_salts").isNotNull()
        none = F.array(F.lit(0).cast("long"))
        # Copies in a slice that lies beyond the reach meet nothing.
        parts = F.when(split & (low > high), F.array().cast("array<long>")).when(
            split, F.sequence(low - F.pmod(low, step), high - F.pmod(high, step), step)
        ).otherwise(none)
        salts = F.when(split, F.sequence(F.lit(0), F.col("_salts") - 1)).otherwise(F.array(F.lit(0)))
        first = first.withColumn("_part", F.explode(parts)).withColumn("_salt", F.explode(salts))
        second = second.withColumn("_part", F.when(split, at - F.pmod(at, step)).otherwise(0))
        second = second.withColumn("_salt", F.when(split, F.pmod(salt, F.col("_salts")).cast("int")).otherwise(0))
        if strategy == ADJACENT:
            index = F.col("camera_index")
            first = first.withColumn("_to", F.explode(F.when(split, F.array(index - 1, index + 1)).otherwise(F.array(F.lit(0)))))
            second = second.withColumn("_to", F.when(split, index).otherwise(0))
            keys.append("_to")
        keys += ["_part", "_salt"]
    return first, second, keys


def offending_segments(
    events: DataFrame,
    strategy: str = ADJACENT,
    *,
    later: DataFrame | None = None,
    window: str = JOIN_WINDOW,
    slice_width: str | None = None,
    hot_plates: Sequence[str] = (),
    hot_splits: int = 4,
    split_hot: bool = True,
    hot_cell_rows: int = HOT_CELL_ROWS,
) -> DataFrame:
    """Segments whose average speed is over the limit of the camera reached second.

    ``steps`` is how many cameras along the lane the segment spans.

    Each crossing pairs with the later ones of the same plate and lane within ``window``, at a
    neighbouring camera (``adjacent``) or any other camera (``all-pairs``). One row per pair.

    The join has three equality keys: plate, lane and a slice of event time. The later crossing
    sits in its own slice, the earlier one is copied into the slices its window reaches, so a pair
    meets exactly once and a long history is never compared with itself as a whole. Slices are six
    windows wide by default, which copies one earlier crossing in six.

    In a table, slices of a plate that hold over ``hot_cell_rows`` rows are found by :func:`hot_cells` and cut into fine
    slices of half the lane's reach (see :func:`lane_reach`), so that each crossing meets hardly more than those it
    can pair with, at a neighbouring camera alone for ``adjacent``; those that hold a large share of all rows are
    spread over salted keys. A stream cannot look ahead: there ``hot_plates`` (see
    :func:`frequent_plates`) names the plates that are cut so, with ``hot_splits`` salts each, for the life of
    its checkpoint. Neither changes which rows come out.

    With ``later``, the crossing reached second is one of that frame; hot cells are those of ``events``.
    """
    span = duration_seconds(window)
    first, second, keys = join_sides(
        events, later, window=window, slice_width=slice_width, hot_plates=hot_plates, hot_splits=hot_splits, split_hot=split_hot,
        hot_cell_rows=hot_cell_rows, strategy=strategy,
    )
    a, b = first.alias("a"), second.alias("b")
    start, end = F.col("a.event_time"), F.col("b.event_time")
    same_journey = (
        _second_camera(strategy, F.col("a.camera_index"), F.col("b.camera_index"))
        & (end > start)
        & (end <= start + F.expr(f"interval {span} seconds"))
    )
    for key in keys:
        same_journey = (F.col(f"a.{key}") == F.col(f"b.{key}")) & same_journey
    dt = seconds_between(start, end)
    limit = F.col("b.speed_limit")
    speed = segment_speed(F.abs(F.col("b.position_km") - F.col("a.position_km")), dt)
    # One condition, cheapest tests first: most candidates fail on camera or time, before a division.
    return a.join(b, same_journey & (dt > 0) & (speed > limit)).select(
        F.col("a.car_plate").alias("car_plate"),
        F.col("a.lane_id").alias("lane_id"),
        F.col("a.camera_id").alias("camera_id_start"),
        F.col("b.camera_id").alias("camera_id_end"),
        F.col("a.position_km").alias("position_start_km"),
        F.col("b.position_km").alias("position_end_km"),
        start.alias("timestamp_start"),
        end.alias("timestamp_end"),
        limit.alias("speed_limit"),
        speed.alias("avg_speed"),
        F.abs(F.col("b.camera_index") - F.col("a.camera_index")).alias("steps"),
    )


def detect_average(events: DataFrame, strategy: str = ADJACENT, **options) -> DataFrame:
    """The offending segments as violations; the options are those of :func:`offending_segments`."""
    return to_unified(offending_segments(events, strategy, **options), AVERAGE)


def frequent_plates(events: DataFrame, share: float = 0.01) -> list[str]:
    """Plates holding more than ``share`` of the crossings; at most ``1/share`` of them.

    One map-side sketch of bounded size, so the answer is small by construction. It only guides
    the placement of rows, never which rows are kept.
    """
    most = int(1 / share)
    sketch = events.agg(
        F.expr(f"approx_top_k(car_plate, {most}, {100 * most})").alias("top"), F.count("car_plate").alias("n")
    )
    hot = sketch.select("n", F.inline("top")).where(F.col("count") > F.col("n") * share)
    return [row["item"] for row in hot.select("item").collect()]


def all_violations(events: DataFrame, strategy: str = ADJACENT, **options) -> DataFrame:
    """Both detectors together, duplicates kept: one row per offence of either kind."""
    return detect_instantaneous(events).unionByName(detect_average(events, strategy, **options))


def first_of(violations: DataFrame, *keys: str | Column) -> DataFrame:
    """The first violation per key in the order start, type, end, cameras, then the other columns.

    Every task keeps only the first row per key before the shuffle, so one key never gathers more
    rows than there are tasks: a ranked limit on a table, a minimum over a struct on a stream.
    Returns the violation with its keys: a name is a column as it is, so filters on it pass below the
    ranking; an expression at place ``i`` is ``_key{i}``.
    """
    rest = [c for c in VIOLATION_COLUMNS if c not in FIRST_ORDER]
    names = [k if isinstance(k, str) else f"_key{i}" for i, k in enumerate(keys)]
    made = [k.alias(n) for k, n in zip(keys, names) if not isinstance(k, str)]
    keyed = violations.select("*", *made)
    if violations.isStreaming:
        least = keyed.groupBy(*names).agg(F.min(F.struct(*FIRST_ORDER, *rest)).alias("_first"))
        body = [F.col(f"_first.{c}").alias(c) for c in VIOLATION_COLUMNS]
        return least.select(*[n for n in names if n not in VIOLATION_COLUMNS], *body)
    ranked = Window.partitionBy(*names).orderBy(*FIRST_ORDER, *rest)
    return keyed.withColumn("_rank", F.row_number().over(ranked)).where(F.col("_rank") == 1).drop("_rank")


def build_violations(events: DataFrame, strategy: str = ADJACENT, **options) -> DataFrame:
    """One violation per plate over the whole input table: the first of either kind."""
    return first_of(all_violations(events, strategy, **options), "car_plate").select(VIOLATION_COLUMNS)


def compare_plates(left: DataFrame, right: DataFrame) -> DataFrame:
    """Plates found in only one of two frames, with the side that has them.

    Both sides are tagged, united and reduced per plate, which combines before its one shuffle.
    """
    tagged = left.select("car_plate", F.lit(True).alias("l"), F.lit(False).alias("r")).unionByName(
        right.select("car_plate", F.lit(False).alias("l"), F.lit(True).alias("r"))
    )
    sides = tagged.groupBy("car_plate").agg(F.bool_or("l").alias("in_left"), F.bool_or("r").alias("in_right"))
    return sides.where(F.col("in_left") != F.col("in_right"))


def compare_strategies(events: DataFrame, **options) -> DataFrame:
    """Plates that one pairing strategy flags and the other does not.

    Neighbouring cameras are among all pairs, so one join serves both; a spot reading counts for
    either strategy.
    """
    spot = detect_instantaneous(events).select("car_plate", F.lit(True).alias("near"))
    segments = offending_segments(events, ALL_PAIRS, **options).select("car_plate", (F.col("steps") == 1).alias("near"))
    flags = segments.unionByName(spot).groupBy("car_plate").agg(
        F.bool_or("near").alias("flagged_adjacent"), F.lit(True).alias("flagged_all_pairs")
    )
    return flags.where(~F.col("flagged_adjacent"))


def same_plates(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: whether two frames hold the same set of plates, and how many differ."""
    return compare_plates(left, right).agg(
        F.count(F.lit(1)).alias("n_different"), (F.count(F.lit(1)) == 0).alias("same_plates")
    )
