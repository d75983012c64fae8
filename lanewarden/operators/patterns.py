"""Row patterns over crossings: sequences of conditions on a vehicle's consecutive crossings of a lane.

A pattern is a list of steps. Each step names a condition; ``Step(..., repeat=True)`` matches one or more
crossings. A match is a run of consecutive crossings of one plate and lane, in the order of time and then
``camera_index``, that spells the steps, from its first crossing to its last within ``within``. From a
starting crossing the longest such run counts; matches are taken from left to right and do not overlap.

The steps are compiled to bits: bit ``i`` of a crossing's ``flags`` says that it meets step ``i``, and a state
of the automaton is the set of steps that the last crossing may stand for. One crossing moves it by
``((state << 1) | (state & repeating)) & flags``, so a run of any length is a fold of whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewarden.functions.scalars import seconds_between, segment_speed
from lanewarden.functions.timeline import HOME, SLICE, with_slices
from lanewarden.operators.chains import follow
from lanewarden.session import materialize
from lanewarden.settings import JOIN_WINDOW, duration_seconds

KEYS = ["car_plate", "lane_id"]
MOST_STEPS = 30


@dataclass(frozen=True)
class Step:
    """A condition (a column, or SQL text) on a crossing and the ``prev_`` columns of the one before, met by one
    crossing or, with ``repeat``, by one or more."""

    condition: Column | str
    repeat: bool = False


@dataclass(frozen=True)
class Automaton:
    """The compiled form: which bits repeat, and which one ends a match."""

    repeating: int
    final: int

    @staticmethod
    def of(steps: Sequence[Step]) -> Automaton:
        if not 1 <= len(steps) <= MOST_STEPS:
            raise ValueError(f"a pattern has 1 to {MOST_STEPS} steps")
        return Automaton(sum(1 << i for i, s in enumerate(steps) if s.repeat), 1 << (len(steps) - 1))


def longest_runs(at: np.ndarray, flags: np.ndarray, ends: np.ndarray, reach_us: int, automaton: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row that meets the first step: the row, the last row of its longest run (-1 if there is none), and
    whether the run is alive at the end of its rows, so that rows to come could lengthen it.

    Rows are in order; ``ends`` is the end of each row's history. All runs go on at once, one crossing at a time,
    so the work is the sum of the runs' lengths, whatever else lies within the reach.
    """
    starts = np.flatnonzero(flags & 1)
    last, alive = np.full(len(starts), -1), np.zeros(len(starts), bool)
    run, row, state = np.arange(len(starts)), starts, np.zeros(len(starts), np.int64)
    first = 1
    while len(run):
        state = ((state << 1) | first | (state & automaton.repeating)) & flags[row]
        accepts = (state & automaton.final) != 0
        last[run[accepts]] = row[accepts]
        row, first = row + 1, 0
        inside = row < ends[row - 1]
        alive[run[(state != 0) & ~inside]] = True
        on = (state != 0) & inside
        run, row, state = run[on], row[on], state[on]
        on = at[row] <= at[starts[run]] + reach_us
        run, row, state = run[on], row[on], state[on]
    return starts, last, alive


def group_ends(*keys: np.ndarray) -> np.ndarray:
    """For each row of sorted groups, the end of its group."""
    n = len(keys[0])
    new = np.zeros(max(n - 1, 0), bool)
    for key in keys:
        new |= key[1:] != key[:-1]
    borders = np.r_[np.flatnonzero(new) + 1, n]
    return np.repeat(borders, np.diff(np.r_[0, borders]))


def flags_of(steps: Sequence[Step]) -> Column:
    """The steps that a row meets, as bits; a condition that is null is not met."""
    flags = F.lit(0)
    for i, step in enumerate(steps):
        met = F.expr(step.condition) if isinstance(step.condition, str) else step.condition
        flags = flags.bitwiseOR(F.when(met, 1 << i).otherwise(0))
    return flags


def tie_break() -> list[Column]:
    """What orders crossings of one moment, in a table and in a stream alike."""
    return [F.col("camera_index"), F.xxhash64("camera_id", "position_km", "speed_limit", "speed_reading").alias("tie")]


def with_previous(rows: DataFrame, order: Window, reach_us: int) -> DataFrame:
    """Add ``prev_`` columns of the crossing before, and ``prev_segment_speed`` from it; null beyond the reach."""
    at = F.unix_micros("event_time")
    near = at - F.lag(at).over(order) <= reach_us
    names = ["camera_id", "camera_index", "position_km", "speed_limit", "event_time", "speed_reading"]
    seen = rows.select("*", *[F.when(near, F.lag(c).over(order)).alias(f"prev_{c}") for c in names])
    dt = seconds_between(F.col("prev_event_time"), F.col("event_time"))
    distance = F.abs(F.col("position_km") - F.col("prev_position_km"))
    return seen.withColumn("prev_segment_speed", F.when(dt > 0, segment_speed(distance, dt)))


def match_rows(events: DataFrame, steps: Sequence[Step], *, within: str = JOIN_WINDOW) -> DataFrame:
    """``car_plate, lane_id, match_start, match_end, n_rows`` of all matches in a table.

    Crossings are cut into slices of event time that overlap by ``within`` on both sides, so each crossing sees
    the one before it and all that a run from it can reach; a history is never one group. Which runs stand,
    once overlaps are taken out from left to right, is found by :func:`lanewarden.operators.chains.follow`.
    Crossings without a plate, lane or time take no part. Crossings equal in plate, lane, time and
    ``camera_index`` are ordered by a hash of their readings; a crossing repeated in all of these counts once.
    """
    automaton = Automaton.of(steps)
    reach = duration_seconds(within)
    us = reach * 1_000_000
    known = events.dropna(subset=[*KEYS, "event_time"])
    placed = known.withColumns({"_at": F.unix_micros("event_time"), "_pos": F.struct(F.unix_micros("event_time").alias("_at"), *tie_break())})
    sliced = with_slices(placed, "event_time", back_s=reach, ahead_s=reach, width_s=6 * reach)
    order = Window.partitionBy(*KEYS, SLICE).orderBy("_pos")
    once = sliced.repartition(*KEYS, SLICE).withColumn("_again", F.lag("_pos").over(order) == F.col("_pos")).where("not coalesce(_again, false)")
    flagged = with_previous(once, order, us).select(*KEYS, SLICE, HOME, "_at", "_pos", flags_of(steps).alias("_flags"))
    # Groups of plate, lane and slice follow one another whole, each in order.
    in_order = flagged.sortWithinPartitions(*KEYS, SLICE, "_pos")
    places = in_order.select(*KEYS, SLICE, HOME, "_at", "_flags", F.col("_pos.camera_index").alias("_index"), F.col("_pos.tie").alias("_tie"))
    kinds = {f.name: f.dataType.simpleString() for f in places.schema}
    ends = f"_end bigint, _end_index {kinds['_index']}, _end_tie {kinds['_tie']}, n_rows bigint"
    found = places.mapInArrow(
        _runs_of_slices(automaton, us),
        f"car_plate {kinds['car_plate']}, lane_id {kinds['lane_id']}, _at bigint, _index {kinds['_index']}, _tie {kinds['_tie']}, {ends}",
    )
    start = F.struct("_at", F.col("_index").alias("camera_index"), F.col("_tie").alias("tie"))
    end = F.struct(F.col("_end").alias("_at"), F.col("_end_index").alias("camera_index"), F.col("_end_tie").alias("tie"))
    candidates = materialize(found.select(*KEYS, start.alias("start"), end.alias("end"), "n_rows"), "pattern-runs")
    return _without_overlaps(candidates, reach).select(
        *KEYS, F.timestamp_micros("start._at").alias("match_start"), F.timestamp_micros("end._at").alias("match_end"), "n_rows"
    )


def _runs_of_slices(automaton: Automaton, reach_us: int):
    """Batches of crossings in the order of plate, lane, slice and place, to the runs that start at home."""

    def found(table: pa.Table) -> list[pa.RecordBatch]:
        plate = table["car_plate"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
        lane, part, at, flags = (table[c].to_numpy() for c in ("lane_id", SLICE, "_at", "_flags"))
        starts, last, _ = longest_runs(at, flags, group_ends(plate, lane, part), reach_us, automaton)
        kept = (last >= 0) & table[HOME].to_numpy()[starts]
        starts, last = starts[kept], last[kept]
        left = table.take(pa.array(starts))
        right = table.take(pa.array(last))
        columns = [left[c] for c in (*KEYS, "_at", "_index", "_tie")] + [right[c] for c in ("_at", "_index", "_tie")]
        names = [*KEYS, "_at", "_index", "_tie", "_end", "_end_index", "_end_tie", "n_rows"]
        rows = pa.Table.from_arrays([*columns, pa.array(last - starts + 1, pa.int64())], names=names)
        return rows.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # The last group of what is held may go on in this batch; all before its own last group is whole.
            keys = [batch.column(c).to_pylist()[-1] for c in (*KEYS, SLICE)]
            same = np.ones(batch.num_rows, bool)
            for name, key in zip((*KEYS, SLICE), keys):
                same &= np.asarray(pa.compute.equal(batch.column(name), pa.scalar(key, batch.schema.field(name).type)))
            cut = batch.num_rows - int(same.sum())
            begun = held and all(held[-1].column(c)[-1].as_py() == key for c, key in zip((*KEYS, SLICE), keys))
            if cut or (held and not begun):
                yield from found(pa.Table.from_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield from found(pa.Table.from_batches(held))

    return run


def _without_overlaps(candidates: DataFrame, reach: int) -> DataFrame:
    """The runs that stand when they are taken from left to right, each after the end of the one before.

    A run that no earlier one covers surely stands. The next one after an end either starts within twice the
    reach of its predecessor's start, or is one of those. It is found by one pass over starts and ends from the
    right: the last start passed before an end is met.
    """
    timed = candidates.withColumn("_time", F.timestamp_micros("start._at"))
    sliced = with_slices(timed, "_time", back_s=2 * reach, ahead_s=reach, width_s=6 * reach)
    parts = Window.partitionBy(*KEYS, SLICE)
    covered = F.max("end").over(parts.orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    known = sliced.withColumn("_covered", covered)
    # Of a start and an end at one place the end comes first from the right, since what follows it is later.
    places = F.array(F.struct(F.col("end").alias("place"), F.lit(False).alias("begins")), F.struct(F.col("start").alias("place"), F.lit(True).alias("begins")))
    passed = known.withColumn("_mark", F.explode(places))
    from_right = parts.orderBy(F.desc("_mark.place"), F.asc("_mark.begins")).rowsBetween(Window.unboundedPreceding, -1)
    later = F.last(F.when(F.col("_mark.begins"), F.col("start")), ignorenulls=True).over(from_right)
    linked = passed.withColumn("_next", later).where(F.col(HOME) & ~F.col("_mark.begins"))
    sure = F.coalesce(F.col("_covered") < F.col("start"), F.lit(True))
    nodes = linked.select(*KEYS, "start", "end", "n_rows", sure.alias("_sure"), "_next")
    return follow(nodes, KEYS, "start")
