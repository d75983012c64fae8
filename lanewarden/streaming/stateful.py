"""Keyed state on streams: vehicles on the road, and an exact rolling flag per plate.

Last crossings and row patterns as well. All are kept by bucket of plates, with one state and one call of numpy
per bucket and batch, and need the RocksDB state store (``spark.sql.streaming.stateStore.providerClass``).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from lanewarden.operators.patterns import Automaton, Step, flags_of, group_ends, longest_runs, tie_break
from lanewarden.operators.trips import judged_pairs
from lanewarden.settings import DEDUP_WINDOW, JOIN_WINDOW, VEHICLE_TTL_S, duration_seconds

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Keys of the state of many vehicles; fixed for the life of a checkpoint.
BUCKETS = 64
_LIVE = "lane_id int, camera_id int, position_km double, speed_reading double, over boolean, seen_us long"
LIVE_ROW = "car_plate string, status string, " + _LIVE


def _bucket(*keys: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket")


def _rows_of(table: pd.DataFrame, names: list[str]) -> list[tuple]:
    """The rows as tuples of Python values, missing ones as None."""
    return list(zip(*[table[c].astype(object).where(table[c].notna(), None).tolist() for c in names]))


class _LiveVehicles(StatefulProcessor):
    """The last crossing of each vehicle of a bucket; an event-time timer reports those gone after their TTL."""

    names = ["car_plate", "lane_id", "camera_id", "position_km", "speed_reading", "over", "seen_us"]

    def __init__(self, ttl_us: int) -> None:
        self.ttl_us = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getListState("last", "car_plate string, " + _LIVE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat([part[self.names] for part in rows], ignore_index=True)
        both = pd.concat([self._held(), new], ignore_index=True) if self.last.exists() else new
        # Newest first; ties as in the table form, missing readings last.
        order = ["seen_us", "camera_id", "lane_id", "position_km", "speed_reading", "over"]
        both = both.sort_values(order, ascending=False).drop_duplicates("car_plate")
        self._keep(both)
        yield self._told(both[both["car_plate"].isin(new["car_plate"])], "seen")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = self._held()
        gone = held["seen_us"] + self.ttl_us < timerValues.getCurrentWatermarkInMs() * 1000
        self._keep(held[~gone])
        if gone.any():
            yield self._told(held[gone], "gone")

    def _held(self) -> pd.DataFrame:
        return pd.DataFrame([tuple(r) for r in self.last.get()], columns=self.names)

    def _keep(self, table: pd.DataFrame) -> None:
        """Store the vehicles, with one timer for the first of them to go."""
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if len(table):
            self.last.put(_rows_of(table, self.names))
            self.handle.registerTimer((int(table["seen_us"].min()) + self.ttl_us) // 1000 + 1)
        else:
            self.last.clear()

    def _told(self, table: pd.DataFrame, status: str) -> pd.DataFrame:
        return table.assign(status=status)[["car_plate", "status", *self.names[1:]]]

    def close(self) -> None:
        pass


def live_vehicle_stream(events: DataFrame, ttl_s: float = VEHICLE_TTL_S, buckets: int = BUCKETS) -> DataFrame:
    """Updates of the live picture: ``seen`` at each batch a vehicle crosses in, ``gone`` once expired.

    A vehicle is gone when the watermark is more than ``ttl_s`` past its last crossing. A crossing without a time,
    plate, lane, camera or position says nothing about where a vehicle is and is left out; one without a reading
    counts as within the limit. State holds one crossing per vehicle on the road.
    """
    keyed = events.select(
        _bucket("car_plate", buckets=buckets), "car_plate", "lane_id", "camera_id", "position_km", "speed_reading",
        F.coalesce(F.col("speed_reading") > F.col("speed_limit"), F.lit(False)).alias("over"),
        F.unix_micros("event_time").alias("seen_us"),
        "event_time",
    ).dropna(subset=["event_time", "car_plate", "lane_id", "camera_id", "position_km"])
    return keyed.groupBy("bucket").transformWithStateInPandas(
        _LiveVehicles(round(ttl_s * 1_000_000)), LIVE_ROW, "Append", "EventTime"
    )


_VEHICLE = ["car_plate", "lane_id"]


# Rows of one value of state.
_CHUNK_ROWS = 100_000


def _packed(table: pd.DataFrame) -> list[tuple[bytes]]:
    """The rows as values of state, each an Arrow table: a call of the state store per row would take most of the time."""
    chunks = []
    for at in range(0, len(table), _CHUNK_ROWS):
        part = pa.Table.from_pandas(table.iloc[at : at + _CHUNK_ROWS], preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
            writer.write_table(part)
        chunks.append((sink.getvalue().to_pybytes(),))
    return chunks


def _unpacked(chunks: Iterator[tuple]) -> pd.DataFrame | None:
    tables = [pa.ipc.open_stream(bytes(chunk)).read_all().to_pandas() for chunk, in chunks]
    return pd.concat(tables, ignore_index=True) if tables else None


def _sort_key(column: pd.Series) -> np.ndarray:
    """Numbers that order the column's values, missing ones last."""
    if column.dtype != object:
        return column.to_numpy()
    codes, values = pd.factorize(column, sort=True)
    return np.where(codes < 0, len(values), codes)


class _InOrder(StatefulProcessor):
    """Rows of a bucket of vehicles wait until the watermark has passed them, then are judged in order.

    The state is a list of Arrow tables. ``judge`` gets all rows of the bucket, sorted by ``order``, and the time that has passed. It returns what to
    emit, which rows to keep, and when to look again though nothing waits.
    """

    order = [*_VEHICLE, "at_us", "camera_index", "tie"]

    def __init__(self, names: list[str], reach_us: int) -> None:
        self.names, self.reach_us = names, reach_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "chunk binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        earliest, parts, held = None, [], 0
        for part in rows:
            parts.append(part[self.names])
            held += len(part)
            if held >= _CHUNK_ROWS:
                self.rows.appendList(_packed(pd.concat(parts, ignore_index=True)))
                parts, held = [], 0
            first = int(part["at_us"].min())
            earliest = first if earliest is None else min(earliest, first)
        if held:
            self.rows.appendList(_packed(pd.concat(parts, ignore_index=True)))
        set_for = list(self.handle.listTimers())
        if not set_for or earliest // 1000 + 1 < min(set_for):
            self._only_timer(earliest)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed_us = timerValues.getCurrentWatermarkInMs() * 1000
        table = _unpacked(self.rows.get()) if self.rows.exists() else None
        if table is not None:
            table = table.take(np.lexsort([_sort_key(table[c]) for c in reversed(self.order)])).reset_index(drop=True)
            found, kept, again_us = self.judge(table, passed_us)
            if len(kept):
                self.rows.put(_packed(kept[self.names]))
            else:
                self.rows.clear()
            waiting = kept["at_us"][kept["at_us"] > passed_us]
            moments = [int(waiting.min())] if len(waiting) else []
            moments += [] if again_us is None else [again_us]
            if moments:
                self._only_timer(min(moments))
            if len(found):
                yield found

    def _only_timer(self, at_us: int) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at_us // 1000 + 1)

    def close(self) -> None:
        pass


class _LastCrossing(_InOrder):
    """Pairs each crossing with the vehicle's last one on the lane; that one is all that stays of the past."""

    def judge(self, table: pd.DataFrame, passed_us: int) -> tuple[pd.DataFrame, pd.DataFrame, int | None]:
        at = table["at_us"].to_numpy()
        plate, lane = table["car_plate"].to_numpy(), table["lane_id"].to_numpy()
        same = (plate[1:] == plate[:-1]) & (lane[1:] == lane[:-1])
        ready, judged = at <= passed_us, table["judged"].to_numpy(bool)
        pair = np.flatnonzero(same & ready[1:] & ~judged[1:] & (at[1:] - at[:-1] <= self.reach_us))
        first, second = table.iloc[pair], table.iloc[pair + 1]
        found = pd.DataFrame({
            "car_plate": first["car_plate"].to_numpy(), "lane_id": first["lane_id"].to_numpy(),
            "camera_id": first["camera_id"].to_numpy(), "position_km": first["position_km"].to_numpy(),
            "at_us": at[pair], "next_camera_id": second["camera_id"].to_numpy(),
            "next_position_km": second["position_km"].to_numpy(), "next_speed_limit": second["speed_limit"].to_numpy(),
            "next_at_us": at[pair + 1],
        })
        last = ready.copy()
        last[:-1] &= ~(same & ready[1:])
        # No crossing to come is within reach of an older one.
        last &= at + self.reach_us > passed_us
        kept = table[~ready | last].copy()
        kept["judged"] = (ready & last)[~ready | last]
        return found, kept, int(at[last].max()) + self.reach_us if last.any() else None


def last_crossing_stream(events: DataFrame, window: str = JOIN_WINDOW, buckets: int = BUCKETS) -> DataFrame:
    """Average violations between each crossing and the vehicle's next one on the lane, on a stream.

    The rows of :func:`lanewarden.operators.trips.detect_average_last_crossing`, for any order of arrival within the
    watermark. State holds the crossings that the watermark has not passed, and one last crossing per vehicle
    on the road, instead of a window's worth of both sides of a join. Crossings without a plate, lane or time
    are left out; readings may be missing.
    """
    keyed = events.dropna(subset=["car_plate", "lane_id", "camera_id", "camera_index", "position_km", "speed_limit", "event_time"]).select(
        _bucket(*_VEHICLE, buckets=buckets),
        *_VEHICLE, "camera_id", *tie_break(), "position_km", "speed_limit",
        F.unix_micros("event_time").alias("at_us"), F.lit(False).alias("judged"), "event_time",
    )
    names = [*_VEHICLE, "camera_id", "camera_index", "tie", "position_km", "speed_limit", "at_us", "judged"]
    pairs = keyed.groupBy("bucket").transformWithStateInPandas(
        _LastCrossing(names, duration_seconds(window) * 1_000_000),
        "car_plate string, lane_id int, camera_id int, position_km double, at_us long, next_camera_id int, "
        "next_position_km double, next_speed_limit double, next_at_us long",
        "Append", "EventTime",
    )
    return judged_pairs(
        pairs.withColumns({"event_time": F.timestamp_micros("at_us"), "next_event_time": F.timestamp_micros("next_at_us")})
    )


def _next_after(group: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """For each row, the first row of its group at least ``width`` later (the number of rows if there is none).

    Rows are sorted by group and time. Both are merged as they are, so no combined key can overflow.
    """
    n = len(at)
    merged = np.lexsort((np.repeat([0, 1], n), np.concatenate([at + width, at]), np.concatenate([group, group])))
    asked = merged < n
    after = np.empty(n, np.int64)
    after[merged[asked]] = np.cumsum(~asked)[asked]
    ends = np.searchsorted(group, group, "right")
    return np.where(after < ends, after, n)


class _RollingFlag(_InOrder):
    """A row passes when it starts at least one width after the plate's last flag.

    The last flag stays as a row of the state, until no row to come can fall within its width.
    """

    order = ["car_plate", "at_us", "violation_type"]

    def judge(self, table: pd.DataFrame, passed_us: int) -> tuple[pd.DataFrame, pd.DataFrame, int | None]:
        at, known = table["at_us"].to_numpy(np.int64), table["flagged"].to_numpy(bool)
        plate = pd.factorize(table["car_plate"])[0]
        ready, after = at <= passed_us, _next_after(plate, at, self.reach_us)
        first = np.flatnonzero(np.r_[True, plate[1:] != plate[:-1]])
        # Each plate begins at what follows its last flag, or else at its first row; all chains go on at once.
        start = np.zeros(plate[-1] + 1, np.int64)
        start[plate[first]] = first
        start[plate[known]] = after[known]
        flags, at_row = [], start
        while True:
            at_row = at_row[at_row < len(at)]
            at_row = at_row[ready[at_row]]
            if not len(at_row):
                break
            flags.append(at_row)
            at_row = after[at_row]
        flags = np.sort(np.concatenate(flags)) if flags else np.empty(0, np.int64)
        last = np.full(plate[-1] + 1, -1)
        last[plate[known]] = np.flatnonzero(known)
        last[plate[flags]] = flags
        last = last[last >= 0]
        last = last[at[last] + self.reach_us > passed_us]
        kept = table.assign(flagged=False)
        kept.loc[last, "flagged"] = True
        kept = kept[~ready | kept["flagged"]]
        found = table.loc[flags, ["car_plate", "violation_type", "at_us"]].rename(columns={"at_us": "start_us"})
        return found, kept, int(at[last].max()) + self.reach_us if len(last) else None


def rolling_flag_stream(violations: DataFrame, width: str = DEDUP_WINDOW, buckets: int = BUCKETS) -> DataFrame:
    """Exact rolling suppression per plate, in event time: the flags of :func:`lanewarden.operators.dedup.rolling_flag`.

    How rows are dealt to files and batches makes no difference, as long as none comes too late. State holds the
    rows that the watermark has not passed, and one flag per plate flagged within the last width. Violations
    without a plate or start are left out.
    """
    keyed = violations.dropna(subset=["car_plate", "timestamp_start"]).select(
        _bucket("car_plate", buckets=buckets), "car_plate", "violation_type", "timestamp_start",
        F.unix_micros("timestamp_start").alias("at_us"), F.lit(False).alias("flagged"),
    )
    names = ["car_plate", "violation_type", "at_us", "flagged"]
    return keyed.groupBy("bucket").transformWithStateInPandas(
        _RollingFlag(names, duration_seconds(width) * 1_000_000),
        "car_plate string, violation_type string, start_us long", "Append", "EventTime",
    )


class _Pattern(_InOrder):
    """Runs of an automaton from left to right; a start waits until its run has ended or its time is over."""

    def __init__(self, names: list[str], reach_us: int, automaton: Automaton) -> None:
        super().__init__(names, reach_us)
        self.automaton = automaton

    def judge(self, table: pd.DataFrame, passed_us: int) -> tuple[pd.DataFrame, pd.DataFrame, int | None]:
        again = np.ones(len(table), bool)
        again[:1] = False
        for name in self.order:
            values = table[name].to_numpy()
            again[1:] &= values[1:] == values[:-1]
        table = table[~again].reset_index(drop=True)
        at = table["at_us"].to_numpy()
        keep = at > passed_us
        # Rows that have passed, and the runs from them; a run that may go on waits with all after it.
        ready = np.flatnonzero(~keep)
        passed = table.take(ready)
        plate, lane, at = passed["car_plate"].to_numpy(), passed["lane_id"].to_numpy(), at[ready]
        ends = group_ends(plate, lane)
        starts, last, alive = longest_runs(at, passed["flags"].to_numpy(), ends, self.reach_us, self.automaton)
        waits = alive & (at[starts] + self.reach_us > passed_us)
        some = (last >= 0) | waits
        starts, last, waits = starts[some], last[some], waits[some]
        after = np.searchsorted(starts, np.where(waits, ends[starts], last + 1)).tolist()
        taken, i = [], 0
        while i < len(starts):
            taken.append(i)
            i = after[i]
        taken = np.array(taken, np.int64)
        again_us = None
        for start in starts[taken[waits[taken]]]:
            keep[ready[start : ends[start]]] = True
            again = int(at[start]) + self.reach_us
            again_us = again if again_us is None else min(again_us, again)
        taken = taken[~waits[taken]]
        first, end = starts[taken], last[taken]
        found = pd.DataFrame({
            "car_plate": plate[first], "lane_id": lane[first], "start_us": at[first], "end_us": at[end], "n_rows": end - first + 1,
        })
        return found, table[keep], again_us


def pattern_stream(events: DataFrame, steps: Sequence[Step], *, within: str = JOIN_WINDOW, buckets: int = BUCKETS) -> DataFrame:
    """The matches of :func:`lanewarden.operators.patterns.match_rows` on a stream, for any order of arrival.

    Conditions are on the crossing itself: the one before it is not known when a crossing arrives. A match is
    emitted once the watermark has passed all that could lengthen it.
    """
    automaton = Automaton.of(steps)
    keyed = events.dropna(subset=[*_VEHICLE, "event_time"]).select(
        _bucket(*_VEHICLE, buckets=buckets),
        *_VEHICLE, F.coalesce("camera_index", F.lit(-1)).alias("camera_index"), tie_break()[1],
        F.unix_micros("event_time").alias("at_us"), flags_of(steps).alias("flags"), "event_time",
    )
    names = [*_VEHICLE, "camera_index", "tie", "at_us", "flags"]
    found = keyed.groupBy("bucket").transformWithStateInPandas(
        _Pattern(names, duration_seconds(within) * 1_000_000, automaton),
        "car_plate string, lane_id int, start_us long, end_us long, n_rows long", "Append", "EventTime",
    )
    return found.select(
        *_VEHICLE, F.timestamp_micros("start_us").alias("match_start"), F.timestamp_micros("end_us").alias("match_end"), "n_rows"
    )
