"""Removal of repeated byte strings: anchored contexts, expanded backward on a positional BWT.

A byte goes if a string of ``n`` bytes that covers it also starts anywhere else. Every ``n``-byte window
has an anchor, the ``k``-byte string in it with the least hash (the first of equals), which depends
on the window's bytes alone; equal windows therefore have equal anchors at equal offsets, and anchors
can be dealt to tasks by their hash. Neighbouring windows mostly share an anchor, so there is one
row per some ``(n - k) / 2`` bytes: the anchor's hash, the offsets of its windows, and a hash of the
context that these windows span.

1. Anchors that occur once are dropped (their windows are unique). Where all occurrences of an anchor
   have one context, all its windows repeat and no text is looked at.
2. Otherwise each distinct context of the anchor is fetched once, by one of its occurrences.
3. Contexts are expanded anchor by anchor: sorted by what follows the anchor, they form one interval,
   to which the bytes before the anchor are added one at a time, breadth first over all anchors of a
   task. Each step is a stable sort by that byte within the intervals, the step of a positional
   Burrows-Wheeler transform, so contexts that still agree stay adjacent in the order of what follows.
   After ``o`` steps, neighbours in an interval whose following bytes agree for ``n - k - o`` share
   a window of ``n`` bytes. Common prefixes grow by one a step, an interval of one context is dropped,
   and expansion stops where the length ``n`` is reached.
   (The plain transform of the whole text would have to be sorted in one place, or merged; anchoring
   bounds what a task sorts, and gives the same windows.)
4. An anchor with more than ``WIDE`` contexts is not expanded in one task: hashes of its windows are
   counted instead, with map-side sums.

Defined results: a null text is empty; a text shorter than ``n`` loses nothing; equal texts of ``n``
bytes or more lose all; repeated rows count as texts that repeat; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewarden.llm.batches import _power_tables, add_columns, mix, small_batches, utf8
from lanewarden.llm.filters import possible_rows
from lanewarden.session import materialize

WIDE = 50_000
BATCH_CONTEXTS = 20_000
_PIECE = 1 << 19
_ANCHORS = "anchor long, context long, place long, least int, most int"


def gram_size(n: int) -> int:
    """Bytes of an anchor for windows of ``n`` bytes."""
    return max(1, n // 5)


def anchors(data: np.ndarray, offsets: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, ...]]:
    """``(text, place, least, most, anchor, context)`` per anchor, in pieces of bounded size.

    ``place`` is the anchor's byte in its text; its windows start ``least`` to ``most`` bytes earlier.
    """
    k = gram_size(n)
    width = n - k + 1
    for low in range(0, len(data), _PIECE):
        body = data[low : min(len(data), low + _PIECE + n - 1)]
        count = min(_PIECE, len(body) - n + 1)
        if count <= 0:
            continue
        up, down = _power_tables(len(body))
        sums = np.zeros(len(body) + 1, np.uint64)
        np.cumsum((body.astype(np.uint64) + np.uint64(1)) * up[: len(body)], out=sums[1:])
        hashes = mix((sums[k:] - sums[: len(sums) - k]) * down[: len(sums) - k])
        # Hash and place in one number: the least is the first of the least hashes.
        at = np.arange(len(hashes), dtype=np.uint64)
        keys = np.full(-(-len(hashes) // width) * width, np.iinfo(np.uint64).max, np.uint64)
        keys[: len(hashes)] = (hashes >> np.uint64(20) << np.uint64(20)) | at
        rows = keys.reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).ravel()
        back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        chosen = (np.minimum(back[:count], ahead[width - 1 : width - 1 + count]) & np.uint64(0xFFFFF)).astype(np.int64)
        start = np.arange(count)
        text = np.searchsorted(offsets, start + low, "right") - 1
        inside = np.flatnonzero(start + low + n <= offsets[text + 1])
        if not len(inside):
            continue
        start, text, chosen = start[inside], text[inside], chosen[inside]
        new = np.ones(len(start), bool)
        new[1:] = (chosen[1:] != chosen[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(start)) - 1
        gram, lowest, highest = chosen[first], start[first], start[last]
        most, least = gram - lowest, gram - highest
        span = (sums[highest + n] - sums[lowest]) * down[lowest]
        shape = (least.astype(np.uint64) << np.uint64(32)) | most.astype(np.uint64)
        context = mix(mix(span) ^ (shape * np.uint64(0x9E3779B97F4A7C15)))
        owner = text[first]
        yield owner, gram + low - offsets[owner], least, most, hashes[gram], context


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """Texts with two hashes that stand for them: equal texts are one."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.xxhash64(body).alias("h1"), F.hash(body).alias("h2"), body.alias("text"))


def _anchor_rows(keyed: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for owner, place, least, most, anchor, context in anchors(*utf8(batch.column("text")), n):
                row = pa.array(owner)
                columns = [batch.column("h1").take(row), batch.column("h2").take(row)]
                columns += [pa.array(anchor.view(np.int64)), pa.array(context.view(np.int64)), pa.array(place)]
                columns += [pa.array(least.astype(np.int32)), pa.array(most.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "anchor", "context", "place", "least", "most"])

    return keyed.where(F.octet_length("text") >= n).mapInArrow(run, "h1 long, h2 int, " + _ANCHORS)


def expand(group: np.ndarray, least: np.ndarray, most: np.ndarray, contexts: Sequence[bytes], n: int) -> np.ndarray:
    """``flags[row, o]``: the window that starts ``o`` bytes before the row's anchor occurs in another row.

    ``contexts`` are the bytes from ``most`` before the anchor on; rows of one ``group`` share an anchor.
    """
    k = gram_size(n)
    width, rows = n - k, len(contexts)
    flags = np.zeros((rows, width + 1), bool)
    sizes = np.array([len(c) for c in contexts], np.int64)
    flat = np.frombuffer(b"".join(contexts), np.uint8)
    begin = np.cumsum(sizes) - sizes
    step = np.arange(width)
    words = -(-max(width, 1) // 8) * 8
    after = np.zeros((rows, words), np.uint8)
    have = np.minimum(width - least, width)
    where = (begin + most + k)[:, None] + step
    inside = step < have[:, None]
    after[:, :width][inside] = flat[where[inside]]
    before = np.zeros((rows, max(width, 1)), np.uint8)
    where = (begin + most - 1)[:, None] - step
    inside = step < most[:, None]
    before[:, :width][inside] = flat[where[inside]]

    keys = after.view(">u8").astype(np.uint64)
    order = np.lexsort([*(keys[:, j] for j in range(keys.shape[1] - 1, -1, -1)), group])
    apart = after[order[1:]] != after[order[:-1]]
    common = np.where(apart.any(axis=1), apart.argmax(axis=1), width)
    common[group[order[1:]] != group[order[:-1]]] = -1
    common = np.concatenate([[-1], np.minimum(common, width)])
    rank = np.empty(rows, np.int64)
    rank[order] = np.arange(rows)

    active = order
    interval = np.cumsum(np.concatenate([[1], group[order[1:]] != group[order[:-1]]])) - 1
    for o in range(width + 1):
        follows = np.cumsum(common < width - o)
        able = np.flatnonzero((least[active] <= o) & (most[active] >= o))
        seen, part = active[able], interval[able]
        tail = follows[rank[seen]]
        same = (part[1:] == part[:-1]) & (tail[1:] == tail[:-1])
        flags[seen[1:][same], o] = True
        flags[seen[:-1][same], o] = True
        if o == width:
            break
        # One byte backward: a stable sort by it within each interval; intervals of one row end.
        going = most[active] > o
        active, interval = active[going], interval[going]
        key = interval * 256 + before[active, o]
        turn = np.argsort(key, kind="stable")
        active, key = active[turn], key[turn]
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        interval = np.cumsum(new) - 1
        shared = np.bincount(interval, minlength=1)[interval] > 1 if len(interval) else np.zeros(0, bool)
        active, interval = active[shared], interval[shared]
        if not len(active):
            break
    return flags


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, first and last columns of the runs of true flags."""
    edge = np.zeros((flags.shape[0], 1), np.int8)
    change = np.diff(np.concatenate([edge, flags.view(np.int8), edge], axis=1), axis=1)
    row, first = np.nonzero(change == 1)
    return row, first, np.nonzero(change == -1)[1] - 1


_FOUND = "anchor long, context long, first int, last int"


def _expanded(contexts: DataFrame, n: int) -> DataFrame:
    """``anchor, context, first, last``: offsets of repeated windows, by expansion in the tasks."""
    dealt = contexts.repartition("anchor").sortWithinPartitions("anchor", "context")

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        anchor, context, least, most, body = zip(*rows)
        ids = np.array(anchor, np.int64)
        row, first, last = _runs(expand(ids, np.array(least, np.int64), np.array(most, np.int64), body, n))
        columns = [pa.array(ids[row]), pa.array(np.array(context, np.int64)[row])]
        columns += [pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))]
        return pa.RecordBatch.from_arrays(columns, ["anchor", "context", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in range(5))):
                if held and row[:2] == held[-1][:2]:
                    continue  # the same context, fetched from equal texts
                if len(held) >= BATCH_CONTEXTS and row[0] != held[-1][0]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    return dealt.select("anchor", "context", "least", "most", "body").mapInArrow(run, _FOUND)


def _counted(contexts: DataFrame, n: int) -> DataFrame:
    """The same for anchors with very many contexts: window hashes, counted over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            anchor, context, least, most, body = (batch.column(c).to_pylist() for c in range(5))
            out: list[tuple] = []
            for a, c, low, high, text in zip(anchor, context, least, most, body):
                for o in range(low, high + 1):
                    out.append((a, c, o, hashlib.blake2b(text[high - o : high - o + n], digest_size=16).digest()))
            columns = list(zip(*out)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds)], ["anchor", "context", "first", "window"])

    each = contexts.select("anchor", "context", "least", "most", "body").dropDuplicates(["anchor", "context"])
    windows = each.mapInArrow(run, "anchor long, context long, first int, window binary")
    key = ["anchor", "first", "window"]
    often = windows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*key)
    return windows.join(often, key).select("anchor", "context", "first", F.col("first").alias("last"))


def repeated_ranges(docs: DataFrame, *, n: int = 200, text: str = "text", wide: int = WIDE) -> DataFrame:
    """``h1, h2, ranges``: per distinct text with repeats, the byte ranges ``[start, end)`` to remove."""
    small_batches(docs.sparkSession)
    keyed = _keyed(docs, text)
    rows = _anchor_rows(keyed, n)
    tally = rows.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("_n"), F.min("context").alias("_low"), F.max("context").alias("_high")
    )
    often = materialize(tally.where("_n > 1").select("anchor", (F.col("_low") != F.col("_high")).alias("mixed")), "anchors")
    places = possible_rows(rows, often, "anchor").join(often.hint("shuffle_merge"), "anchor")
    places = materialize(places, "places")
    whole = places.where("not mixed").select("h1", "h2", "place", F.col("least").alias("first"), F.col("most").alias("last"))

    mixed = places.where("mixed")
    distinct = mixed.groupBy("anchor", "context", "least", "most").agg(
        F.count(F.lit(1)).alias("_n"), F.min(F.struct("h1", "h2", "place")).alias("at")
    )
    distinct = materialize(distinct, "contexts")
    spread = distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("_contexts")).where(F.col("_contexts") > wide)
    spread = materialize(spread.select("anchor"), "wide")
    wanted = distinct.groupBy("at.h1", "at.h2").agg(
        F.collect_list(F.struct("anchor", "context", "at.place", "least", "most")).alias("asked")
    )
    wanted = materialize(wanted, "wanted")
    texts = possible_rows(keyed, wanted, "h1", "h2")
    fetched = materialize(_bodies(texts.join(wanted.hint("shuffle_merge"), ["h1", "h2"]), n), "bodies")
    found = _expanded(fetched.join(spread, "anchor", "left_anti"), n)
    if spread.limit(1).count():
        found = found.unionByName(_counted(fetched.join(spread, "anchor", "left_semi"), n))
    found = materialize(found, "found")

    # A context that occurs twice repeats whole; others where the expansion found them.
    twice = distinct.where("_n > 1").select("anchor", "context", F.col("least").alias("first"), F.col("most").alias("last"))
    once = found.join(distinct.where("_n = 1").select("anchor", "context"), ["anchor", "context"])
    parts = mixed.select("anchor", "context", "h1", "h2", "place").join(twice.unionByName(once), ["anchor", "context"])
    covers = whole.unionByName(parts.select(*whole.columns)).select(
        "h1", "h2", F.struct((F.col("place") - F.col("last")).alias("start"), (F.col("place") - F.col("first") + n).alias("end")).alias("r")
    )
    return materialize(covers.distinct().groupBy("h1", "h2").agg(F.array_sort(F.collect_list("r")).alias("ranges")), "ranges")


def _bodies(asked: DataFrame, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, asked in zip(batch.column("text").to_pylist(), batch.column("asked").to_pylist()):
                data = text.encode()
                out = [
                    (r["anchor"], r["context"], r["least"], r["most"], data[r["place"] - r["most"] : r["place"] - r["least"] + n])
                    for r in asked
                ]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
                columns = [pa.array(x, t) for x, t in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "context", "least", "most", "body"])

    return asked.select("text", "asked").mapInArrow(run, "anchor long, context long, least int, most int, body binary")


def _cut(data: np.ndarray, ranges: list[dict] | None) -> tuple[np.ndarray, int]:
    """The bytes that stay and the number of maximal removed runs."""
    kept, spans, at = np.ones(len(data), bool), 0, -1
    for r in ranges or ():
        kept[r["start"] : r["end"]] = False
        spans += r["start"] > at
        at = max(at, r["end"])
    return data[kept], spans


def remove_repeats(
    docs: DataFrame, keep: Sequence[str] | None = None, *, n: int = 200, text: str = "text", wide: int = WIDE
) -> DataFrame:
    """``keep`` columns (all by default), ``n_bytes, n_removed, n_spans`` and the remaining bytes ``kept_bytes``."""
    keep = list(docs.columns if keep is None else keep)
    ranges = repeated_ranges(docs, n=n, text=text, wide=wide)
    body = F.coalesce(F.col(text), F.lit(""))
    full = docs.select(F.struct(*keep).alias("_kept"), F.xxhash64(body).alias("h1"), F.hash(body).alias("h2"), body.alias("_text"))
    # Texts without repeats need no join, and so no shuffle.
    touched = possible_rows(full, ranges, "h1", "h2").join(ranges.hint("shuffle_merge"), ["h1", "h2"], "left")
    clear = possible_rows(full, ranges, "h1", "h2", others=True).withColumn("ranges", F.lit(None).cast(ranges.schema["ranges"].dataType))
    added = T.StructType(
        [
            T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()),
            T.StructField("n_spans", T.LongType()), T.StructField("kept_bytes", T.BinaryType()),
        ]
    )

    def compute(batch: pa.RecordBatch):
        data, offsets = utf8(batch.column("_text"))
        sizes, gone, spans, kept = [], [], [], []
        for i, asked in enumerate(batch.column("ranges").to_pylist()):
            rest, count = _cut(data[offsets[i] : offsets[i + 1]], asked)
            sizes.append(int(offsets[i + 1] - offsets[i]))
            gone.append(sizes[-1] - len(rest))
            spans.append(int(count))
            kept.append(rest.tobytes())
        return sizes, gone, spans, kept

    both = touched.select("_kept", "_text", "ranges").unionByName(clear.select("_kept", "_text", "ranges"))
    return add_columns(both, ["_kept"], added, compute).select(*[F.col("_kept")[c].alias(c) for c in keep if c not in added.names], *added.names)
