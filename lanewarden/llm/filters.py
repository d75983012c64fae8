"""A bounded filter before a join, names that do not clash, and folds over long arrays."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unused(name: str, columns: Sequence[str]) -> str:
    """``name``, with underscores added until none of ``columns`` has it."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def possible_rows(rows: DataFrame, wanted: DataFrame, *keys: str, others: bool = False) -> DataFrame:
    """The ``rows`` whose ``keys`` may be among those of ``wanted``, without a shuffle of ``rows``.

    A bitmap of ``2**26`` hashed keys (8 MB, whatever the input) is broadcast; a join must follow.
    ``others`` gives the rest instead: rows that are certainly not among them. Columns of ``rows`` may
    have any names.
    """
    bucket, place, bitmap = (unused(name, rows.columns) for name in ("_bucket", "_place", "_bits"))

    def slot():
        return F.pmod(F.xxhash64(*keys), F.lit(1 << 26))

    bits = wanted.select(slot().alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias(bitmap)
    )
    asked = rows.withColumn(bucket, F.bitmap_bucket_number(slot())).withColumn(place, F.bitmap_bit_position(slot()))
    found = asked.join(F.broadcast(bits), bucket, "left")
    byte = f"cast(conv(hex(substring(`{bitmap}`, cast(`{place}` div 8 as int) + 1, 1)), 16, 10) as long)"
    hit = F.coalesce(F.expr(f"getbit({byte}, cast(`{place}` % 8 as int)) = 1"), F.lit(False))
    return found.where(~hit if others else hit).select(*rows.columns)


def let(value: Column, of: Callable[[Column], Column]) -> Column:
    """``of(value)`` with the value computed once, however often ``of`` names it."""
    return F.element_at(F.transform(F.array(value), of), 1)


def before_each(running: Column) -> Column:
    """Of running results, what stood before each entry (0 before the first)."""
    return F.concat(F.array(F.lit(0).cast("long")), F.slice(running, 1, F.greatest(F.size(running) - 1, F.lit(0))))


def running(values: Column, combine: Callable[[Column, Column], Column], levels: int = 2, chunk: int = 64) -> Column:
    """``array<long>``: the result of ``combine`` over the entries up to and including each one, from 0.

    ``combine`` is associative and 0 changes nothing. A fold that appends copies its list each time, so
    only chunks are folded: first each for itself, then their results (again in chunks, ``levels`` times).
    """

    def folded(entries: Column, start: Column) -> Column:
        begin = F.struct(start.alias("at"), F.array().cast("array<long>").alias("out"))

        def step(state: Column, v: Column) -> Column:
            at = combine(state["at"], v)
            return F.struct(at.alias("at"), F.concat(state["out"], F.array(at)).alias("out"))

        return F.aggregate(entries, begin, step, lambda state: state["out"])

    zero = F.lit(0).cast("long")
    if not levels:
        return folded(values, zero)

    def chunked(entries: Column) -> Column:
        last = F.floor((F.size(entries) - 1) / chunk).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(entries, k * chunk + 1, F.lit(chunk)))

        def joined(parts: Column) -> Column:
            results = running(F.transform(parts, lambda part: F.aggregate(part, zero, combine)), combine, levels - 1, chunk)
            return F.flatten(F.zip_with(parts, let(results, before_each), folded))

        return F.when(F.size(entries) > 0, let(chunks, joined)).otherwise(F.array().cast("array<long>"))

    return let(values.cast("array<long>"), chunked)


def placed(parts: Column, gap: str = "gap", size: str = "size") -> Column:
    """``parts`` (each with the gap before it and its own size) as ``array<struct<start, end, part>>``."""

    def ended(p: Column) -> Column:
        ends = running(F.transform(p, lambda x: x[gap] + x[size]), lambda a, b: a + b)
        return F.zip_with(
            p, ends, lambda x, end: F.struct((end - x[size]).cast("int").alias("start"), end.cast("int").alias("end"), x.alias("part"))
        )

    return let(parts, ended)
