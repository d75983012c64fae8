"""Total orders and exact ranks without a one-task sort."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewarden.session import materialize

# monotonically_increasing_id keeps the row position in the low 33 bits of the value.
_POSITION_BITS = 33


def global_ordinal(df: DataFrame, *order: Column, name: str = "ordinal") -> DataFrame:
    """Number all rows from 0 in ``order``, with no step that sees them all.

    Rows are range-partitioned and sorted, and each keeps its position in its partition. Only one
    count per partition is then summed up in order, so the single-task step and the broadcast are
    as large as the number of partitions. The sorted rows are written out first: range bounds come
    from a sample, and two evaluations could place rows differently. ``order`` must be total.
    """
    raw = "_raw_position"
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(raw, F.monotonically_increasing_id())
    stored = materialize(placed, "ordinal")
    part = F.shiftright(F.col(raw), _POSITION_BITS).alias("_part")
    counts = stored.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    position = F.col(raw).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    return (
        stored.withColumn("_part", F.shiftright(F.col(raw), _POSITION_BITS))
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + position)
        .drop("_part", "_start", raw)
    )


def _locate(counts: DataFrame, key: str) -> DataFrame:
    """Per target, the ``key`` whose run of rows holds its rank, and the rank within that run.

    ``counts`` has ``_q, _rank`` and, for each of the target's keys, the row count ``_c``.
    """
    ascending = Window.partitionBy("_q").orderBy(key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = counts.withColumn("_start", F.sum("_c").over(ascending) - F.col("_c"))
    local = F.col("_rank") - F.col("_start")
    return placed.where((local >= 0) & (local < F.col("_c"))).select("_q", key, local.alias("_rank"))


def values_at_ranks(
    df: DataFrame, value: str, ranks: Mapping[str, Column], *, fine_bits: int = 15, coarse_bits: int = 30
) -> DataFrame:
    """One row with the value at each 0-based rank of the sorted whole-number column ``value``."""
    hits = located_ranks(df, value, ranks, fine_bits=fine_bits, coarse_bits=coarse_bits)
    return hits.agg(*[F.max(F.when(F.col("_q") == k, F.col("_v"))).alias(k) for k in ranks])


def located_ranks(
    df: DataFrame, value: str, ranks: Mapping[str, Column], *, fine_bits: int = 15, coarse_bits: int = 30
) -> DataFrame:
    """Per 0-based rank of the sorted whole-number column ``value``: ``_q``, the value ``_v`` there, and
    ``_rank``, the place among the rows that share the value. Ranks that are null give no row.

    ``ranks`` maps output names to expressions over ``n``, the row count. No step sorts the rows.
    They are counted per fine bin of ``2**fine_bits``; those counts are summed per coarse bin, and
    each rank is located first among the coarse bins, then among the fine bins of one coarse bin,
    then among the values of one fine bin. For microseconds the ordered steps hold the number of
    18-minute spans covered, then at most 32,768 rows each, however many rows there are.
    """

    def floor_to(bits: int) -> Column:
        return F.shiftleft(F.shiftright(F.col("_v"), bits), bits)

    values = df.select(F.col(value).cast("long").alias("_v")).where(F.col("_v").isNotNull())
    binned = values.select("_v", floor_to(fine_bits).alias("_fine"))
    fine = binned.groupBy("_fine").agg(F.count(F.lit(1)).alias("_c"))
    fine = fine.select("_fine", F.shiftright("_fine", coarse_bits).alias("_coarse"), "_c")
    coarse = fine.groupBy("_coarse").agg(F.sum("_c").alias("_c"))
    wanted = F.array(*[F.struct(F.lit(k).alias("q"), r.cast("long").alias("rank")) for k, r in ranks.items()])
    totals = coarse.withColumn("n", F.sum("_c").over(Window.partitionBy()))
    targets = totals.withColumn("_t", F.explode(wanted)).select(
        F.col("_t.q").alias("_q"), F.col("_t.rank").alias("_rank"), "_coarse", "_c"
    )
    in_coarse = _locate(targets, "_coarse")
    in_fine = _locate(fine.join(F.broadcast(in_coarse), "_coarse"), "_fine")
    per_value = binned.join(F.broadcast(in_fine), "_fine").groupBy("_q", "_rank", "_v").agg(
        F.count(F.lit(1)).alias("_c")
    )
    return _locate(per_value, "_v")


def ranked_slice(
    df: DataFrame, position: Column, order: Sequence[Column], skip: int, limit: int,
    within: Callable[[int, int], Column] | None = None,
) -> DataFrame:
    """Rows ``skip`` to ``skip + limit - 1`` of ``order``, in that order, wherever in the table they lie.

    ``position`` is a whole number, never null, that rises with ``order``; rows may share one. Counts
    locate the positions at both ends; only rows from one to the other are sorted, as a top-k of the
    slice and what shares its first position. Nothing is written, and rows skipped are not moved.
    ``within`` states for two positions what rows between them hold, on stored columns, so that the scan prunes.
    """
    placed = df.select("*", position.alias("_position"))
    first = F.when(F.col("n") > skip, F.lit(skip))
    last = F.least(F.col("n") - 1, F.lit(skip + limit - 1))
    ends = {row["_q"]: row for row in located_ranks(placed, "_position", {"first": first, "last": last}).collect()}
    if "first" not in ends:
        return df.where(F.lit(False))
    low, high, shared = ends["first"]["_v"], ends["last"]["_v"], ends["first"]["_rank"]
    near = df.where(within(low, high)) if within else placed.where(F.col("_position").between(low, high)).drop("_position")
    return near.orderBy(*order).offset(shared).limit(limit)


def text_position(text: Column) -> Column:
    """The first seven bytes of ``text`` as a whole number that rises with it; null is lowest."""
    head = F.rpad(F.substring(F.hex(text), 1, 14), 14, "0")
    return F.coalesce(F.conv(head, 16, 10).cast("long"), F.lit(-1).cast("long"))


def nearest_rank(q: float) -> Column:
    """Rank ``round(q * (n - 1))``, halves to even, as a function of ``n``."""
    return F.least(F.col("n") - 1, F.bround(F.lit(q) * (F.col("n") - 1)).cast("long"))


def floor_rank(q: float) -> Column:
    """Rank ``int(q * n)``, at most the last one, as a function of ``n``."""
    return F.least(F.col("n") - 1, F.floor(F.lit(q) * F.col("n")))
