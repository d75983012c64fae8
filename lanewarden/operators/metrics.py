"""Figures about a run: latency, throughput, join cost, and reports per batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanewarden.functions.ordering import floor_rank, nearest_rank, values_at_ranks
from lanewarden.functions.scalars import micros_between, plausible
from lanewarden.operators.detect import ADJACENT, ALL_PAIRS, offending_segments
from lanewarden.settings import AVERAGE, INSTANTANEOUS, LATENCY_BINS, LATENCY_CAP_S


def latencies(ledger: DataFrame, cap_s: float | None = LATENCY_CAP_S) -> DataFrame:
    """Plausible detection delays: whole microseconds, and seconds."""
    micros = micros_between(F.col("timestamp_end"), F.col("detected_at"))
    return ledger.select(micros.alias("latency_us"), (micros / F.lit(1e6)).alias("latency_s")).where(
        plausible(F.col("latency_s"), cap_s)
    )


def _percentiles(delays: DataFrame, rank, quantiles: Sequence[float]) -> DataFrame:
    names = {f"p{round(q * 100):d}": rank(q) for q in quantiles}
    return values_at_ranks(delays, "latency_us", names).select(*[(F.col(k) / 1e6).alias(f"{k}_s") for k in names])


def _spread(delays: DataFrame) -> DataFrame:
    return delays.agg(
        F.count(F.lit(1)).alias("n"),
        (F.min("latency_us") / 1e6).alias("min_s"),
        (F.avg("latency_us") / 1e6).alias("mean_s"),
        (F.max("latency_us") / 1e6).alias("max_s"),
    )


def _beside(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two one-row aggregates as one row."""
    return left.withColumn("_one", F.lit(1)).join(F.broadcast(right.withColumn("_one", F.lit(1))), "_one").drop("_one")


def latency_summary(ledger: DataFrame, cap_s: float | None = LATENCY_CAP_S) -> DataFrame:
    """One row: count, extremes, mean and exact nearest-rank percentiles of the delay."""
    delays = latencies(ledger, cap_s)
    return _beside(_spread(delays), _percentiles(delays, nearest_rank, (0.5, 0.95, 0.99)))


def latency_percentiles_floor(ledger: DataFrame) -> DataFrame:
    """The variant that takes element ``int(q * n)`` and drops negative delays only."""
    return _percentiles(latencies(ledger, None), floor_rank, (0.5, 0.95))


def latency_median(ledger: DataFrame, cap_s: float | None = LATENCY_CAP_S) -> DataFrame:
    """The interpolated median, the mean of the two middle delays when their number is even."""
    n = F.col("n")
    middle = {"low": F.call_function("div", n - 1, F.lit(2)), "high": F.call_function("div", n, F.lit(2))}
    pair = values_at_ranks(latencies(ledger, cap_s), "latency_us", middle)
    return pair.select(((F.col("low") / 1e6 + F.col("high") / 1e6) / 2).alias("median_s"))


def latency_histogram(ledger: DataFrame, bins: int = LATENCY_BINS, cap_s: float | None = LATENCY_CAP_S) -> DataFrame:
    """Equal-width bins from the least to the greatest delay, empty ones included, top edge closed."""
    delays = latencies(ledger, cap_s)
    bounds = delays.agg(F.min("latency_us").alias("lo"), F.max("latency_us").alias("hi"))
    lo, hi = bounds.select("lo").scalar(), bounds.select("hi").scalar()
    placed = delays.select("latency_us", lo.alias("lo"), hi.alias("hi"))
    span = F.col("hi") - F.col("lo")
    index = F.call_function("div", (F.col("latency_us") - F.col("lo")) * bins, F.nullif(span, F.lit(0)))
    binned = placed.select(F.least(F.coalesce(index, F.lit(bins // 2)), F.lit(bins - 1)).alias("bin"))
    counts = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    frame = bounds.where(F.col("lo").isNotNull()).select(
        "lo", "hi", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))).alias("bin")
    )
    edge = (F.col("lo") + F.col("bin") * (F.col("hi") - F.col("lo")) / bins) / 1e6
    return frame.join(F.broadcast(counts), "bin", "left").select(
        "bin", edge.alias("from_s"), F.coalesce("n", F.lit(0)).alias("n")
    )


def throughput(ledger: DataFrame, run_start: Column, n_events: int | Column) -> DataFrame:
    """One row for the rows detected from ``run_start`` on: counts, drain time, events per second."""
    kind, events = F.col("violation_type"), n_events if isinstance(n_events, Column) else F.lit(n_events)
    run = ledger.where(F.col("detected_at") >= run_start)
    counts = run.agg(
        F.count(F.lit(1)).alias("violations"),
        F.count_if(kind == INSTANTANEOUS).alias("instant"),
        F.count_if(kind == AVERAGE).alias("average"),
        F.max("detected_at").alias("_last"),
    )
    drain = micros_between(run_start, F.col("_last")) / 1e6
    return counts.select(
        "violations", "instant", "average",
        drain.alias("drain_s"),
        F.when(drain > 0, F.try_divide(events, drain)).alias("events_per_s"),
    )


def run_rates(ledger: DataFrame, n_events: int | Column) -> DataFrame:
    """One row: first and last detection, the time between (never zero), and both rates."""
    events = n_events if isinstance(n_events, Column) else F.lit(n_events)
    run = ledger.agg(
        F.count(F.lit(1)).alias("violations"),
        F.min("detected_at").alias("first_detected"),
        F.max("detected_at").alias("last_detected"),
    )
    window = F.greatest(F.lit(1e-9), micros_between(F.col("first_detected"), F.col("last_detected")) / 1e6)
    return run.select(
        "*",
        window.alias("window_s"),
        (events / window).alias("events_per_s"),
        (F.col("violations") / window).alias("violations_per_s"),
    )


def batch_report(batch: DataFrame, stored_keys: DataFrame, batch_key: str | None = None) -> DataFrame:
    """Per batch: violations, either kind, and how many are new to the ledger or repeat a key.

    The batch is reduced to one row per ledger key before it meets the stored keys.
    """
    kind = F.col("violation_type")
    group = [batch_key] if batch_key else []
    per_key = batch.groupBy(*group, "car_plate", "window_start").agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(kind == INSTANTANEOUS).alias("_i"),
        F.count_if(kind == AVERAGE).alias("_a"),
    )
    known = stored_keys.select("car_plate", "window_start").distinct().withColumn("_known", F.lit(True))
    judged = per_key.join(known, ["car_plate", "window_start"], "left")
    new = F.count_if(F.col("_known").isNull())
    return judged.groupBy(*group).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("violations"),
        F.coalesce(F.sum("_i"), F.lit(0)).alias("instant"),
        F.coalesce(F.sum("_a"), F.lit(0)).alias("average"),
        new.alias("new"),
        (F.coalesce(F.sum("_n"), F.lit(0)) - new).alias("duplicate"),
    )


def modelled_pairs(strategy: Column, k: Column, vehicles: Column) -> Column:
    """Join rows the cost model expects of ``vehicles`` journeys past ``k`` cameras."""
    all_pairs = F.call_function("div", vehicles * k * (k - 1), F.lit(2))
    return F.when(strategy == ADJACENT, vehicles * (k - 1)).otherwise(all_pairs)


def join_cost(events: DataFrame, vehicles_by_k: DataFrame, k_of_lane: DataFrame, **options) -> DataFrame:
    """Per camera count and strategy: output rows, the model's rows, and the surplus ratio.

    ``k_of_lane`` maps lanes to their camera count, ``vehicles_by_k`` counts the journeys. The
    pairs of neighbouring cameras are counted among all pairs, so the join runs once.
    """
    per_lane = offending_segments(events, ALL_PAIRS, **options).groupBy("lane_id").agg(
        F.count_if(F.col("steps") == 1).alias("_adjacent"), F.count(F.lit(1)).alias("_all")
    )
    by_k = k_of_lane.join(per_lane, "lane_id").groupBy("k").agg(
        F.sum("_adjacent").alias("_adjacent"), F.sum("_all").alias("_all")
    )
    rows = F.array(
        F.struct(F.lit(ADJACENT).alias("strategy"), F.col("_adjacent").alias("join_rows")),
        F.struct(F.lit(ALL_PAIRS).alias("strategy"), F.col("_all").alias("join_rows")),
    )
    flat = by_k.join(vehicles_by_k, "k").select("k", "vehicles", "_adjacent", F.inline(rows))
    return flat.select(
        "k", "vehicles", "strategy", "join_rows",
        modelled_pairs(F.col("strategy"), F.col("k"), F.col("vehicles")).alias("expected_rows"),
        (F.col("join_rows") / F.col("_adjacent")).alias("surplus"),
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key; combines before the shuffle."""
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("_row"))
    return newest.select("_row.*")
