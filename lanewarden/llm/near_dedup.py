"""MinHash near-duplicate documents: banding, signature checks, full-set links, star components.

1. A text's set is its distinct shingles of consecutive words (the whole text if it is shorter).
   Equal sets form a class with its smallest doc_id; only class representatives go on.
2. ``ROWS * BANDS`` universal hashes ``a*x + b mod 2**32`` give minima; each band of minima is a key.
   A pair at 0.85 meets in no band with a probability of 3e-6.
3. A bucket of two is a pair: its signatures are compared, and it goes on if their agreement is
   within six standard deviations of the threshold. A larger bucket is a star around its smallest
   member, with no check, as its members may be alike while the centre is like none of them.
4. Components of these candidates are worked on as groups. A group of more than ``BLOCK_SHINGLES``
   shingles is split into blocks, and each pair of blocks is a unit of its own, so no task holds a
   group. Within a unit, prefixes of the rarest shingles find the pairs and the full sets confirm
   them; pairs already connected within the unit need no check. A unit returns at most one link per
   text and partner block, never all pairs.
5. Components of the confirmed links are the answer.

Defined results: a null or wordless text has an empty set and links with nothing; rows with a null
doc_id link with nothing (component null, kept); rows that repeat a doc_id count as one document;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewarden.llm.batches import SPACED, Words, add_columns, small_batches, utf8
from lanewarden.llm.components import connected_components
from lanewarden.llm.filters import possible_rows
from lanewarden.session import materialize

ROWS, BANDS = 8, 40
BLOCK_SHINGLES = 1_000_000
_SEED = 11

_SIGNED = T.StructType(
    [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_a", T.LongType()),
        T.StructField("set_b", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        T.StructField("minima", T.BinaryType()),
    ]
)


def _hash_family() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20240501)
    a = draw.integers(0, 1 << 32, (ROWS * BANDS, 1), np.uint64).astype(np.uint32) | np.uint32(1)
    return a, draw.integers(0, 1 << 32, (ROWS * BANDS, 1), np.uint64).astype(np.uint32)


def shingle_sets(words: Words, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    keys = {n: words.windows(n, _SEED + n) for n in range(1, k + 1)}
    for low, high in zip(words.first[:-1], words.first[1:]):
        n = min(k, high - low)
        yield np.unique(keys[n][low : high - n + 1]) if n else np.zeros(0, np.uint64)


def signatures(docs: DataFrame, k: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, set size, two hashes of the set, band keys, and the low byte of each minimum."""
    small_batches(docs.sparkSession)

    def compute(batch: pa.RecordBatch):
        a, b = _hash_family()
        turn = np.random.default_rng(3).integers(0, 1 << 63, (BANDS, ROWS), np.uint64) | np.uint64(1)
        sizes, set_a, set_b, bands, minima = [], [], [], [], []
        for found in shingle_sets(Words(*utf8(batch.column(text)), SPACED), k):
            sizes.append(len(found))
            set_a.append(int(found.sum(dtype=np.uint64).view(np.int64)))
            set_b.append(int((found * (found >> np.uint64(7) | np.uint64(1))).sum(dtype=np.uint64).view(np.int64)))
            if not len(found):
                bands.append([])
                minima.append(b"")
                continue
            x = (found >> np.uint64(32)).astype(np.uint32)[None, :]
            least = np.full((len(a), 1), 0xFFFFFFFF, np.uint32)
            for at in range(0, x.shape[1], 4096):
                np.minimum(least, (a * x[:, at : at + 4096] + b).min(axis=1, keepdims=True), out=least)
            rows = least.reshape(BANDS, ROWS).astype(np.uint64)
            folded = ((rows + np.uint64(1)) * turn).sum(axis=1, dtype=np.uint64)
            bands.append(folded.view(np.int64))
            minima.append(least.astype(np.uint8).tobytes())
        return sizes, set_a, set_b, bands, minima

    return add_columns(docs.select(key, text), [key], _SIGNED, compute)


def _agreement(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated similarity of rows of one-byte minima, freed of chance hits."""
    return ((a == b).mean(axis=1) - 1 / 256) / (1 - 1 / 256)


def _close_pairs(pairs: DataFrame, signed: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``u, v`` whose signatures leave the threshold possible."""
    floor = threshold - 6 * (threshold * (1 - threshold) / (ROWS * BANDS)) ** 0.5
    side = signed.select("id", "minima")
    both = pairs.join(side.select(F.col("id").alias("u"), F.col("minima").alias("a")), "u")
    both = both.join(side.select(F.col("id").alias("v"), F.col("minima").alias("b")), "v").select("u", "v", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, ROWS * BANDS) for c in (2, 3))
            yield batch.select(["u", "v"]).filter(pa.array(_agreement(a, b) >= floor))

    return both.mapInArrow(run, "u long, v long")


def candidate_groups(signed: DataFrame, threshold: float) -> DataFrame:
    """``node, component``: groups outside of which no representative can have a link."""
    bands = signed.select("id", F.explode(F.arrays_zip(F.sequence(F.lit(0), F.lit(BANDS - 1)), "bands")).alias("_b"))
    bands = bands.select("id", F.xxhash64("_b.*").alias("bucket"))
    tally = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("low"), F.max("id").alias("high"))
    tally = materialize(tally.where("n > 1"), "buckets")
    twos = tally.where("n = 2 and low < high").select(F.col("low").alias("u"), F.col("high").alias("v")).distinct()
    larger = tally.where("n > 2").select("bucket", F.col("low").alias("v"))
    stars = bands.join(larger, "bucket").where("id <> v").select(F.col("id").alias("u"), "v").distinct()
    return connected_components(_close_pairs(twos, signed, threshold).unionByName(stars))


def unit_links(ids: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all texts of a unit which a chain of links within it connects.

    ``100 * |a & b| >= percent * |a | b|`` is a link. A text is probed with the rarest
    ``n - ceil(n * percent / 100) + 1`` shingles of its set, one of which any partner must hold.
    Texts are taken from the most central one on, and those that its component has already taken
    in are left out as partners; the component of the first one is not probed further, since a link
    to it has another end that is.
    """
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    _, local, frequency = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), sizes)
    by_shingle = np.argsort(local, kind="stable")
    holders, begin = owner[by_shingle], np.concatenate([[0], np.cumsum(frequency)])
    ends = np.cumsum(sizes)
    own = [local[e - s : e] for s, e in zip(sizes, ends)]
    central = np.add.reduceat(frequency[local].astype(np.float64), ends - sizes) if n else np.zeros(0)
    component, links = np.arange(n), []

    def partners(i: int, shingles: np.ndarray) -> np.ndarray:
        return np.concatenate([holders[begin[s] : begin[s + 1]] for s in shingles])

    def alike(i: int, others: np.ndarray, common: np.ndarray) -> np.ndarray:
        return others[100 * common >= percent * (sizes[i] + sizes[others] - common)]

    def connect(i: int, others: np.ndarray) -> None:
        for j in others:
            if component[i] != component[j]:
                links.append((int(ids[i]), int(ids[j])))
                component[component == component[j]] = component[i]

    order = np.argsort(-central / np.maximum(sizes, 1), kind="stable")
    for at, i in enumerate(order):
        if at == 0:
            common = np.bincount(partners(i, own[i]), minlength=n)
            others = np.flatnonzero(common)
            connect(i, alike(i, others, common[others]))
            continue
        if component[i] == component[order[0]]:
            continue
        probe = own[i][np.argsort(frequency[own[i]], kind="stable")[: sizes[i] - -(-sizes[i] * percent // 100) + 1]]
        others = np.unique(partners(i, probe))
        others = others[component[others] != component[i]]
        others = others[(100 * sizes[others] >= percent * sizes[i]) & (100 * sizes[i] >= percent * sizes[others])]
        if len(others) > 32:
            common = np.bincount(partners(i, own[i]), minlength=n)[others]
        else:
            common = np.array([len(np.intersect1d(own[i], own[j], assume_unique=True)) for j in others], np.int64)
        connect(i, alike(i, others, common))
    return links


def _linked(members: DataFrame, docs: DataFrame, percent: int, k: int, key: str, text: str) -> DataFrame:
    """Confirmed links ``u, v`` within the groups of ``members(id, component, n_shingles)``."""
    weight = members.groupBy("component").agg(F.sum("n_shingles").alias("_all"))
    weight = weight.select("component", F.ceil(F.col("_all") / BLOCK_SHINGLES).cast("int").alias("_blocks"))
    placed = members.join(weight, "component").withColumn("_mine", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    wanted = possible_rows(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), placed, "id")
    texts = placed.hint("shuffle_merge").join(wanted, "id")
    other = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    units = texts.withColumn("_other", other).select(
        "component", F.least("_mine", "_other").alias("_i"), F.greatest("_mine", "_other").alias("_j"), "id", "text"
    )
    spread = units.repartition("component", "_i", "_j").sortWithinPartitions("component", "_i", "_j", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, ids, sets = None, [], []

        def solved() -> pa.RecordBatch:
            pairs = unit_links(np.array(ids, np.int64), sets, percent) if len(ids) > 1 else []
            u, v = zip(*pairs) if pairs else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in range(3)))
            found = shingle_sets(Words(*utf8(batch.column(4)), SPACED), k)
            for one, node, shingles in zip(keys, batch.column(3).to_pylist(), found):
                if one != unit:
                    if len(ids) > 1:
                        yield solved()
                    unit, ids, sets = one, [], []
                ids.append(node)
                sets.append(shingles)
        yield solved()

    return spread.mapInArrow(run, "u long, v long")


def near_duplicates(
    docs: DataFrame, *, k: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key, n_shingles, component_id, kept`` per row; one document of each component is kept."""
    signed = materialize(signatures(docs, k, key, text), "signed")
    sets = signed.select(F.col(key).alias("id"), "n_shingles", "set_a", "set_b")
    classes = sets.where("n_shingles > 0 and id is not null").groupBy("n_shingles", "set_a", "set_b").agg(F.min("id").alias("class"))
    classes = materialize(classes, "classes")
    chosen = classes.select(F.col("class").alias("id"), "set_a", "set_b")
    full = signed.select(F.col(key).alias("id"), "n_shingles", "set_a", "set_b", "bands", "minima")
    leaders = materialize(full.join(chosen, ["id", "set_a", "set_b"]).dropDuplicates(["id", "set_a", "set_b"]), "leaders")
    groups = candidate_groups(leaders, percent / 100).withColumnRenamed("node", "id")
    members = leaders.groupBy("id").agg(F.sum("n_shingles").alias("n_shingles")).join(groups, "id")
    members = materialize(members, "members")
    components = connected_components(_linked(members, docs, percent, k, key, text))
    components = components.select(F.col("node").alias("class"), "component")
    named = classes.join(components, "class", "left").select(
        "n_shingles", "set_a", "set_b", F.coalesce("component", "class").alias("component")
    )
    answered = sets.join(named, ["n_shingles", "set_a", "set_b"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return answered.select(
        F.col("id").alias(key), "n_shingles", component.alias("component_id"),
        F.coalesce(component == F.col("id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, *, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents of ``docs``, one row of each group of near-duplicates, with their own columns.

    Rows without a doc_id stay. Only rows that may be dropped are shuffled.
    """
    found = materialize(near_duplicates(docs, k=k, percent=percent), "near")
    dropped = found.where("not kept").select("doc_id").distinct()
    repeated = found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    touched = materialize(dropped.unionByName(repeated).distinct(), "touched")
    named, free = docs.where("doc_id is not null"), docs.where("doc_id is null")
    chosen = possible_rows(named, touched, "doc_id").join(dropped, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    clear = possible_rows(named, touched, "doc_id", others=True)
    return clear.unionByName(chosen.select(*docs.columns)).unionByName(free)
