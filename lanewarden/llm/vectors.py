"""Near-duplicate vectors by cosine: quantised tile products with exact rechecks.

Unit vectors are cut into tiles of ``TILE`` rows, ordered by their nearest pivot so that a tile
covers little of the sphere. For each pair of tiles the products of int8 codes are taken with a
matrix multiply (over 1024 numbers at a time: whole numbers below 2**24, so single precision is exact). With ``x = s*q + e``,

    |x.y - s_x*s_y*(q_x.q_y)| <= |e_x| * |s_y*q_y| + |e_y|    (as |x| = 1),

so a pair whose estimate plus this bound stays under the threshold has no link, one whose estimate
less the bound reaches it has one, and only the rest is recomputed in double precision. Tile pairs
whose centres are further apart than their radii and the threshold's angle allow are never formed.

Equal vectors form a class with a count; a tile pair returns per vector the number of links (weighted
by class size) and links that span the connected parts, never all pairs.

Vectors are stored and shuffled packed, in single precision where the column has it, and only until their
tiles are stored; from then on a class goes by its number or by the SHA-256 of its bytes. Each task reads the two parts of
the table of tiles that it pairs, so no tile is shuffled or copied and the disk needed grows with the rows.

Vectors are compared with those of their own length, one round of the above per length.

Defined results: vectors that are null, empty, zero, or hold null or non-finite numbers link with
nothing; rows with a null vec_id count as links of others but have no component; rows that repeat a
vec_id count row by row; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lanewarden.llm.batches import small_batches
from lanewarden.llm.components import connected_components
from lanewarden.session import materialize

TILE = 2048
PIVOTS = 128
_SLACK = 1e-9
# More than single precision can be off by in an estimate.
_LOOSE = 1e-4
# So many products of codes, at most 127 * 127 each, stay below 2**24.
_EXACT = 1024
# A file of tiles has so many bytes at most (one tile at least), so that readers deal them out evenly.
_FILE_BYTES = 4 << 20
_DIGEST = 32
# Parts in which the classes are sorted and cut into tiles: one for four tiles, so many at most.
_MOST_SPANS = 1024


def _unit_rows(packed: bytes, width: int, number: type) -> np.ndarray:
    flat = np.frombuffer(packed, number).astype(np.float64).reshape(-1, width)
    flat /= np.abs(flat).max(axis=1, keepdims=True)
    return flat / np.linalg.norm(flat, axis=1, keepdims=True)


def quantise(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales and error lengths of unit rows."""
    scale = np.abs(units).max(axis=1) / 127
    codes = np.rint(units / scale[:, None])
    return codes.astype(np.int8), scale, np.linalg.norm(units - codes * scale[:, None], axis=1)


class Tile:
    """Unit rows with their codes, error lengths, class sizes and numbers."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, units: np.ndarray):
        self.ids, self.weights, self.units = ids, weights, units
        codes, self.scale, self.error = quantise(units)
        self.codes = codes.astype(np.float32)
        self.length = 1 + self.error


def tile_links(a: Tile, b: Tile, same: bool, threshold: float, step: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of linked rows, each pair once (``i < j`` within one tile)."""
    scale, length, error = b.scale.astype(np.float32), b.length.max(initial=0), b.error.max(initial=0)
    for low in range(0, len(a.ids), step):
        rows = slice(low, low + step)
        if a.codes.shape[1] <= _EXACT:
            product = a.codes[rows] @ b.codes.T
        else:
            product = np.zeros((len(a.codes[rows]), len(b.ids)))
            for part in range(0, a.codes.shape[1], _EXACT):
                product += a.codes[rows, part : part + _EXACT] @ b.codes[:, part : part + _EXACT].T
        # One test in single precision, with the tile's largest bound, leaves out most pairs.
        least = (threshold - a.error[rows] * length - error - _LOOSE) / a.scale[rows]
        i, j = np.nonzero(product * scale[None, :] >= least.astype(np.float32)[:, None])
        estimate = product[i, j] * a.scale[i + low] * b.scale[j]
        bound = a.error[i + low] * b.length[j] + b.error[j] + _SLACK
        close = estimate + bound >= threshold
        i, j, estimate, bound = i[close], j[close], estimate[close], bound[close]
        if same:
            upper = i + low < j
            i, j, estimate, bound = i[upper], j[upper], estimate[upper], bound[upper]
        sure = estimate - bound >= threshold
        for at in range(0, len(i), 1 << 16):
            part = slice(at, at + (1 << 16))
            unsure = np.flatnonzero(~sure[part]) + at
            exact = np.einsum("ij,ij->i", a.units[i[unsure] + low], b.units[j[unsure]])
            sure[unsure] = exact >= threshold
        yield i[sure] + low, j[sure]


def _spanning(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least index that each of ``n`` nodes is connected to."""
    least = np.arange(n)
    if not pairs:
        return least
    u, v = (np.concatenate(x) for x in zip(*pairs))
    while True:
        low = np.minimum(least[u], least[v])
        before = least.copy()
        np.minimum.at(least, u, low)
        np.minimum.at(least, v, low)
        np.minimum.at(least, before, least)
        least = least[least]
        if np.array_equal(least, before):
            return least


def _classes(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """``vec_id`` and ``values``, the doubles (null if the row links with nothing)."""
    values = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.col(vector).isNotNull() & finite & F.exists(values, lambda x: x != 0)
    rows = vectors.select(F.col(key).alias("vec_id"), F.when(good, values).alias("values"))
    # Vectors are told apart exactly and can be grouped by; -0.0 equals 0.0.
    return rows.select("vec_id", F.transform("values", lambda x: x + F.lit(0.0)).alias("values"))


def _packed(rows: DataFrame, number: type) -> DataFrame:
    """``vec_id``, the bytes of the vector, and their SHA-256 (both null if the row links with nothing)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("values")
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(number)
            ends = np.cumsum(np.asarray(column.value_lengths().fill_null(0)))
            bodies = [flat[e - n.as_py() : e].tobytes() if n.is_valid else None for e, n in zip(ends, column.value_lengths())]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(bodies, pa.binary())], ["vec_id", "packed"])

    schema = T.StructType([rows.schema["vec_id"], T.StructField("packed", T.BinaryType())])
    packed = rows.mapInArrow(pack, schema)
    return packed.withColumn("digest", F.unhex(F.sha2("packed", 256)))


def near_vectors(
    vectors: DataFrame, *, threshold: float = 0.9, key: str = "vec_id", vector: str = "embedding", tile: int = TILE
) -> DataFrame:
    """``key, n_links, component_id, kept`` for each row."""
    spark = vectors.sparkSession
    small_batches(spark)
    number = np.float32 if isinstance(vectors.schema[vector].dataType.elementType, T.FloatType) else np.float64
    rows = materialize(_packed(_classes(vectors, key, vector), number), "vectors")
    widths = rows.where("packed is not null").select(F.length("packed").alias("bytes")).distinct().collect()
    answers = [_width_links(rows, r["bytes"] // np.dtype(number).itemsize, number, threshold, tile) for r in sorted(widths)]
    answer = answers[0] if answers else rows.limit(0).select("digest", F.lit(0).alias("component_id"), F.lit(0).alias("n_links"))
    for other in answers[1:]:
        answer = answer.unionByName(other)
    found = rows.select("vec_id", "digest").join(answer, "digest", "left")
    component_id = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return found.select(
        F.col("vec_id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"), F.coalesce(component_id == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


_TILES = (
    "tile long, centre array<double>, radius double, numbers binary, weights binary, least array<long>, digests binary, packed binary"
)


def _width_links(rows: DataFrame, width: int, number: type, threshold: float, tile: int) -> DataFrame:
    """``digest, component_id, n_links`` of the classes of rows whose vectors have ``width`` numbers."""
    spark = rows.sparkSession
    usable = rows.where(F.length("packed") == width * np.dtype(number).itemsize)
    grouped = usable.groupBy("packed").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").cast("long").alias("least"))
    pivots = [r["packed"] for r in usable.select("packed", "digest").orderBy("digest").limit(PIVOTS).collect()]
    shared = spark.sparkContext.broadcast(_unit_rows(b"".join(pivots), width, number))

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _unit_rows(b"".join(batch.column("packed").to_pylist()), width, number) @ shared.value.T
            best = near.argmax(axis=1)
            added = [pa.array(best.astype(np.int32)), pa.array(near[np.arange(len(best)), best])]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "pivot", "near"])

    sided = grouped.mapInArrow(nearest, "packed binary, weight long, least long, pivot int, near double")
    sided = sided.withColumn("digest", F.unhex(F.sha2("packed", 256)))

    def build(batch: pa.RecordBatch, first: int) -> pa.RecordBatch:
        packed = b"".join(batch.column("packed").to_pylist())
        units = _unit_rows(packed, width, number)
        centre = units.mean(axis=0)
        centre /= max(np.linalg.norm(centre), 1e-300)
        radius = float(np.arccos(np.clip((units @ centre).min(), -1, 1)))
        body = {
            "tile": first, "centre": centre.tolist(), "radius": radius,
            "numbers": np.arange(first, first + len(units)).tobytes(),
            "weights": batch.column("weight").to_numpy().astype(np.int64).tobytes(), "least": batch.column("least").to_pylist(),
            "digests": b"".join(batch.column("digest").to_pylist()), "packed": packed,
        }
        return pa.RecordBatch.from_pylist([body], schema=arrow)

    arrow = to_arrow_schema(T.StructType.fromDDL(_TILES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        # Numbers of one partition follow one another, and those of the next start far beyond.
        at = TaskContext.get().partitionId() << 40
        for batch in batches:
            held.append(batch)
            while sum(len(x) for x in held) >= tile:
                ready = pa.concat_batches(held)
                yield build(pa.concat_batches([ready.slice(0, tile)]), at)
                at, held = at + tile, [ready.slice(tile)]
        if sum(len(x) for x in held):
            yield build(pa.concat_batches(held), at)

    n_classes = grouped.count()
    in_order = sided.repartitionByRange(max(1, min(_MOST_SPANS, n_classes // (4 * tile))), "pivot", "near", "digest")
    per_file = max(1, _FILE_BYTES // (tile * width * np.dtype(number).itemsize))
    tiles = materialize(
        in_order.sortWithinPartitions("pivot", "near", "digest").mapInArrow(cut, _TILES), "tiles", maxRecordsPerFile=per_file
    )
    edges, degrees = _tile_pairs(tiles, width, number, threshold)
    component = connected_components(edges)

    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for numbers, weights, least, digests in zip(*batch.columns):
                cells = digests.as_py()
                parts = [cells[x : x + _DIGEST] for x in range(0, len(cells), _DIGEST)]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(np.frombuffer(x.as_py(), np.int64)) for x in (numbers, weights)], least.values, pa.array(parts, pa.binary())],
                    ["number", "weight", "least", "digest"],
                )

    classes = tiles.select("numbers", "weights", "least", "digests").mapInArrow(
        apart, "number long, weight long, least long, digest binary"
    )
    linked = classes.join(degrees, "number", "left")
    linked = linked.join(component.withColumnRenamed("node", "number"), "number", "left")
    linked = materialize(linked.select("digest", "weight", "least", "links", F.coalesce("component", "number").alias("part")), "linked")
    lowest = linked.groupBy("part").agg(F.min("least").alias("component_id"))
    return linked.join(lowest, "part").select(
        "digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )


def _tile_pairs(tiles: DataFrame, width: int, number: type, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Spanning links ``u, v`` and ``number, links`` of all tile pairs that can hold a link."""
    body = tiles.select("tile", "centre", "radius", "numbers", "weights", "packed")
    first, second = (body.select([F.col(c).alias(f"{c}_{side}") for c in body.columns]) for side in "ij")
    dot = F.aggregate(F.zip_with("centre_i", "centre_j", lambda x, y: x * y), F.lit(0.0), lambda a, x: a + x)
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot)))
    near = angle - F.col("radius_i") - F.col("radius_j") <= float(np.arccos(threshold)) + 1e-6
    # Each pair once, in either order, so that tasks get as many pairs whichever parts of the table they meet.
    i, j = F.col("tile_i"), F.col("tile_j")
    once = (i < j) == (F.pmod(F.xxhash64(F.least(i, j), F.greatest(i, j)), F.lit(2)) == 0)
    # A product of the two scans: a task reads the two parts of the stored table that it pairs, nothing is shuffled.
    pairs = first.hint("shuffle_replicate_nl").join(second, (i == j) | ((i != j) & once & near))
    joined = pairs.select("tile_i", "tile_j", *[f"{c}_{side}" for side in "ij" for c in ("numbers", "weights", "packed")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, Tile] = {}
        for batch in batches:
            for row in range(batch.num_rows):

                def get(name: str):
                    return batch.column(name)[row].as_py()

                def side(name: str) -> Tile:
                    numbers, weights = (np.frombuffer(get(f"{x}_{name}"), np.int64) for x in ("numbers", "weights"))
                    return Tile(numbers, weights, _unit_rows(get(f"packed_{name}"), width, number))

                # Rows with one first tile follow one another.
                at, same = get("tile_i"), get("tile_i") == get("tile_j")
                if at not in known:
                    known = {at: side("i")}
                a = known[at]
                b = a if same else side("j")
                links_a, links_b = np.zeros(len(a.ids), np.int64), np.zeros(len(b.ids), np.int64)
                shift = 0 if same else len(a.ids)
                least = np.arange(shift + len(b.ids))
                for i, j in tile_links(a, b, same, threshold):
                    np.add.at(links_a, i, b.weights[j])
                    np.add.at(links_b, j, a.weights[i])
                    if len(i):
                        # Keep only what spans: each step's links, on top of the parts known so far.
                        least = _spanning(len(least), [(i, j + shift), (np.arange(len(least)), least)])
                numbers = a.ids if same else np.concatenate([a.ids, b.ids])
                links = links_a + links_b if same else np.concatenate([links_a, links_b])
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(numbers[some]), pa.array(numbers[least[some]]), pa.array(links[some])], ["u", "v", "links"]
                )

    found = materialize(joined.mapInArrow(run, "u long, v long, links long"), "tile-links")
    return found.select("u", "v"), found.groupBy(F.col("u").alias("number")).agg(F.sum("links").alias("links"))
