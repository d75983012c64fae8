"""Whitening of embeddings: principal components by QDWH spectral divide and conquer.

An entry ``c`` becomes the whole number ``x = floor(64 c) + 1000000``. Each distinct ``x`` vector is one row of
the fit; its sums are exact, and its covariance is summed in the tasks from centred rows.

**Components.** ``V - s I`` is split into its polar factors by the dynamically weighted Halley iteration (QDWH,
steps by QR while ill-conditioned, by Cholesky after), with ``s`` the mean eigenvalue. ``(I + U) / 2`` is the
projector on the eigenvectors with eigenvalues above ``s``. An orthonormal basis of it and of its complement
splits ``V`` into two smaller matrices, and so on down to single components; only branches that hold wanted
components are followed. This is work of ``width`` cubed on one matrix in the driver. The rows are whitened in
the tasks with the broadcast components, ``width`` times 16 numbers. Beside these the driver holds one
covariance of ``width`` squared and the sums of ``width``, whatever the number of rows.

Defined results: vectors that are null or hold a null or an entry that is not finite give no row, and none
counts in the fit; empty vectors have no components; repeated rows each give their rows and count once in the
fit; vectors of several widths are fitted and whitened each with those of their width; entries beyond
``2**52 / 64`` count as that number; a ``deviation`` beyond 64 bits is null; components whose eigenvalue is not
over ``1e-10`` of the largest (none at all, if all vectors are equal) cannot be whitened in double precision and
are left out; a kept column with the name of an added one is replaced; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lanewarden.llm.batches import small_batches
from lanewarden.llm.filters import unused
from lanewarden.session import materialize

SCALE, SHIFT = 64.0, 1_000_000
LARGEST = float(1 << 52)
RESOLUTION = 1e-10
_EPS = np.finfo(float).eps


# --- the components of one matrix ------------------------------------------------------------

def polar(a: np.ndarray, most: int = 40) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by dynamically weighted Halley iterations."""
    m = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = 1.0 / (np.linalg.norm(np.linalg.inv(x), 1) * np.sqrt(m))
    except np.linalg.LinAlgError:
        low = _EPS
    low = min(max(low, _EPS), 1.0)
    eye = np.eye(m)
    for _ in range(most):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        p = root + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * root)))
        q = (p - 1) ** 2 / 4
        r = p + q - 1
        if r > 100:
            both = np.linalg.qr(np.vstack([np.sqrt(r) * x, eye]))[0]
            nearer = q / r * x + (p - q / r) / np.sqrt(r) * both[:m] @ both[m:].T
        else:
            factor = np.linalg.cholesky(eye + r * x.T @ x)
            solved = np.linalg.solve(factor.T, np.linalg.solve(factor, x.T)).T
            nearer = q / r * x + (p - q / r) * solved
        nearer = (nearer + nearer.T) / 2
        moved = np.linalg.norm(nearer - x)
        x, low = nearer, min(1.0, low * (p + q * square) / (1 + r * square))
        if moved <= np.sqrt(m) * np.cbrt(_EPS) * 0.01 and 1 - low <= 10 * _EPS:
            break
    return x


def _split(a: np.ndarray, scale: float, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of two invariant subspaces: of the larger eigenvalues and of the others."""
    m, diagonal = len(a), np.sort(np.diag(a))
    best = None
    # The mean has eigenvalues on either side; other shifts serve where one lies too near to it.
    for shift in [np.trace(a) / m, *((diagonal[:-1] + diagonal[1:]) / 2)[np.argsort(diagonal[:-1] - diagonal[1:])][:8]]:
        factor = polar(a - shift * np.eye(m))
        projector = (np.eye(m) + factor) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < m:
            continue
        basis = np.linalg.qr(projector @ rng.normal(size=(m, rank)))[0]
        whole = np.linalg.qr(projector @ basis, mode="complete")[0]
        upper, lower = whole[:, :rank], whole[:, rank:]
        left = np.linalg.norm(lower.T @ a @ upper)
        if best is None or left < best[0]:
            best = (left, upper, lower)
        if left <= 10 * m * _EPS * scale:
            break
    if best is None:
        # Eigenvalues that no shift tells apart are equal at this precision: any basis will do.
        return np.eye(m)[:, :1], np.eye(m)[:, 1:]
    return best[1], best[2]


def components(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``most`` largest eigenvalues of a symmetric matrix, falling, and their vectors as columns."""
    scale, rng = max(np.linalg.norm(a), np.finfo(float).tiny), np.random.default_rng(0)
    values: list[float] = []
    vectors: list[np.ndarray] = []
    todo = [(a, np.eye(len(a)))]
    while todo and len(values) < most:
        part, basis = todo.pop()
        off = part - np.diag(np.diag(part))
        if len(part) == 1 or np.linalg.norm(off) <= 4 * _EPS * scale:
            order = np.argsort(-np.diag(part), kind="stable")
            values += np.diag(part)[order].tolist()
            vectors += [basis[:, i] for i in order]
            continue
        upper, lower = _split(part, scale, rng)
        for side in (lower, upper):
            inner = side.T @ part @ side
            todo.append(((inner + inner.T) / 2, basis @ side))
    found = np.linalg.qr(np.array(vectors).T)[0][:, :most]
    values_ = np.einsum("ij,ij->j", found, a @ found)
    order = np.argsort(-values_, kind="stable")
    return values_[order], found[:, order]


# --- rows as whole numbers -------------------------------------------------------------------

def _whole_numbers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per width: the places of the usable vectors, and their ``x`` as a matrix."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    row = np.repeat(np.arange(len(lengths)), lengths)
    usable = np.bincount(row[~np.isfinite(values)], minlength=len(lengths)) == 0
    usable &= lengths > 0
    for width in np.unique(lengths[usable]):
        at = np.flatnonzero(usable & (lengths == width))
        entries = values[(ends[at] - width)[:, None] + np.arange(width)]
        yield at, np.floor(np.clip(entries * SCALE, -LARGEST, LARGEST)).astype(np.int64) + SHIFT


class Centre:
    """The number of fit rows and their exact sums; rows minus their mean."""

    def __init__(self, n: int, sums: Sequence[int]):
        self.n = n
        parts = [divmod(s, n) for s in sums]
        self.whole = np.array([w for w, _ in parts], np.int64)
        self.rest = np.array([r for _, r in parts], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Sums of ``(n x - S)**2``, exact; null beyond 64 bits."""
        off = x - self.whole
        most = (int(np.abs(off).max(initial=0)) + 1) * self.n
        if most * most * max(1, x.shape[1]) < 1 << 63:
            return pa.array(((off * self.n - self.rest) ** 2).sum(1), pa.int64())
        rest = self.rest.tolist()
        exact = [sum((self.n * a - b) ** 2 for a, b in zip(row, rest)) for row in off.tolist()]
        return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def _fit_rows(vectors: DataFrame, column: str) -> DataFrame:
    """``width, x`` of the distinct vectors, ``x`` as little-endian 64-bit numbers, as a stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, x in _whole_numbers(batch.column(0)):
                body = pa.array([row.tobytes() for row in x.astype("<i8")], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), x.shape[1], np.int32)), body], ["width", "x"])

    return materialize(vectors.select(column).mapInArrow(run, "width int, x binary").distinct(), "whitening-fit")


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Per width the fit rows of a batch."""
    widths = batch.column(0).to_numpy(zero_copy_only=False)
    for width in np.unique(widths):
        some = batch.column(1).filter(pa.array(widths == width))
        yield int(width), np.frombuffer(b"".join(some.to_pylist()), "<i8").reshape(-1, int(width))


def _summed(fit: DataFrame, partial, shape) -> dict[int, np.ndarray]:
    """Per width the sum over the fit of ``partial(width, x)``, a vector of ``shape(width)`` numbers.

    A task adds up its rows and gives one row per width; the sums of tasks meet by place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, x in _matrices(batch):
                part = partial(width, x)
                totals[width] = totals[width] + part if width in totals else part
        for width, total in totals.items():
            yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], ["width", "part"])

    parts = fit.mapInArrow(run, "width int, part array<double>").select("width", F.posexplode("part").alias("at", "v"))
    table = parts.groupBy("width", "at").agg(F.sum("v").alias("v")).toArrow()
    out: dict[int, np.ndarray] = {}
    widths, at, v = (table.column(c).to_numpy() for c in ("width", "at", "v"))
    for width in np.unique(widths):
        here = widths == width
        out[int(width)] = np.zeros(shape(int(width)))
        out[int(width)][at[here]] = v[here]
    return out


def _centres(fit: DataFrame) -> dict[int, Centre]:
    """Per width the exact count and sums: high and low halves are added apart, so that none overflows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for batch in batches:
            for width, x in _matrices(batch):
                high, low = (x >> 32).sum(0), (x & 0xFFFFFFFF).sum(0)
                n, h, l_ = totals.get(width, (0, 0, 0))
                totals[width] = [n + len(x), h + high, l_ + low]
        for width, (n, high, low) in totals.items():
            columns = [pa.array([width], pa.int32()), pa.array([n]), pa.array([high.tolist()]), pa.array([low.tolist()])]
            yield pa.RecordBatch.from_arrays(columns, ["width", "n", "high", "low"])

    parts = fit.mapInArrow(run, "width int, n long, high array<long>, low array<long>")
    each = parts.select("width", "n", F.posexplode(F.arrays_zip("high", "low")).alias("at", "s"))
    exact = "decimal(38,0)"
    sums = each.groupBy("width", "at").agg(
        F.sum(F.col("n").cast(exact)).alias("n"), F.sum(F.col("s.high").cast(exact)).alias("high"), F.sum(F.col("s.low").cast(exact)).alias("low")
    )
    found: dict[int, dict[int, tuple[int, int]]] = {}
    for row in sums.collect():
        total = (int(row["high"]) << 32) + int(row["low"])
        found.setdefault(row["width"], {})[row["at"]] = (int(row["n"]), total)
    return {w: Centre(each[0][0], [each[i][1] for i in range(w)]) for w, each in found.items()}


def whiten(vectors: DataFrame, column: str = "embedding", *, keep: Sequence[str] | None = None, most: int = 16) -> DataFrame:
    """``keep`` columns (all by default) with ``n``, ``deviation``, the arrays ``whitened`` and ``explained`` (a
    number for each component, by falling eigenvalue) and ``identity_error``: one row per usable vector."""
    spark = vectors.sparkSession
    small_batches(spark)
    fit = _fit_rows(vectors, column)
    centres = _centres(fit)
    sent = spark.sparkContext.broadcast(centres)

    def products(width: int, x: np.ndarray) -> np.ndarray:
        rows = sent.value[width].centred(x)
        return (rows.T @ rows)[np.triu_indices(width)]

    models: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for width, upper in _summed(fit, products, lambda w: w * (w + 1) // 2).items():
        covariance = np.zeros((width, width))
        covariance[np.triu_indices(width)] = upper / centres[width].n
        covariance += np.triu(covariance, 1).T
        values, columns = components(covariance, min(most, width))
        good = (values > RESOLUTION * values.max()) & (values > 0)
        models[width] = (columns[:, good] / np.sqrt(values[good]), values[good] / max(np.trace(covariance), np.finfo(float).tiny))
    model = spark.sparkContext.broadcast(models)

    def whitened_products(width: int, x: np.ndarray) -> np.ndarray:
        rows = sent.value[width].centred(x) @ model.value[width][0]
        return (rows.T @ rows).ravel()

    errors: dict[int, float] = {}
    for width, flat in _summed(fit, whitened_products, lambda w: models[w][0].shape[1] ** 2).items():
        k = models[width][0].shape[1]
        errors[width] = float(np.abs(flat.reshape(k, k) / centres[width].n - np.eye(k)).max(initial=0))

    added = T.StructType.fromDDL("n long, deviation long, whitened array<double>, explained array<double>, identity_error double")
    kept = [c for c in (vectors.columns if keep is None else keep) if c not in added.names]
    schema = T.StructType([vectors.schema[c] for c in kept] + added.fields)
    new = [pa.field(f.name, to_arrow_type(f.dataType)) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(batch.num_columns - 1)
            for at, x in _whole_numbers(rows):
                width, centre = x.shape[1], sent.value[x.shape[1]]
                directions, explained = model.value[width]
                if not directions.shape[1]:
                    continue
                values = centre.centred(x) @ directions
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(at) + 1, dtype=np.int32) * values.shape[1]), pa.array(values.ravel())
                )
                shared = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(at) + 1, dtype=np.int32) * values.shape[1]), pa.array(np.tile(explained, len(at)))
                )
                columns = [
                    pa.array(np.full(len(at), centre.n)), centre.deviations(x), lists, shared,
                    pa.array(np.full(len(at), errors[width])),
                ]
                taken = [batch.column(i).take(pa.array(at)) for i in range(len(kept))]
                fields = [batch.schema.field(i) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(taken + columns, schema=pa.schema(fields + new))

    return vectors.select(*kept, F.col(column).alias(unused("_vector", kept))).mapInArrow(run, schema)


def by_component(whitened: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    each = whitened.select(*keep, "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "x"))
    return each.select(
        *keep, (F.col("at") + 1).alias("component"), "n", "deviation", F.col("x.whitened").alias("whitened"),
        F.col("x.explained").alias("explained"), "identity_error",
    )
