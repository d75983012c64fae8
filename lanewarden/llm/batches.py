"""Arrow batches inside tasks: pass columns through, add computed ones, find words in bytes.

Text work runs on the UTF-8 bytes of a whole batch with numpy. Long texts are cut at word borders
while they are hashed, so a temporary array never grows with the longest text (but for one word
that is longer than the piece size).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

PIECE_BYTES = 1 << 20
BATCH_ROWS = 1024
BATCH_BYTES = 16 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes that one Arrow batch brings into a Python worker, for this session."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        conf = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(spark.conf.get(conf).removesuffix("b")) <= most:
            spark.conf.set(conf, str(most))


def merged(batches: Iterator[pa.RecordBatch], most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches joined to some of about ``most`` bytes, for work that gains from seeing repeats together."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def add_columns(
    df: DataFrame,
    keep: Sequence[str],
    added: T.StructType,
    compute: Callable[[pa.RecordBatch], Sequence],
) -> DataFrame:
    """``keep`` columns of ``df`` plus the ``added`` ones that ``compute`` returns per batch.

    An added column replaces a kept one of the same name.
    """
    names = {f.name for f in added.fields}
    kept = [c for c in keep if c not in names]
    schema = T.StructType([df.schema[c] for c in kept] + added.fields)
    new = [pa.field(f.name, to_arrow_type(f.dataType)) for f in added.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [pa.array(v, f.type) if not isinstance(v, pa.Array) else v for v, f in zip(compute(batch), new)]
            fields = [batch.schema.field(c) for c in kept]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in kept] + values, schema=pa.schema(fields + new))

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the ``n + 1`` offsets of its rows; null counts as empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Alphabet:
    """Which bytes belong to words, and what they are folded to (A-Z to a-z)."""

    def __init__(self, separators: Sequence[int]):
        self.word = np.ones(256, bool)
        self.word[list(separators)] = False
        self.fold = np.arange(256, dtype=np.uint8)
        self.fold[65:91] += 32
        # A-Z count as word bytes even where a separator range names them: folding comes first.
        self.word[65:91] = self.word[97:123]


#: Words are runs of digits, letters a-z and bytes of characters beyond ASCII.
PLAIN = Alphabet([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: Words are runs of anything but ASCII white space.
SPACED = Alphabet([0x20, *range(0x09, 0x0E)])

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n + 1:
        size = max(n + 1, PIECE_BYTES + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        if size > 4 * PIECE_BYTES:
            return tables[0], tables[1]
        _powers = (tables[0], tables[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a fixed bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of consecutive texts: byte ranges, 64-bit hashes, and where each text's begin."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet):
        self.data, self.offsets, self.alphabet = data, offsets, alphabet
        starts, ends, hashes = [], [], []
        for low, high in _pieces(data, offsets, alphabet):
            s, e, h = _hash_words(data[low:high], offsets[(offsets > low) & (offsets < high)] - low, alphabet)
            starts.append(s + low)
            ends.append(e + low)
            hashes.append(h)
        self.starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.ends = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.first = np.searchsorted(self.starts, offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def phrase(self, word: int, n: int) -> bytes:
        """``n`` folded words from ``word`` on, joined by a space."""
        fold = self.alphabet.fold
        return b" ".join(fold[self.data[self.starts[i] : self.ends[i]]].tobytes() for i in range(word, word + n))

    def windows(self, n: int, seed: int) -> np.ndarray:
        """Hashes of ``n`` consecutive words from each word on; those that cross texts mean nothing."""
        if len(self.hashes) < n:
            return np.zeros(0, np.uint64)
        size = len(self.hashes) - n + 1
        total = np.full(size, seed, np.uint64)
        for j in range(n):
            total *= _BASE
            total += self.hashes[j : j + size]
        return mix(total)


def dictionary(words: Words) -> tuple[pa.Array, np.ndarray]:
    """The distinct words of a batch, folded, and the number of each word's entry."""
    lengths = words.ends - words.starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    # Words are all runs of word bytes, in order, so their bytes are what is left without the separators.
    body = words.alphabet.fold[words.data[words.alphabet.word[words.data]]]
    spelled = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(body))]
    ).dictionary_encode()
    return spelled.dictionary.cast(pa.string()), spelled.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _pieces(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet) -> Iterator[tuple[int, int]]:
    """Byte ranges of about ``PIECE_BYTES`` that cut no word."""
    low, end = 0, len(data)
    while low < end:
        high = min(low + PIECE_BYTES, end)
        if high < end:
            at = offsets[np.searchsorted(offsets, high, "right") - 1]
            if at > low:
                high = int(at)
            else:
                gaps = np.flatnonzero(~alphabet.word[data[low:high]])
                if len(gaps):
                    high = low + int(gaps[-1]) + 1
                else:
                    limit = int(offsets[np.searchsorted(offsets, high, "left")])
                    while high < limit and alphabet.word[data[high]]:
                        high += 1
        yield low, high
        low = high


def _hash_words(data: np.ndarray, borders: np.ndarray, alphabet: Alphabet):
    inside = alphabet.word[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    before[borders] = False
    after[borders - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    up, down = _power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((alphabet.fold[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return starts, ends, mix((sums[ends] - sums[starts]) * down[starts])
