"""Best-fit packing of token pieces into sequences, with certified bin counts.

**Pieces.** A document's ids are its tokens and one end id. Only a document longer than a sequence is
cut, into full pieces and a rest. Words are tokenised once per worker and kept, since words never
interact across a blank or a line break under this vocabulary's pattern.

**Packing.** Pieces are dealt to partitions of a bounded number of pieces. Each is packed by
best-fit decreasing, and dual feasible functions over its histogram of lengths give a lower bound of
the bins it needs. Bins that are full are final. What lies in the others is what partitions exchange:
if a partition misses its bound, all its unfull bins are opened, else only its loose ones (more than
``1/16`` free). The pieces of opened bins are dealt anew to fewer partitions and packed again.
It ends when the bins in all equal the bound of the whole table, or when all open pieces have met in
one partition, or a round gains nothing. The driver sees one histogram of at most
``capacity`` lengths and three numbers a round.

Defined results: a null text is empty and gives a piece that holds the end id alone; rows that
repeat a document give pieces of their own; an empty table gives no rows.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lanewarden.llm.batches import small_batches
from lanewarden.llm.filters import unused
from lanewarden.session import materialize

CAPACITY = 4096
PARTITION_PIECES = 50_000
LOOSE = 1 / 16
MAX_ROUNDS = 6
CACHED_WORDS = 1_000_000
_MARKS = ".,;:!?&%$#*|"

Encoder = Callable[[list[str]], list[bytes]]
_encoders: dict[str, Encoder] = {}


def word_encoder(path: str) -> Encoder:
    """A function from texts to their ids as little-endian 32-bit bytes, without special tokens.

    Exact for vocabularies whose pattern removes white space and never joins letters with marks.
    """
    if path in _encoders:
        return _encoders[path]
    # Tasks are the parallel units; threads of the tokenizer would only wait for one another.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    vocabulary = tokenizer.get_vocab()
    final = np.zeros(max(vocabulary.values()) + 1, bool)
    final[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
    known: dict[str, bytes] = {"": b""}
    alone: dict[str, bool] = {}

    def encode(words: list[str]) -> dict[str, bytes]:
        """Ids of each word. Words of letters are one unit each, so they can be told apart in one run."""
        plain = [w for w in words if w.isalpha()]
        groups = [plain[at : at + 1000] for at in range(0, len(plain), 1000)]
        found: dict[str, bytes] = {}
        for some, x in zip(groups, tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(x.ids, "<u4")
            ends = 4 * (np.flatnonzero(final[ids]) + 1)
            if len(ends) == len(some):
                whole, cuts = ids.tobytes(), [0, *ends.tolist()]
                found.update(zip(some, [whole[a:b] for a, b in zip(cuts, cuts[1:])]))
        rest = [w for w in words if w not in found]
        for word, x in zip(rest, tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            found[word] = np.array(x.ids, "<u4").tobytes()
        return found

    def ends_a_unit(stem: str) -> bool:
        """Whether a mark after ``stem`` is a unit of its own; folding may leave a combining mark, which joins it.

        What a letter or digit folds to ends alike whatever stands before it.
        """
        last = stem[-1:]
        if not last.isalnum():
            return False
        if last not in alone:
            units = tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(f"a{last}."))
            alone[last] = units[-1][0] == "."
        return alone[last]

    def split(word: str) -> tuple[str, str]:
        """A word's stem and the marks after it, which never share a token."""
        if "<|" in word:
            # Perhaps a special token, which is told by its very characters.
            return word, ""
        stem = word.rstrip(_MARKS)
        if len(stem) < len(word) and not ends_a_unit(stem):
            stem = word
        return (stem.lower() if stem.isascii() else stem), word[len(stem) :]

    def encode_texts(texts: list[str]) -> list[bytes]:
        words = [text.replace("\n", " ").split(" ") for text in texts]
        new = set().union(*words) - known.keys()
        if len(known) + len(new) > CACHED_WORDS:
            known.clear()
            known[""] = b""
            new = set().union(*words) - known.keys()
        parts = {word: split(word) for word in new}
        fresh = encode(list({p for pair in parts.values() for p in pair} - known.keys()))
        for word, (stem, tail) in parts.items():
            first = fresh[stem] if stem in fresh else known[stem]
            known[word] = first + (fresh[tail] if tail in fresh else known[tail]) if tail else first
        known.update(fresh)
        out = [b"".join(map(known.__getitem__, some)) for some in words]
        for word in parts.keys() | fresh.keys():
            if len(word) > 64:
                del known[word]
        return out

    _encoders[path] = encode_texts
    return encode_texts


def tokenize(
    docs: DataFrame, path: str, *, end_id: int = 1, capacity: int = CAPACITY, with_ids: bool = False,
    text: str = "text", key: str = "doc_id",
) -> DataFrame:
    """The pieces of each document: ``key, piece, start, length, ids_crc32`` and, on request, ``ids``."""
    small_batches(docs.sparkSession)
    names = [key, "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_encoder(path)
        for batch in batches:
            rows, piece, start, length, crc, ids = [], [], [], [], [], []
            texts = [body or "" for body in batch.column(1).to_pylist()]
            for row, body in enumerate(encode(texts)):
                whole = body + tail
                for at in range(0, len(whole), 4 * capacity):
                    part = whole[at : at + 4 * capacity]
                    rows.append(row)
                    piece.append(at // (4 * capacity))
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4"))
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            if with_ids:
                columns.append(pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return docs.select(key, text).mapInArrow(run, schema)


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Bins that pieces with ``counts[length]`` need at least, from two families of dual feasible functions.

    A dual feasible function maps lengths so that no set that fits one bin maps to more than one
    bin; the mapped total is then a bound. ``cut`` drops lengths under a threshold and rounds those
    over ``capacity - threshold`` up to a full bin; ``step(k)`` rounds to multiples of ``1/k``.
    Both are taken alone and one after the other, in exact whole numbers.
    """
    sizes = np.flatnonzero(counts)
    if len(sizes) == 0:
        return 0
    number = counts[sizes].astype(object)
    best = -(-int((sizes.astype(object) * number).sum()) // capacity)
    thresholds = np.unique(np.concatenate([[0], sizes[sizes <= capacity // 2]]))
    if len(thresholds) > 128:
        thresholds = thresholds[np.linspace(0, len(thresholds) - 1, 128).astype(int)]
    weight = counts[sizes].astype(np.float64)
    for low in thresholds:
        cut = np.where(sizes < low, 0, np.where(sizes > capacity - low, capacity, sizes)) if low else sizes
        for k in (0, *range(1, 21)):
            if k:
                scaled = (k + 1) * cut
                mapped = np.where(scaled % capacity == 0, cut * k, (scaled // capacity) * capacity)
                whole = capacity * k
            else:
                mapped, whole = cut, capacity
            # Floats pick out the bounds worth an exact sum.
            if (mapped * weight).sum() / whole > best - 1e-6:
                total = int((mapped.astype(object) * number).sum())
                best = max(best, -(-total // whole))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bin and offset of each piece, and the fill of each bin.

    Open bins stand in stacks by free space, and one big integer has a bit for each space with a
    bin, so the tightest bin that fits is the lowest bit from the piece's length on.
    """
    place = np.zeros(len(lengths), np.int64)
    offset = np.zeros(len(lengths), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    spaces, fills = 0, []
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fitting = spaces >> size
        if fitting:
            free = size + (fitting & -fitting).bit_length() - 1
            chosen = stacks[free].pop()
            if not stacks[free]:
                spaces ^= 1 << free
        else:
            free, chosen = capacity, len(fills)
            fills.append(0)
        place[i], offset[i] = chosen, fills[chosen]
        fills[chosen] += size
        left = free - size
        if left:
            if not stacks[left]:
                spaces |= 1 << left
            stacks[left].append(chosen)
    return place, offset, np.array(fills, np.int64)


def _packer(capacity: int, round_: int, part: str, open_: str) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        lengths = pdf["length"].to_numpy(np.int64)
        place, offset, fills = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(np.bincount(lengths, minlength=capacity + 1), capacity)
        loose = fills < capacity if len(fills) > bound else fills < capacity * (1 - LOOSE)
        pdf["sequence_id"] = (round_ << 58) + (int(pdf[part].iloc[0]) << 30) + place
        pdf["offset"] = offset
        pdf[open_] = loose[place]
        return pdf

    return packed


def pack(pieces: DataFrame, *, capacity: int = CAPACITY, partition_pieces: int = PARTITION_PIECES) -> DataFrame:
    """``pieces`` (any columns, and ``length`` in 1..capacity) with ``sequence_id`` and ``offset``.

    Columns that have these two names already are replaced. Pieces are dealt by their place in a stored
    copy, so equal ones spread like any others.
    """
    columns = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    row, part, open_ = (unused(name, columns) for name in ("_row", "_part", "_open"))
    pieces = materialize(pieces.select(*columns, F.monotonically_increasing_id().alias(row)), "pieces")
    histogram = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(capacity + 1, np.int64)
    for each in histogram:
        counts[each["length"]] = each["n"]
    goal, open_pieces = lower_bound(counts, capacity), int(counts.sum())
    schema = pieces.limit(0).select(
        "*", F.lit(0).alias(part), F.lit(0).cast("long").alias("sequence_id"), F.lit(0).cast("long").alias("offset"), F.lit(True).alias(open_)
    ).schema
    closed, closed_bins, best = None, 0, None
    todo = pieces
    for round_ in range(MAX_ROUNDS):
        parts = max(1, -(-open_pieces // partition_pieces))
        dealt = todo.withColumn(part, F.pmod(F.xxhash64(F.lit(round_), row), F.lit(parts)).cast("int"))
        result = materialize(dealt.groupBy(part).applyInPandas(_packer(capacity, round_, part, open_), schema), "packed")
        bins, open_bins, open_pieces = result.agg(
            F.count(F.when(F.col("offset") == 0, 1)),
            F.count(F.when((F.col("offset") == 0) & F.col(open_), 1)),
            F.count(F.when(F.col(open_), 1)),
        ).first()
        total = closed_bins + bins
        if best is not None and total >= best[0]:
            break
        best = (total, result if closed is None else closed.unionByName(result))
        if total == goal or parts == 1 or not open_bins:
            break
        kept = result.where(~F.col(open_))
        closed = kept if closed is None else closed.unionByName(kept)
        closed_bins += bins - open_bins
        todo = result.where(open_).select(*columns, row)
    return best[1].select(*columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The token sequences of packed pieces that carry ``ids``: ``sequence_id, length, ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("length"), F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids")
    )
