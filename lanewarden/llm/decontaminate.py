"""Benchmark decontamination: a broadcast hash set of test n-grams against document windows.

Texts are folded (A-Z to a-z) and cut into words of digits, letters a-z and characters beyond ASCII.
A benchmark item gives one window per run of ``n`` words; an item of fewer words is one window. The
hashes of these windows form a sorted set that is sent to the tasks; document windows that hit it
are compared word for word, so a hash clash never counts.

The set is sent in blocks of some ``block`` windows and ``BLOCK_BYTES`` bytes, one pass over the documents
per block, so what is broadcast has a bound whatever the benchmark's size. Which items hold a window is
not sent: tasks name the windows that they hit (by the SHA-256 of the words), and the items are joined to
each distinct set of hit windows in Spark, so a passage that many items share costs no task a list of them
per window.

Defined results: a null or wordless text has no words and no hits; a null item text, or one without
words, gives no window; equal items all count; item_ids are compared as text, a null one is "null";
repeated documents are answered row by row; empty tables give empty or unhit rows. Columns of the
documents may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewarden.llm.batches import PLAIN, Words, add_columns, small_batches, utf8
from lanewarden.session import materialize

WINDOW = 10
BLOCK_WINDOWS = 500_000
BLOCK_BYTES = 128 << 20
_SEED = 7

_SPANS = T.ArrayType(T.ArrayType(T.LongType()))
_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_spans", _SPANS),
        T.StructField("hit_windows", T.ArrayType(T.BinaryType())),
    ]
)


def windows_of(benchmark: DataFrame, n: int = WINDOW, text: str = "text", item: str = "item_id") -> DataFrame:
    """Each window of the benchmark, once per item that holds it: ``key, size, phrase, item``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(*utf8(batch.column(1)), PLAIN)
            rows = []
            for i, name in enumerate(batch.column(0).to_pylist()):
                low, high = int(words.first[i]), int(words.first[i + 1])
                size = min(n, high - low)
                if size:
                    keys = _window_keys(words, size)
                    rows += [(int(keys[j].view(np.int64)), size, words.phrase(j, size), name) for j in range(low, high - size + 1)]
            columns = list(zip(*rows)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "size", "phrase", "item"])

    source = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), F.col(text).alias("text"))
    return source.mapInArrow(run, "key long, size int, phrase binary, item string").distinct()


def _window_keys(words: Words, size: int) -> np.ndarray:
    return words.windows(size, _SEED + size)


class WindowSet:
    """A block of windows, ready to be looked up: sorted keys behind a bitmap, and phrases."""

    def __init__(self, rows: Sequence):
        rows = sorted(rows, key=lambda r: r["key"] & (2**64 - 1))
        self.keys = np.array([r["key"] for r in rows], np.int64).view(np.uint64)
        self.phrases = [bytes(r["phrase"]) for r in rows]
        self.sizes = sorted({r["size"] for r in rows})
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[(self.keys >> np.uint64(44)).astype(np.int64)] = True

    def hits(self, words: Words) -> Iterator[tuple[int, int, int]]:
        """``(first word, past the last word, number in this block)`` of each window that occurs within one text."""
        for size in self.sizes:
            keys = _window_keys(words, size)
            for at in np.flatnonzero(self.bitmap[(keys >> np.uint64(44)).astype(np.int64)]):
                text = np.searchsorted(words.first, at, "right") - 1
                if at + size > words.first[text + 1]:
                    continue
                k = int(np.searchsorted(self.keys, keys[at]))
                phrase = None
                while k < len(self.keys) and self.keys[k] == keys[at]:
                    phrase = phrase or words.phrase(int(at), size)
                    if self.phrases[k] == phrase:
                        yield int(at), int(at) + size, k
                    k += 1


def _merged(spans: list[tuple[int, int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1][1] = max(out[-1][1], high)
        else:
            out.append([low, high])
    return out


def _scan(docs: DataFrame, keep: Sequence[str], text: str, block) -> DataFrame:
    """``keep`` columns with the word count, merged hit spans in words, and the windows hit."""

    def compute(batch: pa.RecordBatch):
        words = Words(*utf8(batch.column(text)), PLAIN)
        spans: list[list] = [[] for _ in range(batch.num_rows)]
        found: list[set] = [set() for _ in range(batch.num_rows)]
        for low, high, number in block.value.hits(words):
            row = int(np.searchsorted(words.first, low, "right")) - 1
            spans[row].append((low - int(words.first[row]), high - int(words.first[row])))
            found[row].add(number)
        phrases = block.value.phrases
        names = [sorted(hashlib.sha256(phrases[k]).digest() for k in numbers) for numbers in found]
        return words.counts(), [_merged(s) for s in spans], names

    return add_columns(docs, keep, _FOUND, compute)


def _find(docs: DataFrame, occurrences: DataFrame, keep: str, block: int) -> DataFrame:
    """``keep`` of each document (``keep, text``), with ``n_words``, ``hit_spans`` and ``hit_windows``."""
    spark = docs.sparkSession
    small_batches(spark)
    windows = occurrences.select("key", "size", "phrase").distinct()
    total = windows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.length("phrase") + 40), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-total["n"] // block), -(-total["bytes"] // BLOCK_BYTES))
    place = F.pmod(F.xxhash64("key"), F.lit(blocks))
    sets = (spark.sparkContext.broadcast(WindowSet(windows.where(place == b).collect())) for b in range(blocks))
    if blocks == 1:
        return _scan(docs, [keep], "text", next(sets))
    # More than one pass: fix row numbers in a stored copy, and bring the passes' hits together by row.
    stored = materialize(docs.select(keep, "text", F.monotonically_increasing_id().alias("_row")), "texts")
    found = None
    for one in sets:
        part = materialize(_scan(stored.select("_row", "text"), ["_row"], "text", one), "hits")
        found = part if found is None else found.unionByName(part)
        one.unpersist()
    merged = found.groupBy("_row").agg(
        F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("hit_spans")).alias("_spans"),
        F.array_sort(F.flatten(F.collect_list("hit_windows"))).alias("hit_windows"),
    )
    merged = add_columns(
        merged, ["_row", "n_words", "hit_windows"], T.StructType([_FOUND["hit_spans"]]),
        lambda batch: [[_merged([tuple(s) for s in row]) for row in batch.column("_spans").to_pylist()]],
    )
    return stored.select("_row", keep).join(merged, "_row").drop("_row")


def _shaped(docs: DataFrame, keep: Sequence[str], text: str) -> DataFrame:
    # Columns go along in a struct, so that none meets the names of what is found.
    return docs.select(F.struct(*keep, F.lit(0).alias("_")).alias("kept"), F.col(text).alias("text"))


def find_windows(
    docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] | None = None, *, n: int = WINDOW,
    text: str = "text", block: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``keep`` columns (all by default) of each document, ``n_words``, ``hit_spans``, ``hit_items``.

    ``hit_spans`` are the merged runs of hit words, from 0, end exclusive; ``hit_items`` the sorted
    distinct items with an occurring window. They replace columns of their names.
    """
    answer = ("n_words", "hit_spans", "hit_items")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in answer]
    occurrences = materialize(windows_of(benchmark, n), "windows")
    found = materialize(_find(_shaped(docs, keep, text), occurrences, "kept", block), "found")
    owners = occurrences.select(F.unhex(F.sha2("phrase", 256)).alias("window"), "item")
    sets = found.where(F.size("hit_windows") > 0).select("hit_windows").distinct()
    items = sets.select("hit_windows", F.explode("hit_windows").alias("window")).join(owners, "window").groupBy("hit_windows").agg(
        F.sort_array(F.collect_set("item")).alias("hit_items")
    )
    # Only documents with a hit meet the items; those of equal windows are dealt to several tasks.
    salts = 8
    salted = items.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    hit = found.where(F.size("hit_windows") > 0).withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    hit = hit.join(salted, ["hit_windows", "_salt"])
    clean = found.where(F.size("hit_windows") == 0).withColumn("hit_items", F.array().cast("array<string>"))
    columns = [*[F.col("kept")[c].alias(c) for c in keep], *answer]
    return clean.select(columns).unionByName(hit.select(columns))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, the hash of the hit items' identifiers, and the verdict, per document."""
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])
    return found.select(
        key,
        "n_words",
        hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (F.size("hit_spans") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, remove: str = "documents", n: int = WINDOW) -> DataFrame:
    """The documents without benchmark windows, with their own columns.

    ``remove="documents"`` drops each document with a hit; ``remove="spans"`` keeps all of them and
    cuts the hit words, with what stands between them, out of the text.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    others = [c for c in docs.columns if c != "text"]
    occurrences = materialize(windows_of(benchmark, n), "windows")
    shaped = _shaped(docs, others, "text").withColumn("kept", F.struct("kept", "text"))
    found = _find(shaped, occurrences, "kept", BLOCK_WINDOWS).select("kept.*", "hit_spans")
    own = [F.col("text") if c == "text" else F.col("kept")[c].alias(c) for c in docs.columns]
    if remove == "documents":
        return found.where(F.size("hit_spans") == 0).select(*own)

    def compute(batch: pa.RecordBatch):
        data, offsets = utf8(batch.column("text"))
        words = Words(data, offsets, PLAIN)
        out = []
        for i, spans in enumerate(batch.column("hit_spans").to_pylist()):
            at, parts = int(offsets[i]), []
            for low, high in spans:
                parts.append(data[at : words.starts[words.first[i] + low]].tobytes())
                at = int(words.ends[words.first[i] + high - 1])
            parts.append(data[at : offsets[i + 1]].tobytes())
            out.append(b"".join(parts).decode() if batch.column("text")[i].is_valid else None)
        return [out]

    return add_columns(found, ["kept"], T.StructType([docs.schema["text"]]), compute).select(*own)
