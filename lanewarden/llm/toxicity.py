"""Toxicity scores: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its byte n-grams (3 to 5 bytes, borders marked) and of itself, hashed into
``BUCKETS`` vectors. A window of ``WINDOW`` words is the average of its words' averaged vectors, and a
linear softmax gives the window's class. All windows of a text are scored; a smooth maximum joins
them, so a long text does not dilute an insult (an average over a whole text, or over windows of 48
words, found a tenth of the held-out toxic texts; one word a window found nine tenths). Vectors and
softmax are trained together by gradient steps on whole texts. An unseen spelling shares most of its
n-grams with known ones.

The fit uses at most ``PER_CLASS`` labelled texts of each class (times ``NEGATIVES`` for the
untoxic), taken in the order of a hash, none longer than ``LONGEST`` bytes; the class shares of all
labelled rows set the prior. The fit is the same for the same rows.

As a window's logit is linear in its words, a fitted model is one number per bucket. Scoring needs
no embeddings, and costs a few table look-ups per byte.

Defined results: a null or wordless text scores the prior; labels that are null are left out; rows
that repeat a document are scored row by row; with no labelled text of one class every score is
that class's opposite share (0.5 without any); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lanewarden.llm.batches import PLAIN, Words, add_columns, small_batches, utf8

BUCKETS = 1 << 16
DIMENSIONS = 8
WINDOW = 1
PER_CLASS = 800
NEGATIVES = 2
LONGEST = 200_000
GRAMS = (3, 5)
_K = np.uint64(0x9E3779B97F4A7C15)
_PIECE_WORDS = 1 << 17


def held_out(key: Column) -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(key.cast("string")) % 4 == 2


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * _K) >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int32)


def subwords(words: Words, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """``(word, bucket)`` of every feature of the words ``low`` to ``high``, words from 0."""
    starts, ends = words.starts[low:high], words.ends[low:high]
    sizes = ends - starts
    borders = np.concatenate([[0], np.cumsum(sizes + 1)])
    stream = np.zeros(int(borders[-1]) + 1, np.uint64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    stream[borders[owner] + 1 + within] = words.alphabet.fold[words.data[starts[owner] + within]]
    place = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes + 1)
    after = borders[1:][place]
    at = np.arange(len(place))
    found = [(np.arange(len(sizes), dtype=np.int32), _bucket(words.hashes[low:high]))]
    rolled = stream[:-1] + np.uint64(1)
    for n in range(2, GRAMS[1] + 1):
        rolled = rolled[: len(stream) - n + 1] * np.uint64(0x100000001B3) + stream[n - 1 :][: len(rolled)]
        if n >= GRAMS[0]:
            fits = np.flatnonzero(at[: len(rolled)] + n - 1 <= after[: len(rolled)])
            found.append((place[fits], _bucket(rolled[fits] ^ np.uint64(n << 56))))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows, and the text of each."""
    counts = np.diff(first)
    per_text = -(-counts // WINDOW)
    text = np.repeat(np.arange(len(counts)), per_text)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(per_text) - per_text, per_text)
    return first[:-1][text] + nth * WINDOW, text


class Model:
    """A weight per bucket, a window's bias, the shift to the prior, and the logit of no words."""

    def __init__(self, weights: np.ndarray, bias: float, shift: float, empty: float):
        self.weights, self.bias, self.shift, self.empty = weights.astype(np.float32), float(bias), float(shift), float(empty)

    def word_logits(self, words: Words) -> np.ndarray:
        out = np.zeros(len(words.hashes))
        for low in range(0, len(out), _PIECE_WORDS):
            high = min(low + _PIECE_WORDS, len(out))
            word, bucket = subwords(words, low, high)
            total = np.bincount(word, self.weights[bucket], minlength=high - low)
            out[low:high] = total / np.bincount(word, minlength=high - low)
        return out

    def scores(self, column: pa.Array) -> np.ndarray:
        words = Words(*utf8(column), PLAIN)
        logits = np.full(len(column), self.empty)
        starts, text = _windows(words.first)
        if len(starts):
            sizes = np.minimum(starts + WINDOW, words.first[1:][text]) - starts
            means = np.add.reduceat(self.word_logits(words), starts) / sizes + self.bias
            some = np.flatnonzero(np.diff(words.first))
            begin = np.searchsorted(text, some)
            top = np.maximum.reduceat(means, begin)
            sizes = np.diff(np.append(begin, len(text)))
            logits[some] = top + np.log(np.add.reduceat(np.exp(means - np.repeat(top, sizes)), begin)) + self.shift
        return 1 / (1 + np.exp(-np.clip(logits, -40, 40)))


def fit(texts: pa.Array, labels: np.ndarray, share: float, *, epochs: int = 100, rate: float = 0.03) -> Model:
    """Train bucket vectors and softmax together; ``share`` is the toxic share of all labelled rows."""
    sample_share = float(labels.mean()) if len(labels) else 0.0
    prior = np.log(np.clip(share, 1e-4, 1 - 1e-4)) - np.log(1 - np.clip(share, 1e-4, 1 - 1e-4))
    words = Words(*utf8(texts), PLAIN)
    if sample_share in (0.0, 1.0) or not len(words.hashes):
        return Model(np.zeros(BUCKETS), -40.0, prior + 40.0, prior)
    distinct, some, index = np.unique(words.hashes, return_index=True, return_inverse=True)
    # Features once per distinct word: view the words in the order of their first places.
    order = np.argsort(some)
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    index = rank[index]
    lone = Words.__new__(Words)
    lone.data, lone.alphabet = words.data, words.alphabet
    lone.starts, lone.ends, lone.hashes = (x[some[order]] for x in (words.starts, words.ends, words.hashes))
    pieces = []
    for low in range(0, len(order), _PIECE_WORDS):
        word, bucket = subwords(lone, low, min(low + _PIECE_WORDS, len(order)))
        turn = np.argsort(word, kind="stable")
        pieces.append((word[turn] + np.int32(low), bucket[turn]))
    spread, bucket = (np.concatenate(x) for x in zip(*pieces))
    del pieces
    per_word = np.bincount(spread, minlength=len(order))
    begin = np.concatenate([[0], np.cumsum(per_word)])[:-1]
    starts, text = _windows(words.first)
    sizes = np.minimum(starts + WINDOW, words.first[1:][text]) - starts
    first_window = np.searchsorted(text, np.arange(len(labels)))
    has = np.bincount(text, minlength=len(labels)) > 0

    draw = np.random.default_rng(1)
    vectors = draw.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    softmax = draw.normal(0, 0.3, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.array([0.0, 0.0], np.float32)
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (vectors, softmax, bias)]
    known = np.flatnonzero(has)
    which = np.repeat(np.arange(len(known)), np.bincount(text, minlength=len(labels))[known])
    for epoch in range(1, epochs + 1):
        slope = softmax[:, 1] - softmax[:, 0]
        bucket_logit = vectors @ slope
        word_logit = np.add.reduceat(bucket_logit[bucket], begin) / per_word
        window_logit = np.add.reduceat(word_logit[index], starts) / sizes + (bias[1] - bias[0])
        # Smooth maximum over a text's windows, and the part of each window in it.
        top = np.maximum.reduceat(window_logit, first_window[known])
        part = np.exp(window_logit - top[which])
        total = np.add.reduceat(part, first_window[known])
        logit = top + np.log(total)
        error = (1 / (1 + np.exp(-np.clip(logit, -40, 40))) - labels[known]) / len(known)
        window_error = error[which] * part / total[which]
        # Back through the means: windows to words to buckets.
        word_error = np.bincount(index, np.repeat(window_error / sizes, sizes), minlength=len(order)) / per_word
        bucket_error = np.bincount(bucket, word_error[spread], minlength=BUCKETS).astype(np.float32)
        slope_error = bucket_error @ vectors
        gradients = (
            bucket_error[:, None] * slope[None, :],
            np.stack([-slope_error, slope_error], 1) + 1e-5 * softmax,
            np.array([-error.sum(), error.sum()], np.float32),
        )
        for p, g, s in zip((vectors, softmax, bias), gradients, state):
            s[0] += 0.1 * (g - s[0])
            s[1] += 0.001 * (g * g - s[1])
            p -= rate * (s[0] / (1 - 0.9**epoch)) / (np.sqrt(s[1] / (1 - 0.999**epoch)) + 1e-8)
    shift = prior - (np.log(sample_share) - np.log(1 - sample_share))
    return Model(vectors @ (softmax[:, 1] - softmax[:, 0]), bias[1] - bias[0], shift, prior)


def train(docs: DataFrame, labels: DataFrame, *, per_class: int = PER_CLASS) -> Model:
    """Fit a model to a bounded sample of the labelled texts that are not held out."""
    marked = labels.select("doc_id", F.col("toxic").cast("int").alias("_toxic")).where(F.col("_toxic").isin(0, 1))
    marked = marked.where(~held_out(F.col("doc_id"))).dropDuplicates(["doc_id"])
    totals = {r["_toxic"]: r["count"] for r in marked.groupBy("_toxic").count().collect()}
    # The sample is fixed by the labels alone, so only its own texts are read from the documents.
    ordered = [
        marked.where(F.col("_toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class * (1 if t else NEGATIVES))
        for t in (0, 1)
    ]
    sample = F.broadcast(ordered[0].unionByName(ordered[1]))
    rows = docs.select("doc_id", "text").where(F.octet_length("text") <= LONGEST).join(sample, "doc_id")
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(per_class * (1 + NEGATIVES)).collect()
    share = totals.get(1, 0) / max(1, sum(totals.values())) if totals else 0.5
    toxic = np.array([r["_toxic"] for r in rows], np.float64)
    return fit(pa.array([r["text"] for r in rows], pa.string()), toxic, share)


def score(docs: DataFrame, model: Model, keep: Sequence[str] | None = None, *, text: str = "text", cut: float = 0.3) -> DataFrame:
    """``keep`` columns (all by default), the ``score`` of each whole text, and ``predicted``."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def compute(batch: pa.RecordBatch):
        found = shared.value.scores(batch.column(text))
        return found, (found >= cut).astype(np.int32)

    return add_columns(docs, docs.columns if keep is None else keep, added, compute)
