"""Collocations by dynamic itemset counting: phrases of growing length counted in cyclic scans of shards.

Texts are lower-cased (A-Z), split at ``. , ; : ! ?`` and line ends into pieces, and those into words at
blanks and tabs. All counts are per language; a phrase is a run of words inside a piece.

**Scans.** The table is dealt into ``SHARDS`` shards, which are scanned in turn, again and again. The first
cycle counts all words. A longer phrase is active, and counted, once both phrases that it consists of but for
its last and its first word have reached ``least`` occurrences in the scans so far (looked at after each scan
for words, at the end of each cycle for longer ones), until it has met each shard once. So lengths interleave, and it ends when nothing has become active for a cycle.
Phrases are known to a scan by 64-bit keys. What is active is a bitmap of ``2**26`` slots for each length and
scan (8 MB, whatever the input), so a scan needs no join. A phrase that merely shares a slot with an active
one starts and ends as if it were active, so every key's count is that of one full cycle.

**Names.** One last scan counts, word for word, the phrases whose keys reached ``least``; two phrases that
share a key are told apart there, and no count rests on a hash.

Defined results: null and empty texts have no words; a null language is ``und``; repeated rows count each
time; the other columns of the input are not read, so their names cannot clash; an empty table, or one
without a candidate, gives no rows; ties are ranked by the phrase's bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanewarden.llm.batches import Alphabet, Words, dictionary, merged, mix, small_batches, utf8
from lanewarden.session import materialize

SHARDS = 2
SLOT_BITS = 26
UNKNOWN = "und"
_ENDS = [*b".,;:!?", *range(0x0A, 0x0E)]
_ALPHABET = Alphabet([0x20, 0x09, *_ENDS])
_END = np.zeros(256, bool)
_END[_ENDS] = True
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BITMAP_ROW = 32_768

Bits = np.ndarray


class _Batch:
    """The words of a batch: language and piece of each, and keys of the phrases that start at it."""

    def __init__(self, batch: pa.RecordBatch):
        data, offsets = utf8(batch.column(0))
        self.words = Words(data, offsets, _ALPHABET)
        langs = batch.column(1).to_pylist()
        self.langs = sorted(set(langs))
        code = {lang: i for i, lang in enumerate(self.langs)}
        text = np.repeat(np.arange(batch.num_rows), self.words.counts())
        self.lang = np.array([code[x] for x in langs], np.int64)[text] if len(text) else np.zeros(0, np.int64)
        seeds = np.array([_seed(x) for x in self.langs], np.uint64)
        self.seed = seeds[self.lang] if len(text) else np.zeros(0, np.uint64)
        ends = np.searchsorted(np.flatnonzero(_END[data]), self.words.starts)
        # Pieces are numbered across the batch; a new text always begins one.
        self.piece = ends + text
        self._keys: dict[int, np.ndarray] = {}

    def places(self, size: int) -> np.ndarray:
        """The words at which a phrase of ``size`` words starts and stays in its piece."""
        n = len(self.piece) - size + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.piece[:n] == self.piece[size - 1 : size - 1 + n])

    def keys(self, size: int) -> np.ndarray:
        """Keys of ``size`` words from each word on; those that leave their piece mean nothing."""
        if size not in self._keys:
            n = max(0, len(self.piece) - size + 1)
            total = self.seed[:n] + np.uint64(size)
            for j in range(size):
                total = total * _STEP + self.words.hashes[j : j + n]
            self._keys[size] = mix(total)
        return self._keys[size]


def _seed(lang: str) -> int:
    """A fixed number for a language name."""
    total = 1
    for byte in lang.encode():
        total = (total * 1_000_003 + byte) % (1 << 64)
    return total


def _on(bits: Bits, keys: np.ndarray) -> np.ndarray:
    slot = keys >> np.uint64(64 - SLOT_BITS)
    return (bits[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _pieces(docs: DataFrame, shards: int) -> DataFrame:
    """``text, lang, shard``: whole texts, dealt by their content, so that a text's shard never changes."""
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang")
    shard = F.pmod(F.xxhash64("text", F.length("text")), F.lit(shards)).alias("shard")
    return docs.where("text is not null and text <> ''").select("text", lang, shard)


def _send(spark: SparkSession, *bitmaps: dict[int, Bits]) -> Broadcast:
    """Bitmaps by length, compressed: most have few bits."""
    return spark.sparkContext.broadcast([{size: zlib.compress(bits, 1) for size, bits in some.items()} for some in bitmaps])


def _received(sent: Broadcast) -> list[dict[int, Bits]]:
    return [{size: np.frombuffer(zlib.decompress(body), np.uint8) for size, body in some.items()} for some in sent.value]


def _scan(texts: DataFrame, longest: int, words: bool, sent: Broadcast) -> DataFrame:
    """``size, key, n`` of all words (with ``words``) and of the longer phrases that are in their cycle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, before = _received(sent)
        for batch in merged(batches):
            each = _Batch(batch)
            for size in range(1, longest + 1):
                at = each.places(size)
                if size > 1:
                    parts = each.keys(size - 1)
                    at = at[_active(now[size - 1], parts, at)]
                    if size - 1 in before:
                        at = at[~_active(before[size - 1], parts, at)]
                elif not words:
                    continue
                keys, n = np.unique(each.keys(size)[at], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keys), size, np.int8)), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))],
                    ["size", "key", "n"],
                )

    return texts.mapInArrow(run, "size byte, key long, n long").groupBy("size", "key").agg(F.sum("n").alias("n"))


def _active(bits: Bits, parts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the phrases that start at ``at`` have both parts (keys at ``at`` and the next word) set."""
    return _on(bits, parts[at]) & _on(bits, parts[at + 1])


def _bits(counted: DataFrame, size: int, least: int) -> Bits:
    """The bitmap of keys that have reached ``least``: at most 2**26 bits, however many keys there are."""
    frequent = counted.where(F.col("size") == size).groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    slot = F.shiftrightunsigned("key", 64 - SLOT_BITS)
    place = slot.bitwiseAND(F.lit(_BITMAP_ROW - 1)).alias("place")
    rows = frequent.select(F.shiftright(slot, _BITMAP_ROW.bit_length() - 1).alias("row"), place).groupBy("row").agg(
        F.bitmap_construct_agg("place").alias("bits")
    )
    out = np.zeros((1 << SLOT_BITS) // 8, np.uint8)
    width = _BITMAP_ROW // 8
    for row in rows.collect():
        out[row["row"] * width : (row["row"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return out


def frequent_keys(texts: DataFrame, *, longest: int, least: int, shards: int) -> dict[int, Bits]:
    """For each length the bitmap of keys with ``least`` occurrences, by cyclic scans."""
    zero = np.zeros((1 << SLOT_BITS) // 8, np.uint8)
    history: list[dict[int, Bits]] = [{size: zero for size in range(1, longest)}]
    counted: DataFrame | None = None
    step = 0
    while True:
        now, before = history[-1], history[step - shards] if step >= shards else {}
        if before and step % shards == 0 and all(np.array_equal(now[size], before[size]) for size in now):
            return now | {longest: _bits(counted, longest, least)}
        sent = _send(texts.sparkSession, now, before)
        found = _scan(texts.where(F.col("shard") == step % shards).select("text", "lang"), longest, step < shards, sent)
        found = materialize(found, "phrase-scan")
        sent.destroy()
        counted = found if counted is None else counted.unionByName(found)
        history.append({size: _bits(counted, size, least) if _moves(size, step, shards) else now[size] for size in now})
        step += 1


def _moves(size: int, step: int, shards: int) -> bool:
    """Whether a length's bitmap is drawn anew after a scan: words in the first cycle, longer ones as a cycle
    ends in which they can have been counted."""
    return step < shards if size == 1 else size - 1 <= step < size * shards and (step + 1) % shards == 0


def frequent_phrases(docs: DataFrame, *, longest: int, least: int, shards: int = SHARDS) -> DataFrame:
    """``lang, size, phrase, f`` of the phrases with ``least`` occurrences, and per language a row of size 0
    with all its word occurrences, as a stored table."""
    small_batches(docs.sparkSession)
    texts = _pieces(docs, shards)
    sent = _send(docs.sparkSession, frequent_keys(texts, longest=longest, least=least, shards=shards))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bits,) = _received(sent)
        for batch in merged(batches, 4 << 20):
            each = _Batch(batch)
            if not len(each.lang):
                continue
            names, code = dictionary(each.words)
            totals = np.bincount(each.lang, minlength=len(each.langs))
            yield _rows(each.langs, np.arange(len(each.langs)), 0, pa.array([""] * len(each.langs)), totals)
            for size in range(1, longest + 1):
                at = each.places(size)
                at = at[_on(bits[size], each.keys(size)[at])]
                # Phrases as numbers: language, then one word after another, renumbered so that none overflows.
                number = each.lang[at]
                for j in range(size):
                    number = number * len(names) + code[at + j]
                    if j + 1 < size:
                        number = np.unique(number, return_inverse=True)[1]
                _, first, n = np.unique(number, return_index=True, return_counts=True)
                place = at[first]
                parts = [names.take(pa.array(code[place + j])) for j in range(size)]
                phrase = parts[0] if size == 1 else pc.binary_join_element_wise(*parts, " ")
                yield _rows(each.langs, each.lang[place], size, phrase, n)

    found = texts.select("text", "lang").mapInArrow(run, "lang string, size byte, phrase string, n long")
    summed = found.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("f"))
    return materialize(summed.where((F.col("size") == 0) | (F.col("f") >= least)), "phrases")


def _rows(langs: list[str], lang: np.ndarray, size: int, phrase: pa.Array, n: np.ndarray) -> pa.RecordBatch:
    named = pa.array(langs, pa.string()).take(pa.array(lang))
    columns = [named, pa.array(np.full(len(n), size, np.int8)), phrase, pa.array(n.astype(np.int64))]
    return pa.RecordBatch.from_arrays(columns, ["lang", "size", "phrase", "n"])


def _joined(words: Column, start: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(
    docs: DataFrame, *, longest: int = 3, least: int = 10, covered: int = 50, top: int = 2000, shards: int = SHARDS
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top`` phrases of 2 to ``longest`` words.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of its lowest-scoring cut, ``score`` is
    ``floor(1000000 a a / (l r))``. A phrase inside a longer one with ``covered`` percent of its count is dropped.
    """
    if longest < 2:
        raise ValueError("a collocation has two words at least")
    found = frequent_phrases(docs, longest=longest, least=least, shards=shards)
    counts = found.where("size > 0").select("lang", "size", "phrase", "f")
    long_ = counts.where("size > 1").withColumn("words", F.split("phrase", " "))
    cut = F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k")
    cuts = long_.select("lang", "phrase", F.col("f").alias("a"), "size", "words", cut).select(
        "lang", "phrase", "a", "k", _joined(F.col("words"), F.lit(1), F.col("k")).alias("left"),
        _joined(F.col("words"), F.col("k") + 1, F.col("size") - F.col("k")).alias("right"),
    )
    # Every part of a frequent phrase is frequent, so both joins find a row.
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    wide = "decimal(18,0)"
    a, l_, r = (F.col(c).cast(wide) for c in "alr")
    score = F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), l_ * r)
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score)
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("x"))
    # A phrase of m words lies inside each longer one at every start and length.
    inner = long_.where("size > 2").select(
        "lang", F.col("f").alias("outer"), "words", "size",
        F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("m"),
    ).select("lang", "outer", "words", "m", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)).alias("at"))
    outer = inner.select("lang", _joined(F.col("words"), F.col("at"), F.col("m")).alias("phrase"), "outer")
    outer = outer.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    kept = lowest.join(outer, ["lang", "phrase"], "left").where(
        F.col("outer").isNull() | (100 * F.col("outer") < covered * F.col("x.a"))
    ).select("lang", "phrase", "x.a", "x.l", "x.r", "x.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    # Ranked in parts of a language first, so that the ranking of the whole language meets few rows.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(16))).orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    best = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(whole).cast("long")).where(F.col("rank") <= top)
    totals = found.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
