"""Language identification: known words by their log-frequency per language, unseen ones by character n-grams.

**Words** are runs of letters (with their combining marks), in lower case; a run of more than 64 characters
counts as several. A word that was learned in any language adds, for each language, the log of its smoothed
frequency there. An unseen word is padded with a blank on either side and looked up by its n-grams of four
characters; if none is known in any language, by those of three, and so on to one. It adds the mean of the
log-frequencies of the known n-grams of the first size that has any. The language with the largest sum is
predicted, and ``score`` is its share when the sums are taken as log-likelihoods of equally likely languages.

**Scale.** Words are counted per language in the tasks and summed by word. The model is that table, which grows
with the text learned from. Words with at least one in ``2**23`` of all learned occurrences, of which there can
be no more than ``2**23``, are broadcast. The rest of a document's words, a few per cent, are joined to the
table by word, and what is found comes back to the documents of one batch (a block). Character n-grams are
counted in ``2**18`` hashed slots per size, so their part of the model is bounded for a given list of languages;
it is collected and broadcast. So is the list of languages itself; more than ``MOST_LANGUAGES`` are refused.

Defined results: a text that is null or has no letter is ``und`` with score 0, and so is every text if nothing
could be learned; of equal sums the least language name wins; a null ``doc_id`` counts as the empty text, which
is not held out; documents without a language are not learned from; repeated rows count each time; a kept
column with the name of an added one is replaced; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lanewarden.llm.batches import Alphabet, Words, dictionary, small_batches, utf8
from lanewarden.session import materialize

UNKNOWN = "und"
SHARE = 1 << 23
SIZES = (4, 3, 2, 1)
SLOT_BITS = 18
SMOOTH = 0.5
MOST_LANGUAGES = 2000
LONGEST_WORD = 64
FOLDS, HELD = 3, 1
#: Candidates for words: letters a-z and all that is beyond ASCII, which is looked at word by word.
_ALPHABET = Alphabet([*range(0x00, 0x61), *range(0x7B, 0x80)])
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)) == HELD


def words_of(text: str) -> list[str]:
    """The words of a text, in order."""
    found = []
    for run in _LETTERS.findall(text.lower()):
        found += [run[i : i + LONGEST_WORD] for i in range(0, len(run), LONGEST_WORD)]
    return found


def _counted(column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of a batch; for each text and word of it: text, word, count."""
    words = Words(*utf8(column), _ALPHABET)
    text = np.repeat(np.arange(len(column)), words.counts())
    raw, code = dictionary(words)
    # Only distinct candidates are looked at one by one.
    number: dict[str, int] = {}
    parts, lengths = [], []
    for candidate in raw.to_pylist():
        own = [candidate] if candidate.isascii() and len(candidate) <= LONGEST_WORD else words_of(candidate)
        parts += [number.setdefault(w, len(number)) for w in own]
        lengths.append(len(own))
    lengths, parts = np.array(lengths, np.int64), np.array(parts, np.int64)
    first = np.cumsum(lengths) - lengths
    times = lengths[code] if len(code) else np.zeros(0, np.int64)
    inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    each = parts[np.repeat(first[code], times) + inside] if len(inside) else np.zeros(0, np.int64)
    pairs, n = np.unique(np.repeat(text, times) * max(1, len(number)) + each, return_counts=True)
    return list(number), pairs // max(1, len(number)), pairs % max(1, len(number)), n


def _grams(word: str, size: int) -> list[int]:
    """Slots of a padded word's n-grams."""
    padded = f" {word} "
    mask = (1 << SLOT_BITS) - 1
    return [zlib.crc32(padded[i : i + size].encode()) & mask for i in range(len(padded) - size + 1)]


class Model:
    """What is broadcast: languages, frequent words, n-gram slots, and the floors of unseen entries."""

    def __init__(self, langs: list[str], tokens: np.ndarray, n_words: int, common: pa.Table, slots: pa.Table):
        self.langs = langs
        self.floor = np.log(SMOOTH / (tokens + SMOOTH * max(1, n_words)))
        code = {lang: i for i, lang in enumerate(langs)}
        self.place = {w: i for i, w in enumerate(common.column("word").to_pylist())}
        seen = common.column("seen").combine_chunks()
        sizes = np.array([len(x) for x in seen], np.int64)
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        flat = seen.flatten()
        self.lang = np.array([code[x] for x in flat.field("lang").to_pylist()], np.int32)
        self.gain = np.log1p(flat.field("n").to_numpy(zero_copy_only=False) / SMOOTH)
        self.grams, self.gram_known, self.gram_floor = {}, {}, {}
        kind, slot, lang, n = (slots.column(c).to_pylist() if c == "lang" else slots.column(c).to_numpy() for c in ("size", "slot", "lang", "n"))
        lang = np.array([code[x] for x in lang], np.int64)
        for size in SIZES:
            here = kind == size
            known = np.zeros(1 << SLOT_BITS, bool)
            known[slot[here]] = True
            totals = np.bincount(lang[here], n[here], minlength=len(langs))
            floor = np.log(SMOOTH / (totals + SMOOTH * max(1, known.sum())))
            table = np.zeros((1 << SLOT_BITS, len(langs)), np.float16)
            table[slot[here], lang[here]] = np.log1p(n[here] / SMOOTH)
            self.grams[size], self.gram_known[size], self.gram_floor[size] = table, known, floor

    def known(self, places: np.ndarray, weights: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
        """Sums per row of the frequent words at ``places``, each ``weights`` times."""
        out = np.bincount(rows, weights, minlength=n_rows)[:, None] * self.floor
        times = self.start[places + 1] - self.start[places]
        inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        at = np.repeat(self.start[places], times) + inside
        np.add.at(out, (np.repeat(rows, times), self.lang[at]), np.repeat(weights, times) * self.gain[at])
        return out

    def unseen(self, word: str) -> np.ndarray:
        """The mean log-frequencies of the word's longest known n-grams."""
        for size in SIZES:
            slots = [s for s in _grams(word, size) if self.gram_known[size][s]]
            if slots:
                return self.gram_floor[size] + self.grams[size][slots].astype(np.float64).mean(0)
        return np.zeros(len(self.langs))


def train(docs: DataFrame) -> tuple[DataFrame, Model]:
    """The stored table ``word, total, seen`` (an array of ``lang, n``), and what is broadcast of it."""
    spark = docs.sparkSession
    small_batches(spark)
    learned = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, text, word, n = _counted(batch.column(0))
            langs = batch.column(1).dictionary_encode()
            code = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            keys, back = np.unique(code[text] * max(1, len(names)) + word, return_inverse=True)
            total = np.bincount(back, n, minlength=len(keys)).astype(np.int64)
            spelled = pa.array(names, pa.string()).take(pa.array(keys % max(1, len(names))))
            named = langs.dictionary.take(pa.array(keys // max(1, len(names))))
            yield pa.RecordBatch.from_arrays([spelled, named, pa.array(total)], ["word", "lang", "n"])

    counts = learned.select("text", F.col("lang").cast("string").alias("lang")).mapInArrow(count, "word string, lang string, n long")
    each = counts.groupBy("word", "lang").agg(F.sum("n").alias("n"))
    # A word has at most one entry per language.
    table = each.groupBy("word").agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("lang", "n"))).alias("seen"))
    table = materialize(table, "language-words")
    sums = table.select(F.explode("seen").alias("x")).groupBy("x.lang").agg(F.sum("x.n").alias("n")).orderBy("lang").limit(MOST_LANGUAGES + 1)
    tokens = {r["lang"]: r["n"] for r in sums.collect()}
    if len(tokens) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages to learn")
    langs = sorted(tokens)
    least = -(-sum(tokens.values()) // SHARE)
    common = table.where(F.col("total") >= least).select("word", "seen").toArrow()

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[int, int, str], int] = {}
            for word, seen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = [x["lang"] for x in seen]
                for size in SIZES:
                    for slot in _grams(word, size):
                        for lang in own:
                            key = (size, slot, lang)
                            found[key] = found.get(key, 0) + 1
            size, slot, lang = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(size, pa.int32()), pa.array(slot, pa.int32()), pa.array(lang, pa.string()), pa.array(found.values(), pa.int64())],
                ["size", "slot", "lang", "n"],
            )

    grams = table.select("word", "seen").mapInArrow(slots, "size int, slot int, lang string, n long")
    grams = grams.groupBy("size", "slot", "lang").agg(F.sum("n").alias("n")).toArrow()
    return table, Model(langs, np.array([tokens[x] for x in langs], np.float64), table.count(), common, grams)


def _blocks(docs: DataFrame, model, kept: Sequence[str]) -> DataFrame:
    """Per text a row with its sums over frequent words, and a row for each of its other words.

    Rows of one batch share a ``block``. A stored table, so that blocks stay the same in both uses.
    """
    rows = docs.select(F.struct(*[F.col(c) for c in kept], F.lit(0).alias("_")).alias("kept"), "text")
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("doc", T.IntegerType()), T.StructField("kept", rows.schema["kept"].dataType),
        T.StructField("sums", T.ArrayType(T.DoubleType())), T.StructField("n_words", T.LongType()),
        T.StructField("word", T.StringType()), T.StructField("n", T.LongType()),
    ])
    arrow = pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = model.value
        for i, batch in enumerate(batches):
            block = (TaskContext.get().partitionId() << 24) + i
            names, text, word, n = _counted(batch.column(1))
            place = np.array([known.place.get(w, -1) for w in names], np.int64)
            at = place[word] if len(word) else np.zeros(0, np.int64)
            common = at >= 0
            sums = known.known(at[common], n[common].astype(np.float64), text[common], batch.num_rows)
            totals = np.bincount(text, n, minlength=batch.num_rows).astype(np.int64)
            size = batch.num_rows
            lists = pa.ListArray.from_arrays(pa.array(np.arange(size + 1, dtype=np.int32) * sums.shape[1]), pa.array(sums.ravel()))
            own = [pa.array(np.full(size, block)), pa.array(np.arange(size, dtype=np.int32)), batch.column(0), lists, pa.array(totals)]
            yield pa.RecordBatch.from_arrays(own + [pa.nulls(size, t) for t in arrow.types[5:]], schema=arrow)
            text, word, n = text[~common], word[~common], n[~common]
            spelled = pa.array(names, pa.string()).take(pa.array(word))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(text), block)), pa.array(text.astype(np.int32)), *[pa.nulls(len(text), t) for t in arrow.types[2:5]], spelled, pa.array(n)],
                schema=arrow,
            )

    return materialize(rows.mapInArrow(run, schema), "language-blocks")


def predict(docs: DataFrame, trained: tuple[DataFrame, Model], keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns (all by default) with ``lang_pred`` and ``score``."""
    spark = docs.sparkSession
    small_batches(spark)
    table, model = trained
    sent = spark.sparkContext.broadcast(model)
    added = T.StructType.fromDDL("lang_pred string, score double")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in added.names]
    stored = _blocks(docs, sent, kept)
    texts = stored.where("word is null").select("block", "doc", "kept", "sums", "n_words")
    # Renamed, since both sides come from one table.
    others = stored.where("word is not null").select(F.col("block").alias("of_block"), F.col("doc").alias("of_doc"), "word", "n")
    found = others.join(table.select("word", "seen"), "word", "left")
    # An unseen word comes back as it is written, a known one as its counts.
    found = found.select("of_block", "of_doc", "n", F.when(F.col("seen").isNull(), F.col("word")).alias("word"), "seen.lang", F.col("seen.n").alias("counts"))
    schema = T.StructType([docs.schema[c] for c in kept] + added.fields)
    fields = [pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields]

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        model = sent.value
        order = np.argsort(left.column("doc").to_numpy())
        left = left.take(pa.array(order))
        sums = left.column("sums").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(left.num_rows, len(model.langs)).copy()
        code = {lang: i for i, lang in enumerate(model.langs)}
        gone: dict[str, np.ndarray] = {}
        for doc, n, word, langs, counts in zip(*[right.column(c).to_pylist() for c in ("of_doc", "n", "word", "lang", "counts")]):
            if word is None:
                sums[doc] += n * model.floor
                for lang, c in zip(langs, counts):
                    sums[doc, code[lang]] += n * np.log1p(c / SMOOTH)
            else:
                if word not in gone:
                    gone[word] = model.unseen(word)
                sums[doc] += n * gone[word]
        lettered = left.column("n_words").to_numpy() > 0
        names = np.full(left.num_rows, UNKNOWN, object)
        score = np.zeros(left.num_rows)
        if model.langs and lettered.any():
            some = sums[lettered]
            top = some.argmax(1)
            names[lettered] = np.array(model.langs, object)[top]
            score[lettered] = 1 / np.exp(some - some.max(1, keepdims=True)).sum(1)
        row = left.column("kept").combine_chunks()
        columns = [row.field(c) for c in kept]
        return pa.Table.from_arrays(columns + [pa.array(names, pa.string()), pa.array(score)], schema=pa.schema(fields))

    return texts.groupBy("block").cogroup(found.groupBy("of_block")).applyInArrow(finish, schema)
