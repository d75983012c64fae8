"""Collocations, languages and whitening against plain statements of their results."""

from __future__ import annotations

import os
import random

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from lanewarden.llm import language, phrases, queries, whitening

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are absent")


def phrase_docs(rng):
    pool = [f"w{i}" for i in range(25)] + ["É", "naïve", "x y", "日本", "\x00"]
    docs = [(None, "en"), ("", "en"), (" \t\n.,", "en"), (None, None)]
    for i in range(150):
        words = [rng.choice(pool) if rng.random() < 0.6 else "New York City" for _ in range(rng.randrange(1, 40))]
        gaps = [rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "!?"]) for _ in words]
        docs.append(("".join(w + g for w, g in zip(words, gaps)), rng.choice(["en", "en", "de", None, ""])))
    docs += [("alpha beta gamma", "fr")] * 12 + [("Alpha BETA; beta gamma", "fr")] * 9 + [("tie a. tie b", "it")] * 10
    docs.append(("same " * 3000 + "end", "la"))
    return docs


@pytest.mark.parametrize("longest,covered,top,shards", [(3, 50, 2000, 2), (4, 80, 2000, 3), (2, 50, 5, 1)])
def test_collocations(spark, longest, covered, top, shards):
    rows = phrase_docs(random.Random(3))
    docs = spark.createDataFrame([(t, lang, i, "p", 1, 2) for i, (t, lang) in enumerate(rows)], "text string, lang string, key long, phrase string, n long, shard long")
    found = phrases.collocations(docs, longest=longest, least=10, covered=covered, top=top, shards=shards)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = brute.collocations(rows, longest, 10, covered, top)
    assert len(want) > 15 and sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_collocations_when_every_key_shares_a_slot(spark, monkeypatch):
    """Bitmaps only save work: with one slot for all, nothing is left out and the rows are the same."""
    rows = phrase_docs(random.Random(4))
    docs = spark.createDataFrame(rows, "text string, lang string")
    frequent = phrases.frequent_keys

    def all_set(*args, **options):
        return {size: np.full_like(bits, 255) for size, bits in frequent(*args, **options).items()}

    monkeypatch.setattr(phrases, "frequent_keys", all_set)
    found = phrases.collocations(docs)
    assert sorted(tuple(r) for r in found.collect()) == sorted(brute.collocations(rows, 3, 10, 50, 2000))


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    assert phrases.collocations(docs).count() == 0
    assert phrases.collocations(docs.limit(0)).count() == 0


def test_collocation_arithmetic_passes_64_bits(spark):
    counts = [("en", 0, "", 10**16), ("en", 1, "a", 9 * 10**15), ("en", 1, "b", 8 * 10**15), ("en", 2, "a b", 7 * 10**15)]
    table = spark.createDataFrame(counts, "lang string, size byte, phrase string, f long")
    import unittest.mock as mock

    with mock.patch.object(phrases, "frequent_phrases", lambda *a, **k: table):
        row = phrases.collocations(table).first()
    assert (row["score"], row["l"], row["r"]) == (10**6 * 49 // 72, 9 * 10**15, 8 * 10**15)


def test_languages_equal_a_plain_statement(spark):
    rng = random.Random(6)
    pools = {"en": "the and of house running ship’s don't", "de": "der und von haus läuft schiff größe", "ru": "и дом бежит корабль", "hi": "हिन्दी घर है", "ja": "日本 語 家"}
    rows = []
    for i in range(400):
        lang = rng.choice(list(pools))
        words = [rng.choice(pools[lang].split()) + rng.choice(["", "", "s", "e"]) for _ in range(rng.randrange(1, 12))]
        rows.append((i, " ".join(words).upper() if i % 9 == 0 else ", ".join(words), None if i % 11 == 0 else lang))
    odd = [None, "", "123 ½² _ …", "é", "İSTANBUL", "́a", "Ωmega zzzz", "日本日本" * 40, "z" * 200, "the " * 4000, "a1b2"]
    rows += [(1000 + i, t, "en" if i % 2 else None) for i, t in enumerate(odd)] + [(None, "the house", "en")] + [rows[3]] * 3
    docs = spark.createDataFrame([(*r, 0.5, "x", 7) for r in rows], "doc_id long, text string, lang string, score double, block string, word long")
    trained = language.train(docs)
    found = language.predict(docs, trained)
    assert found.columns == ["doc_id", "text", "lang", "block", "word", "lang_pred", "score"]
    import zlib

    learned = [(t, x) for i, t, x in rows if x is not None and t is not None and zlib.crc32(str("" if i is None else i).encode()) % 3 != 1]
    want = brute.languages(learned, {r[0]: r[1] for r in rows}.items())
    got = found.collect()
    assert len(got) == len(rows) and all(r["block"] == "x" and r["word"] == 7 for r in got)
    for r in got:
        assert r["lang_pred"] == want[r["doc_id"]][0]
        assert abs(r["score"] - want[r["doc_id"]][1]) < 0.02
    asked = docs.select(language.held_out(F.col("doc_id")).alias("h"), "doc_id").collect()
    assert all(r["h"] == (zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 3 == 1) for r in asked)


def test_rare_words_come_back_by_a_join(spark, monkeypatch):
    """With no word frequent enough to be broadcast, the predictions are the same."""
    rows = [(i, f"common w{i % 50} only{i}", "en" if i % 2 else "de") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    usual = {r["doc_id"]: tuple(r) for r in language.predict(docs, language.train(docs)).collect()}
    monkeypatch.setattr(language, "SHARE", 1)
    joined = {r["doc_id"]: tuple(r) for r in language.predict(docs, language.train(docs)).collect()}
    assert usual.keys() == joined.keys()
    assert all(usual[i][:4] == joined[i][:4] and abs(usual[i][4] - joined[i][4]) < 1e-9 for i in usual)


def test_languages_of_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "text", None), (2, None, "en")], "doc_id long, text string, lang string")
    found = language.predict(docs, language.train(docs), ["doc_id"])
    assert sorted(tuple(r) for r in found.collect()) == [(1, "und", 0.0), (2, "und", 0.0)]
    assert language.predict(docs.limit(0), language.train(docs.limit(0))).count() == 0
    monkeypatch.setattr(language, "MOST_LANGUAGES", 1)
    many = spark.createDataFrame([(i, "text", f"l{i}") for i in range(9)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        language.train(many)


@needs_tables
def test_held_out_languages_are_found(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    found = queries.queries()["op12_language_id"](spark, SF).join(docs, "doc_id").where("held_out").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.97


def test_polar_and_components():
    rng = np.random.default_rng(1)
    for m in (1, 2, 3, 17, 40):
        for values in (rng.uniform(0, 9, m), np.ones(m), np.r_[np.ones(m // 2), np.full(m - m // 2, 3.0)], 10.0 ** -np.arange(m), np.zeros(m)):
            q = np.linalg.qr(rng.normal(size=(m, m)))[0]
            a = (q * values) @ q.T
            a = (a + a.T) / 2
            found, columns = whitening.components(a, 16)
            scale = max(1e-300, np.abs(values).max())
            assert np.allclose(found, np.sort(values)[::-1][:16], atol=1e-13 * scale)
            assert np.allclose(columns.T @ columns, np.eye(len(found)), atol=1e-12)
            assert np.linalg.norm(a @ columns - columns * found) <= 1e-13 * scale * m
    a = rng.normal(size=(12, 12))
    a = a + a.T
    u = whitening.polar(a)
    values, columns = np.linalg.eigh(a)
    assert np.allclose(u, (columns * np.sign(values)) @ columns.T, atol=1e-12)


def test_whitening(spark):
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(6, 6)) * np.array([3, 2, 1.5, 1, 0.7, 0.4])
    rows = [(i, (rng.normal(size=6) @ mix.T).tolist()) for i in range(300)]
    rows += [(300 + i, rows[0][1]) for i in range(120)]
    bad = [None, [], [None] + [1.0] * 5, [float("nan")] + [1.0] * 5, [float("-inf")] + [1.0] * 5]
    rows += [(500 + i, v) for i, v in enumerate(bad)] + [(600, [1.0, 2.0]), (601, [1.5, -2.0]), (602, [5.0])]
    docs = spark.createDataFrame([(i, v, 1, "n", 9) for i, v in rows], "vec_id long, embedding array<double>, width long, n string, x long")
    found = whitening.whiten(docs, most=4)
    assert found.columns == ["vec_id", "embedding", "width", "x", "n", "deviation", "whitened", "explained", "identity_error"]
    each = whitening.by_component(whitening.whiten(docs, keep=["vec_id"], most=4), ["vec_id"]).collect()
    x, n, sums, values, columns = brute.whitening([(i, v) for i, v in rows if i < 600], 4)
    got = {(r["vec_id"], r["component"]): r for r in each if r["vec_id"] < 600}
    assert got.keys() == {(i, c) for i in x for c in range(1, 5)}
    own = np.array([[got[i, c]["whitened"] for c in range(1, 5)] for i in x])
    want = (np.array(list(x.values())) - sums / n) @ columns / np.sqrt(values[:4])
    assert np.allclose(own, want * np.sign((own * want).sum(0)), atol=1e-9)
    for (i, c), r in got.items():
        assert r["n"] == n and r["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums))
        assert abs(r["explained"] / (values[c - 1] / values.sum()) - 1) < 1e-9 and r["identity_error"] < 1e-9
    # Two vectors of width two have one component; a single one has none.
    assert sorted((r["vec_id"], r["component"], r["n"]) for r in each if r["vec_id"] >= 600) == [(600, 1, 2), (601, 1, 2)]
    assert whitening.whiten(docs.limit(0)).count() == 0


def test_deviations_are_exact_or_null():
    centre = whitening.Centre(10**6, [10**6 * 5 + 7, -3])
    x = np.array([[5, 0], [10**3, -(10**3)], [10**7, 0]], np.int64)
    want = [sum((10**6 * int(a) - s) ** 2 for a, s in zip(row, [10**6 * 5 + 7, -3])) for row in x]
    assert centre.deviations(x).to_pylist() == [v if v < 1 << 63 else None for v in want]
    assert want[2] >= 1 << 63 > want[1]
    huge = whitening._whole_numbers
    import pyarrow as pa

    (_, numbers), = huge(pa.array([[1e300, -1e300, 0.0155]]))
    assert numbers.tolist() == [[(1 << 52) + 10**6, -(1 << 52) + 10**6, 10**6]]
