"""License scans with built-in functions only: ordered signature rules over normalised words.

Texts are folded (A-Z to a-z) and reduced to words of digits, letters a-z and characters beyond
ASCII, joined by single blanks. A rule is a regular expression over that form, with a label, a
priority and a keyword: words that each of its matches holds from a word's start on, the last of which
may go on ("gpl" is held by "gplv3"). Only documents that hold any keyword are looked at further; each
is joined to the rules of the keywords that it holds (the rule table is written by hand and broadcast),
and those rules' matches become detections, in word positions.

**Suppression.** A detection that lies within another one of its document counts only if no such
container has at least its priority (of equal spans the higher priority, then the first label, wins).
This is a running maximum of ends per priority over the detections by start, not a comparison of
all pairs. Detections of the base phrases are never suppressed.

**Score**: 1 minus the product of ``1 - confidence`` over the labels that stand.

Defined results: a null or wordless text has no words, no labels and score 0; repeated rows are
answered row by row; an empty table gives no rows; other columns of the input are not looked at.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lanewarden.llm.filters import placed

# The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

PRIORITIES = {"text": 3, "notice": 2, "name": 1}
CONFIDENCE = {"text": 0.99, "notice": 0.9, "name": 0.6}

# Hand-written signatures over normalised words. Each line: label, keyword, then rules of a kind.
# A "text" rule is a sentence of the license, a "notice" says that a work is under it, a "name" is
# a mention. In the rules, {v} stands for a version number whose parts are words ("2 0").
_GRANTS = (
    "licensed under (?:the |a )?{name}",
    "released under (?:the |a )?{name}",
    "distributed under (?:the |a )?(?:terms of (?:the )?)?{name}",
    "available under (?:the |a )?(?:terms of (?:the )?)?{name}",
    "(?:subject to|governed by|covered by) (?:the |a )?(?:terms of (?:the )?)?{name}",
)
_IDENTIFIED = ("spdx license identifier ", "license ", "licensed ", "licenses ")
_FAMILIES = {
    # label: (keyword of the name, name pattern, spdx pattern)
    "mit": ("mit license", "mit license", "mit"),
    "apache": ("apache", "apache (?:software )?license(?: version)?(?: 2(?: 0)?)?", "apache (?:1 0|1 1|2 0)"),
    "gpl": ("gpl", "(?:gnu )?gpl(?: ?v?[123](?: 0)?)?", "gpl [123] 0(?: only| or later)?"),
    "gpl-full": ("general public license", "gnu general public license(?: version [123](?: 0)?)?", "gnu general public license"),
    "lgpl": ("lgpl", "(?:gnu )?lgpl(?: ?v?[23](?: [01])?)?", "lgpl (?:2 0|2 1|3 0)(?: only| or later)?"),
    "lgpl-full": ("lesser general public", "gnu lesser general public license(?: version [23](?: [01])?)?", "gnu lesser general public license"),
    "agpl": ("agpl", "(?:gnu )?agpl(?: ?v?[13](?: 0)?)?", "agpl [13] 0(?: only| or later)?"),
    "agpl-full": ("affero general public", "gnu affero general public license(?: version 3(?: 0)?)?", "gnu affero general public license"),
    "mpl": ("mozilla public", "mozilla public license(?: version)?(?: [12] [01])?", "mpl (?:1 0|1 1|2 0)"),
    "epl": ("eclipse public", "eclipse public license(?: version)?(?: [12] 0)?", "epl [12] 0"),
    "cddl": ("common development and distribution", "common development and distribution license", "cddl 1 [01]"),
    "bsd": ("bsd", "(?:simplified |modified |new |revised )?bsd(?: [0234] clause)?(?: license)?", "bsd [1234] clause"),
    "isc": ("isc license", "isc license", "isc"),
    "cc0": ("cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    "cc-by": ("cc by", "cc by(?: [1234] 0)?", "cc by [1234] 0"),
    "cc-by-sa": ("cc by sa", "cc by sa(?: [1234] 0)?", "cc by sa [1234] 0"),
    "cc-by-nc": ("cc by nc", "cc by nc(?: [1234] 0)?", "cc by nc [1234] 0"),
    "cc-by-nd": ("cc by nd", "cc by nd(?: [1234] 0)?", "cc by nd [1234] 0"),
    "cc-by-nc-sa": ("cc by nc sa", "cc by nc sa(?: [1234] 0)?", "cc by nc sa [1234] 0"),
    "cc-by-nc-nd": ("cc by nc nd", "cc by nc nd(?: [1234] 0)?", "cc by nc nd [1234] 0"),
    "cc-by-named": ("creative commons", "creative commons attribution(?: [1234] 0)?(?: international| unported)?", "creative commons attribution"),
    "unlicense": ("unlicense", "(?:the )?unlicense", "unlicense"),
    "wtfpl": ("wtfpl", "wtfpl", "wtfpl"),
    "zlib": ("zlib", "zlib(?: libpng)? license", "zlib"),
    "boost": ("boost software", "boost software license(?: version)?(?: 1 0)?", "bsl 1 0"),
    "artistic": ("artistic license", "artistic license(?: [12](?: 0)?)?", "artistic [12] 0"),
    "eupl": ("european union public", "european union public licen[cs]e(?: v? ?1 [012])?", "eupl 1 [012]"),
    "osl": ("open software license", "open software license(?: v? ?[123] 0)?", "osl [123] 0"),
    "postgresql": ("postgresql license", "postgresql license", "postgresql"),
    "psf": ("python software foundation license", "python software foundation license(?: version 2)?", "psf 2 0"),
    "ofl": ("open font license", "(?:sil )?open font license(?: 1 [01])?", "ofl 1 [01]"),
    "odbl": ("open database license", "open database license", "odbl 1 0"),
    "ms-pl": ("microsoft public license", "microsoft public license", "ms pl"),
    "bsl": ("business source license", "business source license(?: 1 1)?", "busl 1 1"),
    "sspl": ("server side public", "server side public license", "sspl 1 0"),
    "elastic": ("elastic license", "elastic license(?: 2 0)?", "elastic 2 0"),
    "public-domain": ("public domain", "public domain", "public domain"),
    "proprietary": ("all rights reserved", "all rights reserved", "proprietary"),
}
_ALIAS = {"gpl-full": "gpl", "lgpl-full": "lgpl", "agpl-full": "agpl", "cc-by-named": "cc-by"}
_SENTENCES = (
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "the software is provided as is", "the software is provided as is without warranty of any kind"),
    ("apache", "you may not use this file", "you may not use this file except in compliance with the license"),
    ("apache", "unless required by applicable law", "unless required by applicable law or agreed to in writing software distributed under the license"),
    ("apache", "apache org licenses", "apache org licenses license [12] [01]"),
    ("gpl", "redistribute it and or modify it under", "redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "program is free software", "this program is free software you can redistribute it and or modify it"),
    ("gpl", "gnu org licenses", "gnu org licenses (?:old licenses )?gpl"),
    ("lgpl", "library is free software", "this library is free software you can redistribute it and or modify it"),
    ("lgpl", "gnu org licenses", "gnu org licenses (?:old licenses )?lgpl"),
    ("agpl", "gnu org licenses", "gnu org licenses (?:old licenses )?agpl"),
    ("bsd", "redistribution and use in source", "redistribution and use in source and binary forms with or without modification"),
    ("bsd", "redistributions of source code", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "neither the name of", "neither the name of (?:\\S+ ){1,8}nor the names of its contributors"),
    ("isc", "permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose"),
    ("mpl", "this source code form", "this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "mozilla org mpl", "mozilla org mpl [12] [01]"),
    ("epl", "accompanying materials are made available", "accompanying materials are made available under the terms of the eclipse public license"),
    ("unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("cc0", "publicdomain zero", "creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creativecommons org licenses by", "creativecommons org licenses by [1234] 0"),
    ("cc-by-sa", "creativecommons org licenses by sa", "creativecommons org licenses by sa [1234] 0"),
    ("cc-by-nc", "creativecommons org licenses by nc", "creativecommons org licenses by nc [1234] 0"),
    ("zlib", "altered source versions", "altered source versions must be plainly marked as such"),
    ("boost", "boost org license", "boost org license 1 0 txt"),
    ("artistic", "opensource org licenses artistic", "opensource org licenses artistic license"),
    ("wtfpl", "what the", "do what the \\S+ you want to public license"),
    ("ofl", "this font software is licensed", "this font software is licensed under the sil open font license"),
)


def _head(pattern: str) -> str:
    """What each match of a pattern begins with; with the blank after it if that is all of it."""
    head = re.match("[a-z0-9 ]*", pattern)[0]
    return head + " " if head == pattern else head


def rules() -> list[tuple[str, str, str, str]]:
    """All rules in order: ``(keyword, label, kind, pattern)``."""
    found = [(keyword, label, "text", pattern) for label, keyword, pattern in _SENTENCES]
    for family, (keyword, name, spdx) in _FAMILIES.items():
        label = _ALIAS.get(family, family)
        for grant in _GRANTS:
            found.append((keyword, label, "notice", grant.format(name=name)))
        for words in _IDENTIFIED:
            found.append((words + _head(spdx), label, "notice", words + spdx))
        found.append((keyword, label, "name", name))
    return found


def _keywords(all_rules: Sequence[tuple[str, str, str, str]]) -> list[str]:
    return sorted({r[0] for r in all_rules} | set(BASE))


def _any_of(keywords: Sequence[str]) -> str:
    """A pattern for any of the keywords, in which common beginnings are tried once."""
    groups: dict[str, list[str]] = {}
    for k in keywords:
        if not k:
            return ""
        groups.setdefault(k[0], []).append(k[1:])
    branches = [first + _any_of(rest) for first, rest in groups.items()]
    return branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"


_LETTERS = "".join(chr(c) for c in range(65, 91))


def normalised(text: Column) -> Column:
    """Folded words, each with one blank before it; empty without words."""
    words = F.regexp_replace(F.translate(text, _LETTERS, _LETTERS.lower()), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " ")
    trimmed = F.trim(words)
    return F.when(trimmed == "", F.lit("")).otherwise(F.concat(F.lit(" "), trimmed))


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(form: Column, pattern: Column) -> Column:
    """``array<struct<start, end>>`` in words of the matches of ``pattern`` in ``form``."""
    whole = F.concat(F.lit(" (?:"), pattern, F.lit(")(?= |$)"))
    parts = F.filter(
        F.zip_with(F.call_function("split", form, whole, F.lit(-1)), F.regexp_extract_all(form, whole, F.lit(0)),
                   lambda gap, m: F.struct(_blanks(gap).alias("gap"), _blanks(m).alias("size"))),
        lambda p: p["size"].isNotNull(),
    )
    return F.transform(placed(parts), lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end")))


def _rule_table(spark: SparkSession, all_rules: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    rows = [(k, label, PRIORITIES[kind], CONFIDENCE[kind], pattern, False) for k, label, kind, pattern in all_rules]
    rows += [(phrase, label, 0, CONFIDENCE["name"], phrase, True) for phrase, label in BASE.items()]
    return spark.createDataFrame(rows, "keyword string, label string, priority int, confidence double, pattern string, base boolean")


def find_licenses(docs: DataFrame, keep: Sequence[str] | None = None, *, text: str = "text") -> DataFrame:
    """``keep`` columns (all by default), ``n_words`` and ``detections``.

    ``detections`` is an array of ``struct<start, end, label, priority, confidence, base>``, sorted; those
    suppressed are left out. Matches of one rule do not overlap.
    """
    spark, own = docs.sparkSession, rules()
    keep = [c for c in (docs.columns if keep is None else keep) if c not in ("n_words", "detections")]
    keywords = _keywords(own)
    row = "_row_number"
    shaped = docs.select(F.struct(*[F.col(c) for c in keep]).alias("_kept"), normalised(F.coalesce(F.col(text), F.lit(""))).alias("_form"))
    shaped = shaped.select(F.monotonically_increasing_id().alias(row), "_kept", _blanks(F.col("_form")).cast("long").alias("n_words"), "_form")
    ended = F.concat(F.col("_form"), F.lit(" "))
    held = F.filter(F.array(*[F.lit(k) for k in keywords]), lambda k: F.contains(ended, F.concat(F.lit(" "), k)))
    gated = shaped.withColumn("keyword", F.explode_outer(F.when(ended.rlike(" " + _any_of(keywords)), held)))
    tried = gated.join(F.broadcast(_rule_table(spark, own)), "keyword", "left")
    place = F.explode_outer(F.when(F.col("pattern").isNotNull(), _places(F.col("_form"), F.col("pattern"))))
    hits = tried.withColumn("_at", place).select(row, "_kept", "n_words", "_at.*", "label", "priority", "confidence", "base")
    # Running ends per priority over a document's detections by start: a container starts no later.
    order = Window.partitionBy(row).orderBy("start", F.desc("end"), F.desc("priority"), "label").rowsBetween(Window.unboundedPreceding, -1)
    contained = F.lit(False)
    for level in sorted(set(PRIORITIES.values())):
        reach = F.max(F.when(F.col("priority") >= level, F.col("end"))).over(order)
        contained = contained | ((F.col("priority") <= level) & F.coalesce(reach >= F.col("end"), F.lit(False)))
    detection = F.struct("start", "end", "label", "priority", "confidence", "base")
    judged = hits.withColumn("_d", F.when(F.col("start").isNotNull() & (~contained | F.col("base")), detection))
    grouped = judged.groupBy(row).agg(
        F.first("_kept").alias("_kept"), F.first("n_words").alias("n_words"), F.array_sort(F.collect_list("_d")).alias("detections")
    )
    return grouped.select("_kept.*", "n_words", "detections")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts, positions and labels per document."""
    base = F.filter("detections", lambda d: d["base"])
    starts = F.transform(base, lambda d: d["start"].cast("long"))

    def labels(of) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(of, lambda d: d["label"]))), ",")

    doubt = F.aggregate(
        F.array_distinct(F.transform("detections", lambda d: F.struct(d["label"].alias("label"), d["confidence"].alias("confidence")))),
        F.lit(1.0), lambda left, c: left * (1 - c["confidence"]),
    )
    return found.select(
        key, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), labels(base).alias("base_labels"), labels(F.col("detections")).alias("labels"),
        (1 - doubt).alias("score"),
    )
