"""Plain statements of the queries' results, for small inputs. Each returns ``{id: row}``."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter

import numpy as np


def _fold(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def components(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def near_duplicates(docs, k: int, percent: int) -> dict:
    sets = {}
    for doc_id, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", _fold(text))
        n = min(k, len(words))
        sets[doc_id] = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
    index = {}
    for doc_id, found in sets.items():
        for shingle in found:
            index.setdefault(shingle, []).append(doc_id)
    links = set()
    for doc_id, found in sets.items():
        common = Counter(other for shingle in found for other in index[shingle] if other > doc_id)
        for other, both in common.items():
            if 100 * both >= percent * (len(found) + len(sets[other]) - both):
                links.add((doc_id, other))
    part = components(sets, links)
    return {d: (len(s), part[d], part[d] == d) for d, s in sets.items()}


def near_vectors(rows, threshold: float) -> dict:
    good = {i: np.array(v, float) for i, v in rows if v is not None and None not in v and np.all(np.isfinite(v)) and np.any(v)}
    ids = sorted(good)
    unit = np.array([good[i] / np.linalg.norm(good[i]) for i in ids])
    close = unit @ unit.T >= threshold if ids else np.zeros((0, 0), bool)
    links = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(np.triu(close, 1)))]
    degree = Counter(x for pair in links for x in pair)
    part = components([i for i, _ in rows], links)
    return {i: (degree[i], part[i], part[i] == i) for i, _ in rows}


def contamination(docs, items, n: int) -> dict:
    def words_of(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _fold(text))

    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(n, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for doc_id, text in docs:
        words, hit, found = words_of(text), set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                names = windows.get(tuple(words[i : i + size]))
                if names:
                    hit.update(range(i, i + size))
                    found |= names
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[doc_id] = (len(words), len(hit), len(found), digest, bool(hit))
    return out


def archived(pages, least: int = 0) -> dict:
    largest = {}
    for page_id, html in pages:
        body = (html or "").encode()
        if len(body) >= least:
            largest[body] = max(largest.get(body, page_id), page_id)
    out = {}
    for page_id, html in pages:
        body = (html or "").encode()
        keeper = largest.get(body, page_id)
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out[page_id] = (len(body), digest, *(("response", None) if keeper == page_id else ("revisit", keeper)))
    return out


def repeated_bytes(docs, n: int) -> dict:
    seen = Counter()
    bodies = {d: (t or "").encode() for d, t in docs}
    for body in bodies.values():
        seen.update(body[i : i + n] for i in range(len(body) - n + 1))
    out = {}
    for doc_id, body in bodies.items():
        gone = np.zeros(len(body), bool)
        for i in range(len(body) - n + 1):
            if seen[body[i : i + n]] > 1:
                gone[i : i + n] = True
        kept = bytes(np.frombuffer(body, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[doc_id] = (len(body), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def base_secrets(docs) -> dict:
    kinds = [
        ("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 8),
        ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
        ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 32),
    ]
    out = {}
    for doc_id, text in docs:
        spans, counts = [], []
        for rank, (name, pattern, holds) in enumerate(kinds):
            found = [m for m in pattern.finditer(text or "") if holds(m)]
            counts.append(len(found))
            spans += [(m.start(), rank, f"{name}:{m.start()}:{m.end()}") for m in found]
        joined = ",".join(s for *_, s in sorted(spans))
        out[doc_id] = (*counts, hashlib.sha256(joined.encode()).hexdigest())
    return out


def base_licenses(docs) -> dict:
    phrases = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit")]
    out = {}
    for doc_id, text in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _fold(text))
        at, labels = [], set()
        for phrase, label in phrases:
            parts = phrase.split()
            here = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
            at += here
            labels |= {label} if here else set()
        out[doc_id] = (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels)))
    return out


def collocations(docs, longest: int, least: int, covered: int, top: int) -> list[tuple]:
    """Of ``(text, lang)`` rows."""
    counts, totals = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        totals[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _fold(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                counts.update((lang, *words[i : i + size]) for i in range(len(words) - size + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    rows = []
    for (lang, *words), a in candidates.items():
        inside = [
            f for (other, *longer), f in candidates.items()
            if other == lang and len(longer) > len(words)
            and any(longer[i : i + len(words)] == words for i in range(len(longer) - len(words) + 1))
        ]
        if any(100 * f >= covered * a for f in inside):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        rows.append((lang, -score, -a, " ".join(words).encode(), left, right))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right in sorted(rows):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def languages(learned, asked) -> dict:
    """Of ``(text, lang)`` rows to learn from and ``(id, text)`` rows: language and score."""
    import math
    import unicodedata
    import zlib

    def words_of(text):
        out, run = [], ""
        for c in (text or "").lower() + " ":
            kind = unicodedata.category(c)[0]
            if kind == "L" or kind == "M" and run:
                run += c
            else:
                out += [run[i : i + 64] for i in range(0, len(run), 64)]
                run = ""
        return out

    def grams(word, size):
        padded = f" {word} "
        return [zlib.crc32(padded[i : i + size].encode()) % (1 << 18) for i in range(len(padded) - size + 1)]

    seen: dict[str, Counter] = {}
    for text, lang in learned:
        for word in words_of(text):
            seen.setdefault(word, Counter())[lang] += 1
    langs = sorted({lang for c in seen.values() for lang in c})
    tokens = {lang: sum(c[lang] for c in seen.values()) for lang in langs}
    slots: dict[int, dict] = {size: {} for size in (4, 3, 2, 1)}
    for word, counts in seen.items():
        for size, table in slots.items():
            for slot in grams(word, size):
                for lang in counts:
                    table.setdefault(slot, Counter())[lang] += 1

    def logs(word):
        if word in seen:
            return {x: math.log((seen[word][x] + 0.5) / (tokens[x] + 0.5 * len(seen))) for x in langs}
        for size, table in slots.items():
            known = [s for s in grams(word, size) if s in table]
            if known:
                totals = {x: sum(c[x] for c in table.values()) for x in langs}
                return {
                    x: sum(math.log((table[s][x] + 0.5) / (totals[x] + 0.5 * len(table))) for s in known) / len(known)
                    for x in langs
                }
        return dict.fromkeys(langs, 0.0)

    out = {}
    for doc_id, text in asked:
        words = words_of(text)
        if not words or not langs:
            out[doc_id] = ("und", 0.0)
            continue
        each = [logs(w) for w in words]
        sums = {x: sum(e[x] for e in each) for x in langs}
        best = max(langs, key=lambda x: sums[x])
        out[doc_id] = (best, 1 / sum(math.exp(v - sums[best]) for v in sums.values()))
    return out


def whitening(vectors, most: int):
    """``{id: x}``, count, sums, eigenvalues (falling), vectors, of ``(id, vector)`` rows of one width."""
    x = {i: [math_floor(64 * c) + 1_000_000 for c in v] for i, v in vectors if v and all(c is not None and np.isfinite(c) for c in v)}
    fit = np.array(sorted({tuple(v) for v in x.values()}))
    sums = fit.sum(0)
    rows = fit - sums / len(fit)
    values, columns = np.linalg.eigh(rows.T @ rows / len(fit))
    return x, len(fit), sums, values[::-1], columns[:, ::-1][:, :most]


def math_floor(c: float) -> int:
    return int(np.floor(c))
