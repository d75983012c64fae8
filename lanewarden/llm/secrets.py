"""Secret scans with built-in functions only: fixed patterns, and a battery of randomness tests.

**Base kinds** are patterns, leftmost and non-overlapping per kind, with a least length that is
checked after matching, so a short match still uses up its text.

**Random strings.** Runs of at least 20 encoding characters with both letters and digits are
candidates; ``=`` only ends one, so of ``NAME=VALUE`` name and value are looked at apart. The encoding
is inferred from the characters (hex and base36 of either case, base32, base64), and four tests are made
of the hypothesis that the characters are drawn evenly and independently: chi-squared uniformity over the
alphabet, runs about the middle of the alphabet, runs of character classes (words in a name make few of
them), and lag-one serial correlation. Their p-values are combined (four times the least). Candidates of
one encoding and length class (power of two) are one family, over all documents: the Benjamini-Hochberg
procedure finds the p-value under which a string counts as structured, so of the strings called structured
by it at most a share ``rate`` is random. That alone would report what is structured but rare beside many
keys, so a p-value under ``level`` counts as structured in any family, which costs a share ``level`` of the
random strings. What is left is reported as ``random`` if it carries ``bits`` of information at least;
shorter strings could pass the tests by chance.

Positions come from splitting the text by the same pattern: gaps and matches alternate. They count
code points, ends are exclusive. Work grows near linearly with the matches of a text.

Defined results: a null or empty text has no spans; repeated rows are answered row by row; an empty
table gives no rows; columns of the input are never looked at but for the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lanewarden.llm.filters import before_each, let, placed, running

RATE = 0.01
LEVEL = 0.003
BITS = 96.0
_STEP = 10  # bins per decade of p-values
_DECADES = 30

# Fixed patterns of the base kinds: the whole match, the group whose length counts, its least length, a gate.
# Matches of the last two reach to the end of their run of characters, so asking for the least length
# in the pattern finds the same ones.
KINDS = {
    "assign": (
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        8,
        r"(?i:passw|secret|token|key)",
    ),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16, r"AKIA[A-Z0-9]{12}"),
    "hex": (r"[0-9a-f]{32,}", 0, 32, r"[0-9a-f]{32}"),
}
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}=*"
# Encodings in the order in which they are tried: characters, alphabet in order of value.
ENCODINGS = {
    "hex": ("^[0-9a-f]+=*$", "0123456789abcdef"),
    "upper-hex": ("^[0-9A-F]+=*$", "0123456789ABCDEF"),
    "base32": ("^[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base36": ("^[0-9a-z]+=*$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    "upper-base36": ("^[0-9A-Z]+=*$", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    "base64": ("^[A-Za-z0-9+/_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
}


def _matches(text: Column, pattern: str, gate: str, group: int, least: int) -> Column:
    """``array<struct<start, end, match>>`` of the matches whose group has ``least`` characters."""
    # The gap after the last match has no match beside it; it is dropped at the end.
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(
        F.split(text, pattern, -1), whole,
        lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("size"), F.length(m).alias("counted"), m.alias("match")),
    )
    if group:
        counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        parts = F.zip_with(parts, counted, lambda p, c: p.withField("counted", F.length(c)))
    found = F.filter(placed(F.filter(parts, lambda p: p["match"].isNotNull())), lambda m: m["part"]["counted"] >= least)
    told = F.transform(
        found, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["part"]["match"].alias("match"))
    )
    kind = "array<struct<start:int,end:int,match:string>>"
    return F.when(text.rlike(gate), told).otherwise(F.array().cast(kind))


def base_spans(text: Column) -> dict[str, Column]:
    """Per base kind the array of its spans ``start, end, match``."""
    return {kind: _matches(text, pattern, gate, group, least) for kind, (pattern, group, least, gate) in KINDS.items()}


def _upper_tail(z: Column) -> Column:
    """P(|Z| > |z|) of a standard normal variable, to seven digits (a fixed rational approximation)."""
    x = F.abs(z) / F.lit(2.0**0.5)
    t = 1 / (1 + F.lit(0.3275911) * x)
    series = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    return F.greatest(F.lit(10.0**-_DECADES), series * F.exp(-x * x))


def _sum(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, v: total + of(v))


_CLASS_RUNS = "[a-z]+|[A-Z]+|[^A-Za-z]+"


def _class_shares(alphabet: Column) -> list[Column]:
    """How likely two and three even draws from the alphabet are of one class (lower, upper, other)."""
    size = F.length(alphabet).cast("double")
    shares = [F.length(F.regexp_replace(alphabet, others, "")) / size for others in ("[^a-z]", "[^A-Z]", "[A-Za-z]")]
    return [sum((x**power for x in shares), F.lit(0.0)).alias(name) for power, name in ((2, "alike"), (3, "thrice"))]


def _tested(match: Column) -> Column:
    """``struct<encoding, n, p>`` of a candidate string; null encoding if it has none."""
    digits_and_letters = match.rlike("[0-9]") & match.rlike("[A-Za-z]")
    name, alphabet = F.lit(None).cast("string"), F.lit("")
    for encoding, (pattern, letters) in reversed(ENCODINGS.items()):
        name = F.when(match.rlike(pattern), F.lit(encoding)).otherwise(name)
        alphabet = F.when(match.rlike(pattern), F.lit(letters)).otherwise(alphabet)
    core = F.translate(F.rtrim(match, F.lit("=")), "-_", "+/")
    start = F.struct(F.when(digits_and_letters, name).alias("encoding"), alphabet.alias("alphabet"), core.alias("core"))

    def measured(s: Column) -> Column:
        """What the tests share: the characters' values, whether they are high, and counts per letter."""
        n = F.length(s["core"]).cast("double")
        values = F.transform(F.split(s["core"], ""), lambda c: F.instr(s["alphabet"], c).cast("double") - 1)
        counts = F.transform(F.split(s["alphabet"], ""), lambda c: n - F.length(F.replace(s["core"], c, F.lit(""))))
        return F.struct(
            s["encoding"].alias("encoding"), n.alias("n"), F.length(s["alphabet"]).cast("double").alias("size"),
            values.alias("values"), counts.alias("counts"), *_class_shares(s["alphabet"]),
            F.length(F.regexp_replace(s["core"], _CLASS_RUNS, ".")).cast("double").alias("classes"),
        )

    def summed(s: Column) -> Column:
        high = F.transform(s["values"], lambda v: (v * 2 >= s["size"]).cast("double"))
        return s.withField("high", high).withField("mean", _sum(s["values"], lambda v: v) / s["n"])

    def battery(s: Column) -> Column:
        n, size, values, high, mean = (s[x] for x in ("n", "size", "values", "high", "mean"))
        chi = size / n * _sum(s["counts"], lambda c: c * c) - n
        z_chi = (chi - (size - 1)) / F.sqrt(2 * (size - 1) * (n - 1) / n)
        n1 = _sum(high, lambda h: h)
        changes = F.zip_with(F.slice(high, 2, F.size(high)), F.slice(high, 1, F.size(high) - 1), lambda a, b: F.abs(a - b))
        middle = 2 * n1 * (n - n1) / n
        spread = F.greatest(F.lit(1e-9), middle * (middle - 1) / (n - 1))
        alike, thrice = s["alike"], s["thrice"]
        z_classes = (s["classes"] - 1 - (n - 1) * (1 - alike)) / F.sqrt((n - 1) * alike * (1 - alike) + 2 * (n - 2) * (thrice - alike * alike))
        z_runs = F.when(middle > 1, (1 + _sum(changes, lambda d: d) - (middle + 1)) / F.sqrt(spread)).otherwise(F.sqrt(n))
        second = F.slice(values, 2, F.size(values))
        lagged = F.zip_with(second, F.slice(values, 1, F.size(values) - 1), lambda a, b: (a - mean) * (b - mean))
        variance = F.greatest(F.lit(1e-9), _sum(values, lambda v: (v - mean) * (v - mean)))
        z_serial = (_sum(lagged, lambda v: v) / variance + 1 / n) * F.sqrt(n)
        tails = F.concat(
            F.transform(F.array(z_chi, z_runs, z_serial), _upper_tail),
            F.array(F.when(z_classes < 0, _upper_tail(z_classes) / 2).otherwise(F.lit(1.0))),
        )
        return F.struct(s["encoding"].alias("encoding"), n.cast("int").alias("n"), size.alias("size"), F.least(F.lit(1.0), 4 * F.array_min(tails)).alias("p"))

    none = F.struct(F.lit(None).cast("string").alias("encoding"), F.lit(0).alias("n"), F.lit(0.0).alias("size"), F.lit(1.0).alias("p"))
    return let(start, lambda s: F.when(s["encoding"].isNotNull(), let(let(measured(s), summed), battery)).otherwise(none))


def candidates(text: Column) -> Column:
    """``array<struct<start, end, t>>`` of the strings that have an encoding, with their tests."""
    found = F.transform(
        _matches(text, CANDIDATE, r"[A-Za-z0-9+/_-]{20}", 0, 20),
        lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), _tested(m["match"]).alias("t")),
    )
    return F.filter(found, lambda m: m["t"]["encoding"].isNotNull())


def _family(t: Column) -> Column:
    return F.concat(t["encoding"], F.lit(":"), F.floor(F.log2(t["n"])).cast("string"))


def _bin(p: Column) -> Column:
    return F.floor(-F.log10(p) * _STEP).cast("int")


def structure_bounds(tested: DataFrame, rate: float = RATE) -> dict[str, int]:
    """Per family the least bin of p-values that counts as structured (families without one left out).

    ``tested`` has the array ``cands``. Strings are counted per family and bin; the procedure runs on
    these counts, of which there are a few hundred per family and at most some hundred and twenty families.
    """
    each = tested.select(F.explode("cands").alias("c"))
    counts = each.groupBy(_family(F.col("c.t")).alias("family"), _bin(F.col("c.t.p")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    family = Window.partitionBy("family")
    down = family.orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counts.withColumn("rank", F.sum("n").over(down)).withColumn("all", F.sum("n").over(family))
    # The largest p-value of a bin is 10 ** (-bin / step).
    holds = F.pow(F.lit(10.0), -F.col("bin") / _STEP) <= rate * F.col("rank") / F.col("all")
    bounds = ranked.where(holds).groupBy("family").agg(F.min("bin").alias("bin"))
    return {r["family"]: r["bin"] for r in bounds.collect()}


def find_secrets(
    docs: DataFrame, keep: Sequence[str] | None = None, *, text: str = "text", rate: float = RATE, level: float = LEVEL, bits: float = BITS
) -> DataFrame:
    """``keep`` columns (all by default), and ``secrets``: sorted ``array<struct<start, rank, end, kind>>``."""
    body = F.coalesce(F.col(text), F.lit(""))
    bounds = structure_bounds(docs.select(candidates(body).alias("cands")), rate)
    family_bounds = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair]) if bounds else None

    def random_like(m: Column) -> Column:
        told = (m["t"]["n"] * F.log2(m["t"]["size"]) >= bits) & (m["t"]["p"] >= level)
        if family_bounds is None:
            return told
        return told & (_bin(m["t"]["p"]) < F.coalesce(F.element_at(family_bounds, _family(m["t"])), F.lit(1 << 30)))

    def spans(found: Column, kind: str, rank: int) -> Column:
        return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))

    kinds = {kind: spans(found, kind, i) for i, (kind, found) in enumerate(base_spans(body).items())}
    kinds["random"] = spans(F.filter(candidates(body), random_like), "random", len(kinds))
    keep = [c for c in (docs.columns if keep is None else keep) if c != "secrets"]
    return docs.select(*keep, F.array_sort(F.concat(*kinds.values())).alias("secrets"))


def _joined(spans: Column) -> Column:
    told = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(told, ",")


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as text."""
    spans = F.col("secrets")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    base = F.filter(spans, lambda s: s["kind"] != "random")
    return found.select(key, *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(spans).alias("spans"))


def redact(docs: DataFrame, *, mask: str = "[secret]") -> DataFrame:
    """The documents with each secret replaced by ``mask``; ``n_chars`` follows where there is one."""
    others = F.struct(*[c for c in docs.columns if c != "text"], F.lit(0).alias("_")).alias("kept")
    found = find_secrets(docs.select(others, "text"))
    body = F.col("text")
    first, wide = F.lit(bytes([0, 0, 254, 255])), "UTF-32"

    def cut(code: Column) -> Column:
        """Code points have four bytes each here, so a place in a long text is found without reading up to it."""

        def piece(low: Column, high: Column) -> Column:
            return F.decode(F.concat(first, code.substr((low * 4 + 1).cast("int"), ((high - low) * 4).cast("int"))), wide)

        def masked(ends: Column) -> Column:
            # A span that begins inside those before it only lengthens what is cut.
            parts = F.zip_with(
                "secrets", before_each(ends),
                lambda s, at: F.when(s["start"] >= at, F.concat(piece(at, s["start"].cast("long")), F.lit(mask))).otherwise(F.lit("")),
            )
            return F.concat(F.array_join(parts, ""), piece(F.array_max(ends), F.length(body).cast("long")))

        return let(running(F.transform("secrets", lambda s: s["end"]), lambda a, b: F.greatest(a, b)), masked)

    clean = found.withColumn("text", F.when(F.size("secrets") > 0, let(F.encode(body, wide), cut)).otherwise(body))
    own = {c: F.col("kept")[c] for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.size("secrets") > 0, F.length("text").cast("long")).otherwise(own["n_chars"])
    return clean.select(*[own[c].alias(c) for c in docs.columns])
