"""Secret scan: fixed patterns plus sliding-window Shannon entropy over candidate strings.

The fixed kinds (`assign`, `access`, `hex`) are leftmost non-overlapping matches of their patterns. The method adds
high-entropy strings that no fixed span covers: runs of a character class are candidates (a string may be one of
several classes, and is reported by each that finds it); a window slides over each
one and its Shannon entropy is kept up to date from the counts of the characters inside, one character entering and
one leaving. A candidate with a window at or above its class's threshold is a secret, unless the allow-list
suppresses it. The allow-list never suppresses a fixed span. It has whole patterns (UUIDs, placeholders, alphabets), and the
plain parts of a candidate between `/ _ = -`: words, also joined in camel case and with a few digits behind, that have
a vowel and no five consonants in a row, numbers, and parts of up to three characters. A candidate without ``ODD``
characters in a row outside of plain parts is a path, slug, date or name, however high the entropy of its letters.

DataFrame functions only, no shuffle: every text is scanned whole, where it is read. Positions are code points, ends
exclusive. The positions come from the lengths of the matches and of the text between them (`split` and
`regexp_extract_all` cut a text at the same matches).

Defined results: null is an empty text, without spans; the digest of no spans is that of the empty string; repeated
rows are scanned each; extra columns pass through ``scan``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import let

# Fixed by the query contract: kinds in their order. The contract's lower-bound tests on whole runs are part of the
# pattern where the longest run decides (access, hex); for assign the value's length is tested after matching.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ASSIGN_VALUE = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class EntropyClass:
    """A character class, its candidates (runs of at least ``least`` of its characters) and its threshold in bits."""

    kind: str
    pattern: str
    alphabet: str
    threshold: float
    window: int = 20


DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ALONE, _ENDS = r"(?<![A-Za-z0-9+])", r"(?![A-Za-z0-9+])"  # between separators
_RUN, _RUN_ENDS = r"(?<![A-Za-z0-9+/_=-])", r"(?![A-Za-z0-9+/_=-])"
_LOWER, _UPPER = r"(?=[a-z]*[0-9])(?=[0-9]*[a-z])", r"(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])"
_ALL = r"(?=[^a-z\s]*[a-z])(?=[^A-Z\s]*[A-Z])(?=[^0-9\s]*[0-9])"
# The thresholds of all but hex are just below the entropy that 99 % of random windows of the alphabet and length have
# (6,000 simulated for each; upper case: those of base32, whose alphabet is smaller).
CLASSES = (
    EntropyClass("entropy_hex", r"[0-9A-Fa-f]{20,}", "0123456789ABCDEFabcdef", 3.0),
    EntropyClass("entropy_base64", r"[A-Za-z0-9+/_=-]{20,}", DIGITS + LOWER + UPPER + "+/_=-", 3.6),
    EntropyClass("entropy_base64_short", _RUN + r"(?=[A-Za-z0-9+/_=-]{16,19}" + _RUN_ENDS + ")" + _ALL + r"[A-Za-z0-9+/_=-]{16,19}",
                 DIGITS + LOWER + UPPER + "+/_=-", 3.3, 16),
    EntropyClass("entropy_lower", _ALONE + _LOWER + r"[a-z0-9]{20,}" + _ENDS, DIGITS + LOWER, 3.35),
    EntropyClass("entropy_lower_short", _ALONE + _LOWER + r"[a-z0-9]{16,19}" + _ENDS, DIGITS + LOWER, 3.1, 16),
    EntropyClass("entropy_upper", _ALONE + _UPPER + r"[A-Z0-9]{20,}" + _ENDS, DIGITS + UPPER, 3.3),
    EntropyClass("entropy_upper_short", _ALONE + _UPPER + r"[A-Z0-9]{16,19}" + _ENDS, DIGITS + UPPER, 3.05, 16),
)
#: Candidates that match one of these as a whole are suppressed: UUIDs, written-out alphabets, placeholders, words only.
#: What follows a placeholder behind a separator is looked at on its own.
ALLOW = (
    r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$",
    r"(?i)^[a-z/_=-]*(?:(?:abcdefghijklm(?:nopqrstuvwxyz)?|0123456789(?:abcdef)?|qwertyuiop)[a-z0-9+/_=-]{0,15}?)+$",
    r"(?i)^[a-z/_=-]*[a-z0-9+]{0,15}(?:example|placeholder|changeme)[a-z+]{0,15}$",
    r"(?i)^[a-z/_=-]*your[_-][a-z/_=-]*[0-9]{0,4}$",
    r"^[A-Za-z/_-]+$",
)

_CONSONANTS = "bcdfghjklmnpqrstvwxzBCDFGHJKLMNPQRSTVWXZ"
#: A part that is no secret: up to three characters, a number, or words as described above.
PLAIN = (_ALONE + r"(?:[A-Za-z0-9]{1,3}|[0-9]{1,8}|(?![A-Za-z]*[" + _CONSONANTS + r"]{5})(?=[^aeiouyAEIOUY/_=+-]*[aeiouyAEIOUY])"
         r"[0-9]{0,4}+(?:[A-Z][a-z]++|[a-z]{2,}+|[A-Z]{2,}+)++[0-9]{0,4}+)" + _ENDS)
UUID = r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}(?![0-9A-Fa-f])"
ODD = 12

Spans = "array<struct<start:bigint,end:bigint,value:string>>"


def matches(text: Column, pattern: str, keep=None) -> Column:
    """All matches as (start, end, value), leftmost first; ``keep(position, match)`` picks the ones to return."""
    keep = keep or (lambda at, m: F.lit(True))

    def place(m: Column) -> Column:
        def step(acc: Column, x: Column) -> Column:
            start = acc["pos"] + F.length(x["gap"])
            end = start + F.length(x["m"])
            span = F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value")))
            return F.struct(end.alias("pos"),
                            F.when(x["ok"], F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

        parts = F.transform(m, lambda x, i: F.struct(x.alias("m"), i.alias("i"), keep(i, x).alias("ok")))
        cut = F.zip_with(parts, F.slice(F.split(text, pattern, -1), 1, F.size(m)), lambda p, g: F.struct(
            p["m"].alias("m"), p["ok"].alias("ok"), g.alias("gap")))
        none = F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast(Spans).alias("out"))
        return F.when(F.size(m) == 0, F.array().cast(Spans)).otherwise(F.aggregate(cut, none, step, lambda a: a["out"]))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)


def base_spans(text: Column) -> dict[str, Column]:
    values = F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2))
    long_enough = let(values, lambda v: matches(text, ASSIGN, lambda i, m: F.length(F.get(v, i)) >= ASSIGN_VALUE))
    return {"assign": long_enough, "access": matches(text, ACCESS), "hex": matches(text, HEX)}


def highest_entropy(value: Column, cls: EntropyClass) -> Column:
    """The largest Shannon entropy (bits) of a window of ``value``, from incremental counts."""
    w = cls.window
    xlogx = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(w + 2)])
    part = lambda c: F.element_at(xlogx, c + 1)  # noqa: E731  c * log2(c)

    def slide(codes: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            enters, leaves = F.get(codes, i), F.when(i >= w, F.get(codes, i - w)).otherwise(F.lit(0))
            gone = F.when(leaves > 0, F.element_at(acc["counts"], F.greatest(leaves, F.lit(1)))).otherwise(F.lit(0))
            had = F.element_at(acc["counts"], enters) - F.when(enters == leaves, F.lit(1)).otherwise(F.lit(0))
            total = (acc["sum"] - part(gone) + part(F.greatest(gone - 1, F.lit(0))) - part(had) + part(had + 1))
            counts = F.transform(acc["counts"], lambda c, k: c + (k + 1 == enters).cast("int") - (k + 1 == leaves).cast("int"))
            entropy = F.when(i + 1 >= w, F.lit(math.log2(w)) - total / w).otherwise(F.lit(0.0))
            return F.struct(counts.alias("counts"), total.alias("sum"), F.greatest(acc["best"], entropy).alias("best"))

        start = F.struct(F.array_repeat(F.lit(0), len(cls.alphabet)).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best"))
        return F.aggregate(F.sequence(F.lit(0), F.size(codes) - 1), start, step, lambda a: a["best"])

    # the position of each character in the alphabet, from 1
    return let(F.transform(F.split(value, ""), lambda c: F.instr(F.lit(cls.alphabet), c)), slide)


def longest_odd(value: Column) -> Column:
    """How many letters, digits and plus signs of a candidate follow one another outside of plain parts and UUIDs."""
    left = F.regexp_replace(F.regexp_replace(value, UUID, " "), PLAIN, " ")
    return F.array_max(F.transform(F.split(left, " "), lambda x: F.length(F.translate(x, "/_=-", ""))))


def entropy_spans(text: Column, covered: Column, cls: EntropyClass, allow: Sequence[str] = ALLOW) -> Column:
    """High-entropy candidates of a class that no span in ``covered`` contains."""
    def secret(s: Column) -> Column:
        inside = F.exists(covered, lambda c: (c["start"] <= s["start"]) & (s["end"] <= c["end"]))
        allowed = F.lit(False)
        for pattern in allow:
            allowed = allowed | s["value"].rlike(pattern)
        # CASE stops at the first that holds, so the entropy is computed for what is left only
        return F.when(inside, False).when(allowed, False).when(longest_odd(s["value"]) < ODD, False).otherwise(highest_entropy(s["value"], cls) >= cls.threshold)

    return F.filter(matches(text, cls.pattern), secret)


def _labelled(spans: Column, kind: str, order: int) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("rank"), F.concat_ws(
        ":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("label"), s["end"].alias("end")))


def _joined(labelled: Column) -> Column:
    return F.array_join(F.transform(F.sort_array(labelled), lambda s: s["label"]), ",")


def scan(docs: DataFrame, text_col: str = "text", classes: Sequence[EntropyClass] = CLASSES,
         allow: Sequence[str] = ALLOW) -> DataFrame:
    """(row, base, added): the document, its fixed spans and the method's, as arrays of (start, rank, label, end)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = base_spans(text)
    found = docs.select(F.struct("*").alias("row"), text.alias("text"), *[base[k].alias(k) for k in BASE_KINDS])
    covered = F.concat(*[F.col(k) for k in BASE_KINDS])
    fixed = F.concat(*[_labelled(F.col(k), k, i) for i, k in enumerate(BASE_KINDS)])

    def of_class(order: int, cls: EntropyClass) -> Column:
        return let(covered, lambda c: _labelled(entropy_spans(F.col("text"), c, cls, allow), cls.kind, order))

    added = F.concat(F.slice(fixed, 1, 0), *[of_class(i, c) for i, c in enumerate(classes, len(BASE_KINDS))])
    return found.select("row", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS], fixed.alias("base"), added.alias("added"))


def secret_report(docs: DataFrame, **options) -> DataFrame:
    """Counts, the digest of the fixed spans, and all spans of every document."""
    return scan(docs, **options).select(
        "row.doc_id", *[f"n_{k}" for k in BASE_KINDS], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_entropy"))
