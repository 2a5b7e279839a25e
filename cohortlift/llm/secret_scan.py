"""Secret scans: fixed patterns, and windows of high Shannon entropy in candidate strings. DataFrame expressions only."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlift.llm.common import columns

#: The base kinds in order, with pattern, the group that is measured and its least length. A run that is too short holds no
#: other match of access or hex, so their pattern asks for the length itself; a short assignment may hold the start of another, which it takes.
BASE = (
    ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)


@dataclass(frozen=True)
class CharClass:
    """Candidate strings are runs of the alphabet of `window` characters or more; a window counts if its entropy reaches `bits`."""

    name: str
    run: str
    alphabet: str
    window: int
    bits: float


CLASSES = (
    CharClass("entropy_hex", "[0-9A-Fa-f]", "0123456789ABCDEFabcdef", 20, 3.0),
    CharClass("entropy_base64", "[0-9A-Za-z+/_=-]", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_=-", 20, 3.9),
)
#: Candidate strings that are no secrets: words and names of letters, paths or lists of such, numbers, rulers, UUIDs, placeholders. No pattern
#: repeats a group: the regular expressions of the JVM recurse there, and a long candidate would use up the stack.
ALLOWED = (
    r"^(?!.*[A-Za-z][A-Z])[A-Za-z/_=+-]*$", r"^(?=[A-Z])[A-Z/_=+-]*[A-Z]$", r"^[0-9/_=+-]+$",
    r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$", r"(?i)example|placeholder|changeme|0123456789|abcdefgh",
)
#: Sums of match lengths are taken in steps of so many, so that a text with very many matches stays cheap.
STEP = 512


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _matches(text: Column, pattern: str, group: int, least: int) -> Column:
    """array of (start, end, value) of the leftmost non-overlapping matches whose group has `least` characters; code points, end exclusive."""
    found = F.struct(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("part"))
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, n: s + n)

    def with_lengths(f: Column) -> Column:
        lengths = F.zip_with(F.slice(f["gap"], 1, F.size(f["hit"])), f["hit"], lambda g, h: F.length(g) + F.length(h))
        return F.struct(f["gap"].alias("gap"), f["hit"].alias("hit"), f["part"].alias("part"), lengths.alias("n"))

    def with_steps(f: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(f["n"]) - 1) / STEP).cast("int")), lambda k: total(F.slice(f["n"], k * STEP + 1, F.lit(STEP))))
        starts = F.aggregate(sums, F.array(F.lit(0)), lambda a, n: F.array_append(a, F.element_at(a, -1) + n))
        return F.struct(f["gap"].alias("gap"), f["hit"].alias("hit"), f["part"].alias("part"), f["n"].alias("n"), starts.alias("at"))

    def placed(f: Column) -> Column:
        def one(h: Column, i: Column) -> Column:
            step = F.floor(i / STEP).cast("int")
            start = F.get(f["at"], step) + total(F.slice(f["n"], step * STEP + 1, i - step * STEP)) + F.length(F.get(f["gap"], i))
            return F.struct(start.alias("start"), (start + F.length(h)).alias("end"), h.alias("value"), F.length(F.get(f["part"], i)).alias("size"))

        kept = F.filter(F.transform(f["hit"], one), lambda m: m["size"] >= least)
        return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["value"].alias("value")))

    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), _let(_let(_let(found, with_lengths), with_steps), placed)).otherwise(none)


def _entropy_span(value: Column, kind: CharClass) -> Column:
    """(first, last) of a candidate: from the first to the end of the last window of high entropy, or nulls.

    With c(x) of a window's w characters equal to x, its entropy is log2 w - sum(c log2 c) / w. The counts and the sum go along: one
    character enters, one leaves. c log2 c is a table of whole numbers (millionths), so nothing is lost on the way.
    """
    w = kind.window
    table = F.array(*(F.lit(round(n * math.log2(n) * 1e6) if n else 0).cast("long") for n in range(w + 2)))
    most = F.lit(int((math.log2(w) - kind.bits) * w * 1e6)).cast("long")
    nothing = F.lit(None).cast("int")
    zero = F.struct(F.array_repeat(F.lit(0), len(kind.alphabet)).alias("counts"), F.lit(0).cast("long").alias("sum"), nothing.alias("first"), nothing.alias("last"))

    def over(chars: Column) -> Column:
        def step(state: Column, i: Column) -> Column:
            enters, leaves = F.get(chars, i), F.coalesce(F.get(chars, F.when(i >= w, i - w).otherwise(-1)), F.lit(-1))
            fewer, more = F.coalesce(F.get(state["counts"], leaves), F.lit(0)), F.get(state["counts"], enters)
            now = state["sum"] + F.when(enters == leaves, F.lit(0)).otherwise(
                F.get(table, more + 1) - F.get(table, more) + F.when(leaves >= 0, F.get(table, fewer - 1) - F.get(table, fewer)).otherwise(F.lit(0)))
            counts = F.when(enters == leaves, state["counts"]).otherwise(
                F.transform(state["counts"], lambda n, x: n + F.when(x == enters, 1).otherwise(0) - F.when(x == leaves, 1).otherwise(0)))
            high = (i >= w - 1) & (now <= most)
            return F.struct(
                counts.alias("counts"), now.cast("long").alias("sum"), F.coalesce(state["first"], F.when(high, i - w + 1)).alias("first"),
                F.when(high, i + 1).otherwise(state["last"]).alias("last"))

        return F.aggregate(F.sequence(F.lit(0), F.size(chars) - 1), zero, step, lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")))

    places = F.transform(F.filter(F.split(value, ""), lambda c: c != ""), lambda c: F.position(c, F.lit(kind.alphabet)) - 1)
    return _let(places, over)


def _high_entropy(text: Column, kind: CharClass, allowed: tuple[str, ...]) -> Column:
    candidates = _matches(text, kind.run + "{" + str(kind.window) + ",}", 0, kind.window)
    suppressed = lambda m: ~_any(m["value"], allowed)
    spans = F.transform(F.filter(candidates, suppressed), lambda m: _let(
        _entropy_span(m["value"], kind), lambda s: F.struct((m["start"] + s["first"]).alias("start"), (m["start"] + s["last"]).alias("end"))))
    return F.filter(spans, lambda s: s["start"].isNotNull())


def _any(value: Column, patterns: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in patterns:
        out = out | value.rlike(p)
    return out


def spans_of(text: Column, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> Column:
    """All secrets of a text: array of (start, kind_no, end, kind) by start, then kind as listed: base kinds, then character classes."""
    text = F.coalesce(text, F.lit(""))
    kinds = [(name, _matches(text, pattern, group, least)) for name, pattern, group, least in BASE]
    kinds += [(c.name, _high_entropy(text, c, allowed)) for c in classes]

    def as_span(number: int, name: str) -> Callable[[Column], Column]:
        return lambda m: F.struct(m["start"].alias("start"), F.lit(number).alias("kind_no"), m["end"].alias("end"), F.lit(name).alias("kind"))

    as_spans = [F.transform(found, as_span(n, name)) for n, (name, found) in enumerate(kinds)]
    return F.array_sort(F.concat(*as_spans))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secrets(docs: DataFrame, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """documents -> (doc_id, n_assign, n_access, n_hex, base_sha256, spans), a row per row; no shuffle.

    Null and empty texts have no spans (n 0, spans empty); repeated rows and ids are rows like others; a null doc_id stays null; other columns
    are not looked at; an empty table gives no rows. Texts are read whole, at any length.
    """
    found = columns(docs, doc_id="doc_id", text="text").select("doc_id", spans_of(F.col("text"), classes, allowed).alias("s"))
    of = lambda name: F.size(F.filter("s", lambda s: s["kind"] == name)).cast("long")
    base = F.filter("s", lambda s: s["kind_no"] < len(BASE))
    return found.select(
        "doc_id", *(of(name).alias(f"n_{name}") for name, *_ in BASE), F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("s")).alias("spans"))


def redacted(docs: DataFrame, mark: str = "<secret>", classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """The documents with each secret (spans that overlap together) replaced by `mark`; all others stay as they are. n_chars follows the text."""
    names = docs.columns
    inner = docs.toDF(*(f"c{i}" for i in range(len(names))))
    text = F.col(f"c{names.index('text')}")
    inner = inner.withColumn("s", spans_of(text, classes, allowed))

    def cut(state: Column, s: Column) -> Column:
        apart = (s["start"] >= state["at"]) | (F.size(state["parts"]) == 0)
        piece = F.array(text.substr(state["at"] + 1, s["start"] - state["at"]), F.lit(mark))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), F.when(apart, F.concat(state["parts"], piece)).otherwise(state["parts"]).alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    done = F.aggregate("s", start, cut, lambda a: F.concat(F.array_join(a["parts"], ""), F.substr(text, a["at"] + 1)))
    inner = inner.withColumn("cut", F.when(F.size("s") > 0, done))
    new = {"text": F.coalesce("cut", text)}
    if "n_chars" in names:
        n = F.col(f"c{names.index('n_chars')}")
        new["n_chars"] = F.when(F.col("cut").isNotNull(), F.length("cut").cast(docs.schema["n_chars"].dataType)).otherwise(n)
    return inner.select(*(new.get(c, F.col(f"c{i}")).alias(c) for i, c in enumerate(names)))
