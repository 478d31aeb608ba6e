"""Secrets in texts, in built-in functions only.

Three fixed kinds are found by pattern. Besides, candidate strings (unbroken runs of letters,
digits and signs) are searched with a sliding window: while it moves, the counts of the
characters in it change by one that enters and one that leaves, and with them the sum of
c log2 c, from which the Shannon entropy follows. A character class has its own alphabet and
its own threshold. Candidates on the allow-list are suppressed: words without digits, runs that
count up, UUIDs, checksums that are named as such, and placeholders.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"
    r"|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{32,}"  # a run of fewer would be dropped, and runs don't overlap
CANDIDATE = "(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"  # a whole run
#: Suppressed candidates: fixed values, matched on the whole candidate.
ALLOWED = (
    r"[^0-9]*",  # no digit: words, headings, separators
    r"[0-9_=+/-]*",  # no letter: numbers, dates, rulers
    r"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",  # UUID
    r"(?i).*(example|sample|placeholder|changeme|dummy|0123456789|abcdefgh).*",
    r"(?i)(sha(1|256|384|512)|md5)[-=_].*",  # a checksum that says so
    r"[a-z]+([_/-][a-z0-9]{1,12})+",  # identifiers, slugs and paths
)
#: Candidates that are base spans as a whole, which leave entropy nothing to add.
WHOLE = "^(AKIA[A-Z0-9]{12,}|[0-9a-f]{32,})$"
_ALLOWED = "^(" + "|".join(f"({p})" for p in ALLOWED) + ")$"


@dataclass(frozen=True)
class CharClass:
    """`bits` is the entropy that a window of `width` characters must reach."""

    name: str
    pattern: str
    width: int
    bits: float


CLASSES = (
    CharClass("hex", "^[0-9a-fA-F]+$", 20, 3.1),
    CharClass("alnum", "^[A-Za-z0-9]+$", 20, 3.7),
    CharClass("base64", "^[A-Za-z0-9+/_=-]+$", 20, 3.9),
)


BLOCK = 1024  # numbers, or code points, that are handled together so that long texts cost no squares


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once, also where it is used once for each element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _before(numbers: Column) -> Column:
    """The sum of all numbers before each: within blocks, then over the blocks."""

    def running(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("sum"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(
            values, start, lambda s, x: F.struct((s["sum"] + x).alias("sum"), F.array_append(s["before"], s["sum"]).alias("before"))
        )

    def over(blocks: Column) -> Column:
        offsets = running(F.transform(blocks, lambda b: b["sum"]))["before"]
        return F.flatten(F.zip_with(blocks, offsets, lambda b, o: F.transform(b["before"], lambda x: x + o)))

    def cut(values: Column) -> Column:
        last = F.greatest(F.shiftright(F.size(values) - 1, 10), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda k: running(F.slice(values, k * BLOCK + 1, BLOCK)))

    return _let(_let(numbers, cut), over)


def _pieces(text: Column, pattern: str) -> Column:
    """Matches of a pattern with their places: structs of begin, end (code points) and match.

    Splitting gives what lies between the matches; both lists together give every place.
    """

    def places(x: Column) -> Column:
        before = _before(F.zip_with(x["gaps"], x["found"], lambda g, m: g + F.length(m)))
        begins = F.zip_with(before, x["gaps"], lambda b, g: b + g)
        return F.zip_with(
            begins, x["found"], lambda b, m: F.struct(b.alias("begin"), (b + F.length(m)).alias("end"), m.alias("match"))
        )

    def measured(found: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        return F.struct(found.alias("found"), F.slice(gaps, F.lit(1), F.size(found)).alias("gaps"))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return _let(_let(found, measured), places)


def _stretches(ranges: list[tuple[Column, int]], holds: Callable[[Column], Column]) -> Column:
    """Between the ends of all spans, the stretches (begin, end) whose weight `holds`.

    A stretch weighs what the spans over it weigh: each list of spans comes with the weight of one.
    """

    def ends(spans: Column, end: str, weight: int) -> Column:
        return F.transform(spans, lambda x: F.struct(x[end].alias("at"), F.lit(weight).alias("weight")))

    events = F.concat(*[ends(spans, end, w) for spans, weight in ranges for end, w in (("begin", weight), ("end", -weight))])

    def weighed(events: Column) -> Column:
        weights = F.transform(events, lambda x: x["weight"])
        sums = F.zip_with(_before(weights), weights, lambda b, w: b + w)
        following = F.transform(F.slice(events, F.lit(2), F.greatest(F.size(events), F.lit(1))), lambda x: x["at"])
        until = F.zip_with(events, following, lambda x, n: F.struct(x["at"].alias("begin"), n.alias("end")))
        every = F.zip_with(until, sums, lambda u, w: F.struct(u["begin"].alias("begin"), u["end"].alias("end"), w.alias("weight")))
        return F.filter(every, lambda x: (x["begin"] < x["end"]) & holds(x["weight"]))

    return _let(F.array_sort(events), weighed)


def _c_log_c(c: Column) -> Column:
    return F.when(c > 0, c * F.log2(F.greatest(c, F.lit(1)).cast("double"))).otherwise(F.lit(0.0))


def hot_range(candidate: Column, width: int, bits: float) -> Column:
    """From the first to the end of the last window with enough entropy; null without one.

    The window's entropy is log2(width) - sum(c log2 c) / width over the counts c in it.
    """
    characters = F.filter(F.split(candidate, ""), lambda c: c != "")
    most = float(width) * (math.log2(width) - bits)
    none = F.lit(None).cast("int")

    def coded(characters: Column) -> Column:
        """Each character as its number among the different ones, from 1."""
        return _let(
            F.array_distinct(characters), lambda d: F.transform(characters, lambda c: F.array_position(d, c).cast("int"))
        )

    def step(s: Column, x: Column) -> Column:
        enters, leaves, n = x["enters"], x["leaves"], s["n"] + 1
        c_in = F.element_at(s["counts"], enters)
        grown = s["sum"] + _c_log_c(c_in + 1) - _c_log_c(c_in)
        changed = F.transform(s["counts"], lambda c, k: c + (k + 1 == enters).cast("int") - (k + 1 == leaves).cast("int"))
        c_out = F.element_at(s["counts"], F.greatest(leaves, F.lit(1))) + (enters == leaves).cast("int")
        total = F.when(leaves > 0, grown - _c_log_c(c_out) + _c_log_c(c_out - 1)).otherwise(grown)
        hot = (n >= width) & (total <= most + 1e-9)
        first = F.when(s["first"].isNull() & hot, n - width).otherwise(s["first"])
        last = F.when(hot, n).otherwise(s["last"])
        return F.struct(changed.alias("counts"), total.alias("sum"), n.alias("n"), first.alias("first"), last.alias("last"))

    def slide(codes: Column) -> Column:
        zeros = F.array_repeat(F.lit(0), F.array_max(codes))
        start = F.struct(
            zeros.alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("n"), none.alias("first"), none.alias("last")
        )
        late = F.slice(F.concat(F.array_repeat(F.lit(0), width), codes), F.lit(1), F.size(codes))
        moves = F.zip_with(codes, late, lambda c, d: F.struct(c.alias("enters"), d.alias("leaves")))
        return F.aggregate(moves, start, step)

    def found(s: Column) -> Column:
        return F.when(s["first"].isNotNull(), F.struct(s["first"].alias("first"), s["last"].alias("last")))

    return _let(_let(_let(characters, coded), slide), found)


def _entropy_spans(text: Column, classes: tuple[CharClass, ...]) -> Column:
    def searched(x: Column) -> Column:
        return ~(F.rlike(x["match"], F.lit(WHOLE)) | F.rlike(x["match"], F.lit(_ALLOWED)))

    candidates = F.filter(_pieces(text, CANDIDATE), searched)

    def hot(x: Column) -> Column:
        found = F.lit(None).cast("struct<first:int,last:int>")
        for c in reversed(classes):  # the narrowest class that fits decides
            found = F.when(F.rlike(x["match"], F.lit(c.pattern)), hot_range(x["match"], c.width, c.bits)).otherwise(found)
        return F.struct(x["begin"].alias("at"), found.alias("hot"))

    found = F.filter(F.transform(candidates, hot), lambda x: x["hot"].isNotNull())
    return F.transform(found, lambda x: _span("entropy", x["at"] + x["hot"]["first"], x["at"] + x["hot"]["last"]))


def _span(kind: str, begin: Column, end: Column) -> Column:
    return F.struct(begin.alias("begin"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), end.alias("end"))


_SPANS = "array<struct<begin:int,rank:int,kind:string,end:int>>"


def scan_secrets(docs: DataFrame, text: str = "text", into: str = "secrets", classes: tuple[CharClass, ...] = CLASSES) -> DataFrame:
    """`docs` with a struct `into`: `base` and `spans`, each a list of (begin, rank, kind, end) in
    order of begin and kind; `spans` holds the base spans and, cut to what those leave, the spans
    found by entropy. Places are code points, ends are exclusive.

    A null text counts as empty. Every row is judged by itself, without a shuffle, so repeated
    rows get equal results and an empty table an empty one; a column of `docs` named like `into` is
    replaced, others may have any name. Work grows with a text's length, also where it has very many matches.
    """
    value = F.coalesce(F.col(text), F.lit(""))

    def kind(name: str, pattern: str, holds) -> Column:
        found = F.filter(_pieces(value, pattern), holds)
        spans = F.transform(found, lambda x: _span(name, x["begin"], x["end"])).cast(_SPANS)
        # Few texts hold any: the others are read by one search a kind and no more.
        return F.when(F.rlike(value, F.lit(pattern)), spans).otherwise(F.array().cast(_SPANS))

    base = F.array_sort(
        F.concat(
            kind("assign", ASSIGN, lambda x: F.length(F.regexp_extract(x["match"], ASSIGN, 2)) >= 8),
            kind("access", ACCESS, lambda x: F.length(x["match"]) >= 16),
            kind("hex", HEX, lambda x: F.length(x["match"]) >= 32),
        )
    )
    entropy = F.when(F.rlike(value, F.lit(CANDIDATE)), _entropy_spans(value, classes).cast(_SPANS)).otherwise(F.array().cast(_SPANS))

    def joined(x: Column) -> Column:
        # A base span weighs 1, one found by entropy more than all base spans over a place.
        apart = _stretches([(x["base"], 1), (x["entropy"], len(KINDS))], lambda w: w == len(KINDS))
        cut = F.transform(apart, lambda y: _span("entropy", y["begin"], y["end"])).cast(_SPANS)
        spans = F.when(F.size(x["base"]) == 0, x["entropy"]).when(F.size(x["entropy"]) == 0, x["base"])
        return F.struct(x["base"].alias("base"), spans.otherwise(F.array_sort(F.concat(x["base"], cut))).alias("spans"))

    return docs.withColumn(into, _let(F.struct(base.alias("base"), entropy.alias("entropy")), joined))


def listed(spans: Column) -> Column:
    """`kind:begin:end`, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["begin"], x["end"])), ",")


def redact(docs: DataFrame, text: str = "text", mark: str = "<secret>") -> DataFrame:
    """The documents with every span of `scan_secrets` replaced by `mark`; other texts stay.

    Spans that overlap or touch become one mark. Columns keep their order and may have any names;
    a null text stays null.
    """
    into = "secrets"
    while into in docs.columns:
        into += "_"
    found = scan_secrets(docs, text, into)

    def part(blocks: Column, begin: Column, end: Column) -> Column:
        first = F.shiftright(begin, 10)
        around = F.array_join(F.slice(blocks, first + 1, F.shiftright(end - 1, 10) - first + 1), "")
        return F.substr(around, begin - first * BLOCK + 1, end - begin)

    def cleaned(x: Column) -> Column:
        gaps = F.transform(x["gaps"], lambda g: part(x["blocks"], g["begin"], g["end"]))
        return F.array_join(gaps, mark)

    spans = F.col(f"`{into}`.spans")
    length = F.length(F.col(text))
    # What stands before the first span and behind the last is a gap too, be it empty.
    inner = _stretches([(spans, 1)], lambda w: w == 0)
    lead = F.struct(F.lit(0).alias("begin"), F.array_min(F.transform(spans, lambda x: x["begin"])).alias("end"))
    trail = F.struct(F.array_max(F.transform(spans, lambda x: x["end"])).alias("begin"), length.alias("end"))
    between = F.transform(inner, lambda x: F.struct(x["begin"].alias("begin"), x["end"].alias("end")))
    gaps = F.concat(F.array(lead), between, F.array(trail))
    blocks = F.regexp_extract_all(F.col(text), F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    made = _let(F.struct(gaps.alias("gaps"), blocks.alias("blocks")), cleaned)
    return found.withColumn(text, F.when(F.size(spans) > 0, made).otherwise(F.col(text))).drop(into)
