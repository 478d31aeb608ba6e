"""Column expressions over text. All but rare HTML entities stay in the JVM."""

from __future__ import annotations

import functools
import html
import sys
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from postgauge.functions import fixed

WS = fixed.WHITESPACE
WORD_CHAR = r"\p{L}\p{N}_"


def text(c: str | Column) -> Column:
    """A text column with null read as empty."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string"), F.lit(""))


def concat_text(*columns: str) -> Column:
    """Text columns joined with one space; null counts as empty."""
    return F.concat_ws(" ", *[text(c) for c in columns])


def strip(c: Column) -> Column:
    """Drop Unicode white space from both ends."""
    return F.btrim(c, F.lit(fixed.WHITESPACE_CHARS))


def clean_tags(c: str) -> Column:
    """Brackets and bars become spaces; ends are trimmed, inner spaces kept."""
    return strip(F.regexp_replace(F.col(c), r"[\[\]<>|]", " "))


# --- counts ---------------------------------------------------------------

def whitespace_words(c: Column) -> Column:
    """Number of white-space separated words."""
    return F.regexp_count(c, F.lit(f"[^{WS}]++"))


def contains_question_mark(c: str) -> Column:
    """1 where the text holds a question mark anywhere."""
    return F.contains(text(c), F.lit("?")).cast("int")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the whole is 0."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def caps_ratio(c: str) -> Column:
    """Share of characters that are A-Z."""
    return ratio(F.regexp_count(text(c), F.lit("[A-Z]")), F.length(text(c)))


def whole(pattern: str) -> str:
    """The pattern where no word character touches it."""
    return rf"(?<![{WORD_CHAR}])(?:{pattern})(?![{WORD_CHAR}])"


def action_density(c: str) -> Column:
    """Action phrases per white-space word."""
    hits = F.regexp_count(text(c), F.lit("(?iu)" + whole("|".join(fixed.ACTION_PHRASES))))
    return ratio(hits, whitespace_words(text(c)))


# --- tokens ---------------------------------------------------------------

def readability_tokens(c: Column) -> Column:
    """Runs between white space and sentence marks: punctuation stays glued to its word."""
    return F.regexp_extract_all(c, F.lit(f"[^.!?{WS}]++"), F.lit(0))


def readability_sentences(c: Column) -> Column:
    """Number of non-blank stretches between sentence marks."""
    return F.regexp_count(c, F.lit(f"[^.!?{WS}][^.!?]*"))


def split_sentences(c: Column) -> Column:
    """Sentences end at white space after a sentence mark; blank ones are dropped."""
    parts = F.split(c, rf"(?<=[.!?])[{WS}]+")
    return F.filter(parts, lambda s: s.rlike(f"[^{WS}]"))


TOKEN_PATTERN = rf"[{WORD_CHAR}]++|[^{WORD_CHAR}{WS}]"


def word_tokens(c: Column) -> Column:
    """Words and single punctuation marks, in reading order."""
    return F.regexp_extract_all(c, F.lit(TOKEN_PATTERN), F.lit(0))


def token_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(TOKEN_PATTERN))


def token_usage(c: Column, words: list[str]) -> Column:
    """Tokens that are one of the words, case included."""
    return F.regexp_count(c, F.lit(whole("|".join(words))))


def word_count(c: Column) -> Column:
    """Tokens made of letters only."""
    return F.regexp_count(c, F.lit(whole(r"\p{L}+")))


def unique_fraction(c: Column) -> Column:
    """Distinct tokens over all tokens, 0 for an empty text."""
    return ratio(F.size(F.array_distinct(word_tokens(c))), token_count(c))


def is_alphabetic(c: Column) -> Column:
    """Only letters, of any script."""
    return c.rlike(r"^\p{L}+$")


def flesch(sentences: Column, words: Column, syllables: Column) -> Column:
    """Flesch reading ease, 0 without sentences or words."""
    score = (
        F.lit(fixed.FLESCH_BASE)
        - F.lit(fixed.FLESCH_PER_SENTENCE) * F.try_divide(words.cast("double"), sentences.cast("double"))
        - F.lit(fixed.FLESCH_PER_WORD) * F.try_divide(syllables.cast("double"), words.cast("double"))
    )
    return F.coalesce(score, F.lit(0.0))


# --- cleaning -------------------------------------------------------------

def _ascii_parts() -> dict[str, str]:
    """Every other character whose compatibility decomposition holds ASCII, with that part of it."""
    parts = {}
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        if unicodedata.decomposition(c):
            parts[c] = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode("ascii")
    return {c: part for c, part in parts.items() if part}


@functools.cache
def _ascii_tables() -> tuple[str, str, str, str]:
    """Characters that become one, those they become, a pattern of the others, and their table."""
    parts = _ascii_parts()
    one = [c for c, part in parts.items() if len(part) == 1]
    more = [c for c in parts if len(parts[c]) > 1]
    # A class is tried range by range: few ranges, and none of them on an ASCII character.
    starts = [c for c in more if chr(ord(c) - 1) not in more]
    ends = [c for c in more if chr(ord(c) + 1) not in more]
    ranges = "".join(f"\\x{{{ord(a):x}}}-\\x{{{ord(b):x}}}" for a, b in zip(starts, ends, strict=True))
    pattern = f"(?![\\x00-\\x7f])[{ranges}]"
    return "".join(one), "".join(parts[c] for c in one), pattern, "\n".join(f"{c}\t{parts[c]}" for c in more)


def fold_to_ascii(c: Column) -> Column:
    """The ASCII part of a text's compatibility decomposition.

    Only ASCII stays, so each character folds by itself: most by translation, the few that
    become several (ligatures, fractions, ellipses) by a replacement for each one a text holds.
    """
    one, into, pattern, table = _ascii_tables()
    several = F.str_to_map(F.lit(table), F.lit("\n"), F.lit("\t"))
    held = F.array_distinct(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)))
    wide = F.aggregate(held, c, lambda s, x: F.replace(s, x, F.element_at(several, x)))
    return F.regexp_replace(F.translate(F.when(c.rlike(pattern), wide).otherwise(c), one, into), r"[^\x00-\x7f]+", "")


def clean_ascii(c: str | Column) -> Column:
    """Trim, lower, decompose, drop what is not ASCII; without a Python worker."""
    low = F.lower(strip(text(c)))
    return F.when(F.octet_length(low) != F.length(low), fold_to_ascii(low)).otherwise(low)


# Content that is not text, then markup; one pattern per element. Groups repeat
# possessively: Java would otherwise recurse once per attribute and overflow its stack.
HTML_DROPS = [
    r"(?is)<script\b.*?(?:</script\s*>|\z)",
    r"(?is)<style\b.*?(?:</style\s*>|\z)",
    r"(?is)<template\b.*?(?:</template\s*>|\z)",
    r"(?s)<!--.*?(?:-->|\z)",
    r"<[!?][^>]*>",
    r"""</?[a-zA-Z][^>"']*+(?:(?:"[^"]*+"|'[^']*+')[^>"']*+)*+>""",
    r"</?[a-zA-Z][^>]*>",
]

# Entities decoded by plain replacement; the ampersand must come last.
COMMON_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&nbsp;", " "),
    ("&copy;", "©"),
    ("&middot;", "·"),
    ("&amp;", "&"),
]
_RARE_ENTITY = "&(?!(?:" + "|".join(e[1:-1] for e, _ in COMMON_ENTITIES) + ");)[#A-Za-z]"


@F.pandas_udf(StringType())
def _decode_entities(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


# Stands where markup was until entities are decoded, so an entity never continues
# behind a tag; no character of any text.
SEAM = "\uffff"


def strip_html(c: str | Column) -> Column:
    """HTML to text; tags leave no separator, null becomes empty."""
    out = text(c)
    for pattern in HTML_DROPS:
        out = F.regexp_replace(out, pattern, SEAM)
    plain = out
    for entity, char in COMMON_ENTITIES:
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    rare = out.rlike(_RARE_ENTITY)
    decoded = F.when(rare, _decode_entities(F.when(rare, out))).otherwise(plain)
    return F.replace(decoded, F.lit(SEAM), F.lit(""))
