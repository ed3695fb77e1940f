"""Text functions as Column expressions.

Java's ``\\s`` and ``\\w`` are ASCII only, so the Unicode classes are spelt out;
the same spelling is accepted by RE2, which keeps SQL cross-checks possible.
"""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
NON_SPACE = r"[^\s\x0b\x1c-\x1f\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"

# Steps are (pattern, replacement), applied left to right. A pattern of None lowers the text.
LOWER = (None, "")
SQUEEZE = (SPACE + "+", " ")
HANDLE = ("@" + WORD + "+", " ")
STRICT_URL = ("https?://" + NON_SPACE + "+", " ")
LOOSE_URL = ("http" + NON_SPACE + "+", " ")

PROFILES: dict[str, list[tuple[str | None, str]]] = {
    # incoming messages: punctuation is kept because rule phrases contain it
    "message": [LOOSE_URL, HANDLE, SQUEEZE, LOWER],
    # text that goes into an index: only a-z, 0-9 and single blanks survive
    "index": [LOWER, STRICT_URL, HANDLE, (r"[^a-z0-9\s\x0b\x1c-\x1f\x{85}\p{Z}]", " "), SQUEEZE],
    # as "message", but only well-formed links are removed
    "weak_label": [LOWER, STRICT_URL, HANDLE, SQUEEZE],
    # before clustering: hashtags are unwrapped and entities dropped
    "cluster": [
        STRICT_URL,
        HANDLE,
        ("#(" + WORD + "+)", "$1"),
        ("&" + WORD + "+;", " "),
        SQUEEZE,
        LOWER,
    ],
    # blanks only
    "squeeze": [SQUEEZE],
    # as "message" without squeezing blanks
    "prelabel": [LOWER, LOOSE_URL, HANDLE],
    "lower": [LOWER],
}


def clean(text: Column, profile: str = "message") -> Column:
    """Clean ``text`` with a named profile; null becomes the empty string."""
    out = F.coalesce(text, F.lit(""))
    for pattern, replacement in PROFILES[profile]:
        if pattern is None:
            out = F.lower(out)
        else:
            out = F.regexp_replace(out, pattern, replacement)
    # squeezed text holds no blank but " ", so trim() is a full strip
    return F.trim(out) if SQUEEZE in PROFILES[profile] else out


def strip(text: Column) -> Column:
    """Trim every kind of blank, not only U+0020."""
    return F.regexp_replace(text, f"^{SPACE}+|{SPACE}+$", "")


def normalize_id(value: Column) -> Column:
    """Ids that travelled through a float column: drop a trailing ``.0``; null becomes ``""``."""
    return F.coalesce(F.regexp_replace(strip(value.cast("string")), r"\.0$", ""), F.lit(""))


def word_count(cleaned: Column) -> Column:
    """Number of blank-separated words of an already squeezed text."""
    return F.when(cleaned == "", F.lit(0)).otherwise(F.size(F.split(cleaned, " ")))


def is_useful(squeezed: Column, min_chars: int = 20, min_words: int = 4) -> Column:
    """Long enough in characters and words. The words of a squeezed text are its blanks and one;
    counting them needs no pattern with a repeated group, which recurses once per word."""
    words = F.length(squeezed) - F.length(F.replace(squeezed, F.lit(" "))) + 1
    return (F.length(squeezed) >= max(1, min_chars)) & (words >= min_words)


# --- phrases ----------------------------------------------------------------------------


def contains_any(text: Column, phrases: Sequence[str], match: str = "substring") -> Column:
    """True if any phrase occurs. Substring matching is the default ("ont" hits "month");
    ``match="word"`` asks for whole words."""
    if not phrases:
        return F.lit(False)
    if match == "word":
        body = "|".join(_quote(p) for p in phrases)
        return text.rlike(f"(?<!{WORD})(?:{body})(?!{WORD})")
    if match != "substring":
        raise ValueError(f"unknown match mode {match!r}")
    hit = None
    for phrase in phrases:
        if not any(other != phrase and other in phrase for other in phrases):
            hit = text.contains(phrase) if hit is None else hit | text.contains(phrase)
    return hit


def _quote(phrase: str) -> str:
    return "".join(ch if ch.isalnum() or ch == " " else "\\" + ch for ch in phrase)


def phrase_hits(text: Column, phrases: Sequence[str]) -> Column:
    """How many of the phrases occur; each counts once however often it is repeated."""
    total = F.lit(0)
    for phrase in phrases:
        total = total + text.contains(phrase).cast("int")
    return total


def matches_any(text: Column, patterns: Sequence[str]) -> Column:
    """Case-insensitive search for any of the regular expressions."""
    return F.coalesce(text, F.lit("")).rlike("(?i)(?:" + "|".join(patterns) + ")")


def replace_in_order(text: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements applied one after the other on the lowered text."""
    out = F.lower(F.coalesce(text, F.lit("")))
    for old, new in pairs:
        if old != new:
            out = F.replace(out, F.lit(old), F.lit(new))
    return out


# --- historical replies ------------------------------------------------------------------

COMMON_ENTITIES = [
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&apos;", "'"),
    ("&nbsp;", " "),
    ("&middot;", "·"),
    ("&copy;", "©"),
    ("&amp;", "&"),  # last, so "&amp;lt;" is unescaped once only
]


@F.pandas_udf(T.StringType())
def _unescape_all(text: pd.Series) -> pd.Series:
    return text.map(html.unescape, na_action="ignore")


def unescape(text: Column, entities: str = "full") -> Column:
    """HTML entities to characters. ``full`` knows every named and numeric entity through one
    Arrow batch call; ``common`` stays in the JVM and knows the list above."""
    text = F.coalesce(text, F.lit(""))
    if entities == "full":
        return _unescape_all(text)
    for entity, char in COMMON_ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def clean_reply(text: Column, entities: str = "full") -> Column:
    out = F.regexp_replace(unescape(text, entities), STRICT_URL[0], "")
    return F.trim(F.regexp_replace(out, *SQUEEZE))


def sanitize_reply(text: Column, entities: str = "full") -> Column:
    """A historical reply without links, handles and the trailing ``^XX`` signature."""
    out = F.regexp_replace(clean_reply(text, entities), HANDLE[0], "")
    out = F.regexp_replace(out, SPACE + r"+\^[A-Za-z]{2,5}" + SPACE + "*$", "")
    return F.trim(F.regexp_replace(out, *SQUEEZE))


# --- terms ----------------------------------------------------------------------------------


def tokens(text: Column, min_chars: int = 2) -> Column:
    """Lowered runs of at least ``min_chars`` word characters."""
    return F.regexp_extract_all(
        F.lower(F.coalesce(text, F.lit(""))), F.lit(f"({WORD}{{{min_chars},}})"), F.lit(1)
    )


def drop_stop_words(words: Column, stop_words: Sequence[str]) -> Column:
    if not stop_words:
        return words
    return F.filter(words, lambda w: ~w.isin(*stop_words))


def bigrams(words: Column) -> Column:
    """Neighbouring pairs. ``zip_with`` walks the arrays once, so long texts stay linear."""
    following = F.slice(words, F.lit(2), F.greatest(F.size(words), F.lit(1)))
    return F.array_compact(
        F.zip_with(words, following, lambda a, b: F.when(b.isNotNull(), F.concat(a, F.lit(" "), b)))
    )


def ngrams(words: Column, n_max: int = 2) -> Column:
    """Words, followed by bigrams when ``n_max`` is 2."""
    if n_max == 1:
        return words
    if n_max == 2:
        return F.concat(words, bigrams(words))
    raise ValueError("n_max must be 1 or 2")


# --- accents ----------------------------------------------------------------------------------

ACCENTED = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝŸ"
PLAIN = "aaaaaaceeeeiiiinooooouuuuyyAAAAAACEEEEIIIINOOOOOUUUUYY"


@F.pandas_udf(T.StringType())
def _strip_marks(text: pd.Series) -> pd.Series:
    def plain(value: str) -> str:
        return "".join(c for c in unicodedata.normalize("NFKD", value) if not unicodedata.combining(c))

    return text.map(plain, na_action="ignore")


def strip_accents(text: Column, mode: str = "latin") -> Column:
    """``latin`` maps Latin letters in the JVM; ``unicode`` decomposes every letter (Arrow)."""
    if mode == "unicode":
        return _strip_marks(text)
    return F.translate(text, ACCENTED, PLAIN)
