"""Cleaning expressions: ``Column -> Column``, all evaluated inside the JVM.

Whitespace and word characters are spelled out instead of using ``\\s`` and
``\\w``: both are ASCII-only in Java unless switched, and then still differ from
the Unicode definitions the cleaning rules are based on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from kotomori.config import CLEAN, CleanSettings

SPACES = (
    r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
#: The same characters one by one.
SPACE_CHARS = "".join(
    map(chr, [*range(0x9, 0xE), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
URL = rf"https?://[^{SPACES}]+|www\.[^{SPACES}]+"
TAG = r"<[^>]+>"
SPACE_RUN = rf"[{SPACES}]+"
# runs that are not one plain space already
UNEVEN_SPACE = rf"[{SPACES}&&[^ ]][{SPACES}]*| [{SPACES}]+"
NON_SPACE = rf"[^{SPACES}]"
WORD_CHAR = r"[\p{L}\p{N}_]"
NON_WORD_RUN = r"[^\p{L}\p{N}_]+"

# One token per run of kanji, hiragana, katakana, hangul, Latin/Greek/Cyrillic
# with digits, or another alphabet; any other visible character stands alone.
SCRIPT_RUN = (
    r"[\x{4e00}-\x{9fff}]+|[\x{3040}-\x{309f}]+|[\x{30a0}-\x{30ff}]+|[\x{ac00}-\x{d7a3}]+"
    r"|[0-9A-Za-z_\x{c0}-\x{24f}\x{370}-\x{52f}]+|[\x{590}-\x{10ff}]+"
    rf"|{NON_SPACE}"
)
# The same with the commonest kind first; no two kinds share a character.
SCRIPT_RUN_LATIN_FIRST = "|".join(sorted(SCRIPT_RUN.split("|"), key=lambda kind: "A-Z" not in kind))


def is_ascii(c: Column) -> Column:
    return F.octet_length(c) == F.char_length(c)


def _icu(c: Column, method: str) -> Column:
    # ICU is part of every Spark 4 distribution; ASCII and NULL need no call
    folded = F.reflect(
        F.lit("com.ibm.icu.text.Normalizer"), F.lit(method), F.coalesce(c, F.lit("")), F.lit(True)
    )
    return F.when(c.isNull() | is_ascii(c), c).otherwise(folded)


def nfkc(c: Column) -> Column:
    """Compatibility composition."""
    return _icu(c, "compose")


def nfkd(c: Column) -> Column:
    return _icu(c, "decompose")


def strip_urls(c: Column) -> Column:
    return F.when(c.contains("http") | c.contains("www."), F.regexp_replace(c, URL, "")).otherwise(c)


def strip_html(c: Column) -> Column:
    return F.when(c.contains("<"), F.regexp_replace(c, TAG, "")).otherwise(c)


def squash_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, UNEVEN_SPACE, " "))


def guard_text(c: Column) -> Column:
    """NULL and all-whitespace text become the empty string."""
    return F.when(c.rlike(NON_SPACE), c).otherwise(F.lit(""))


def char_tokens(c: Column, without: tuple[str, ...] = ()) -> Column:
    """All visible characters but those of ``without``, by code points and not by a match each."""
    kept = F.translate(c, SPACE_CHARS + "".join(without), "")
    return F.array_remove(F.split(kept, ""), "")  # an empty text splits into one empty string


def segment_tokens(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(SCRIPT_RUN_LATIN_FIRST), F.lit(0))


def drop_stopwords(tokens: Column, stopwords: tuple[str, ...] = CLEAN.stopwords) -> Column:
    return F.filter(tokens, lambda t: ~t.isin(*stopwords))


def _steps(c: Column, *steps: Callable[[Column], Column]) -> Column:
    """``c`` through all steps. Each may name its argument more than once: it is a variable."""
    held = F.array(c)
    for step in steps:
        held = F.transform(held, step)
    return F.get(held, F.lit(0))


def clean_string(c: Column) -> Column:
    """The string part of the chain: guard, NFKC, URLs, tags, whitespace."""
    return _steps(guard_text(c), nfkc, strip_urls, strip_html, squash_ws)


def clean_tokens(c: Column, settings: CleanSettings = CLEAN) -> Column:
    stopwords = settings.stopwords if settings.remove_stops else ()
    if settings.tokenizer == "char":
        # no character is white space, and only a stop word of one character is a token
        return char_tokens(_steps(guard_text(c), nfkc, strip_urls, strip_html), tuple(w for w in stopwords if len(w) == 1))
    tokens = {"script": segment_tokens}[settings.tokenizer](clean_string(c))
    return drop_stopwords(tokens, stopwords) if stopwords else tokens


def clean_text(c: Column, settings: CleanSettings = CLEAN) -> Column:
    return F.array_join(clean_tokens(c, settings), " ")


def preview(c: Column, chars: int = 60) -> Column:
    return F.concat(F.substring(c, 1, chars), F.lit("..."))
