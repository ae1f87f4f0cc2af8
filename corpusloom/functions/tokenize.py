"""Tokenizers: a plain regex one that SQL engines share, and the full one as an Arrow function."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, functions as F

from . import text as X

PLAIN = r"[\p{L}\p{M}\p{N}]+"
_LETTER, _DIGIT = r"[\p{L}\p{M}]", r"\d"
_EMOJI = r"\p{Extended_Pictographic}(?:\ufe0f|\p{Emoji_Modifier}|\u200d\p{Extended_Pictographic})*|\p{Regional_Indicator}{2}"
#: A word: its characters, marks that join letters, marks that join digits.
_WORD = rf"(?!['’_])[\w\p{{M}}](?:[\w\p{{M}}]|(?<={_LETTER})[.’'·:](?={_LETTER})|(?<={_DIGIT})[.,'’](?={_DIGIT}))*"
_ELIDED = {"fr": r"(?<=\b(?:[cdjlmnst]|qu|jusqu|lorsqu|puisqu))'", "it": r"(?<=\b(?:[cdlmnstv]|un|dell|nell|all|dall|sull|quest))'", "ca": r"(?<=\b[dlmnst])'"}
_MARKS = r"[\p{P}\p{S}]+"


def plain_tokens(text: Column) -> Column:
    """Lower-cased runs of letters, marks and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(PLAIN), F.lit(0))


def fix_mojibake(text: str) -> str:
    """UTF-8 that was read as Windows-1252 back to what it was, where that is sure."""
    for _ in range(2):
        if not any(c in text for c in "ÃÂâðÐÑ"):
            break
        raw = bytearray()
        try:
            for c in text:
                try:
                    raw += c.encode("cp1252")
                except UnicodeEncodeError:
                    raw += c.encode("latin-1")
            fixed = raw.decode("utf-8")
        except UnicodeError:
            break
        if len(fixed) >= len(text):
            break
        text = fixed
    return text


def unescape(text: str) -> str:
    """Character references that end in a semicolon."""
    return regex.sub(r"&(?:#\d+|#[xX][0-9a-fA-F]+|\w+);", lambda m: html.unescape(m[0]), text)


def fix_surrogates(text: str) -> str:
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace")


def clean(text: str, mojibake: bool = False) -> str:
    """Targeted fixes, or all of them with ``mojibake``."""
    if mojibake:
        text = fix_mojibake(text)
    if "&" in text:
        text = unescape(text)
    if not text.isascii():
        text = fix_surrogates(text)
    for end in ("\r\n", "\r", "\u2028", "\u2029", "\u0085"):
        text = text.replace(end, "\n")
    return text


@lru_cache(maxsize=64)
def _pattern(lang: str, punctuation: bool) -> regex.Pattern:
    parts = [_WORD, _EMOJI] + ([_MARKS] if punctuation else [])
    return regex.compile("|".join(parts))


def tokenize(text: str, lang: str = "und", punctuation: bool = False) -> list[str]:
    """Case-folded tokens; decimals whole, an emoji cluster one token, marks as tokens on request."""
    base = lang.split("-")[0]
    text = unicodedata.normalize("NFKC" if base in ("ja", "ar", "fa", "ur") else "NFC", text).casefold()
    if base in ("ar", "fa", "ur"):
        text = regex.sub(r"[\p{Mn}ـ]", "", text)
    if base in _ELIDED:
        text = regex.sub(_ELIDED[base], " ", text)
    return _pattern(base, punctuation).findall(text)


def tokens(text: Column, lang: Column, punctuation: bool = False, mojibake: bool = False) -> Column:
    """The full tokenizer over Arrow batches."""

    @F.pandas_udf("array<string>")
    def run(texts: pd.Series, langs: pd.Series) -> pd.Series:
        return pd.Series([tokenize(clean(t, mojibake), x or "und", punctuation) if t is not None else None for t, x in zip(texts, langs)])

    return run(text, lang)


def token_text(text: Column, lang: Column, punctuation: bool = False, mojibake: bool = False) -> Column:
    """The tokens joined by spaces, joined text by text: a batch's tokens are never all held."""

    @F.pandas_udf("string")
    def run(texts: pd.Series, langs: pd.Series) -> pd.Series:
        return pd.Series([" ".join(tokenize(clean(t, mojibake), x or "und", punctuation)) if t is not None else None for t, x in zip(texts, langs)], dtype="object")

    return run(text, lang)


def smash_digits(token: Column) -> Column:
    """Digits of runs of two characters or more, separators included, to 0; single digits stay."""
    runs = F.regexp_replace(token, r"(\d[\d.,]+)", "\u0001$1\u0001")
    return F.array_join(F.transform(F.split(runs, "\u0001"), lambda p, i: F.when(i % 2 == 1, F.regexp_replace(p, r"\d", "0")).otherwise(p)), "")


def smash_whole_tokens(token: Column) -> Column:
    """All digits of a token that has such a run to 0, single ones too."""
    return F.when(token.rlike(r"\d[\d.,]"), F.regexp_replace(token, r"\d", "0")).otherwise(token)


def has_content(token: Column) -> Column:
    """Letters, digits or symbols such as notes and emoji; punctuation alone doesn't count."""
    return token.rlike(r"[\p{L}\p{N}\p{So}]")


def lossy_tokens(term: Column, smash: Callable[[Column], Column] = smash_digits) -> Column:
    """Plain tokens of a count list's terms, digits smashed; marks inside numbers kept."""
    found = F.regexp_extract_all(X.fold_case(term), F.lit(r"\d[\d.,]*\d|[\p{L}\p{M}\p{N}]+(?:['’.·:][\p{L}\p{M}]+)*|\p{So}"), F.lit(0))
    return F.transform(found, smash)


def casefold(text: Column) -> Column:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.str.casefold()

    return run(text)


def fold_lines(text: Column, width: int = 1000) -> Column:
    """Lines of at most ``width`` bytes, broken after spaces where there are some."""

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series([fold(t, width) if t is not None else None for t in s])

    return run(text)


def fold(text: str, width: int) -> list[str]:
    out = []
    for line in text.split("\n"):
        now, size, space = [], 0, -1
        for c in line:
            n = len(c.encode("utf-8", "surrogatepass"))
            if size + n > width and now:
                cut = space + 1 if space >= 0 else len(now)
                out.append("".join(now[:cut]))
                now = now[cut:]
                size = sum(len(x.encode("utf-8", "surrogatepass")) for x in now)
                space = max((i for i, x in enumerate(now) if x == " "), default=-1)
            now.append(c)
            size += n
            if c == " ":
                space = len(now) - 1
        out.append("".join(now))
    return out
