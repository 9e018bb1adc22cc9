"""Accent-insensitive text keys and keyword predicates, all as native expressions."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _folding_pairs() -> tuple[str, str]:
    """Letters whose canonical decomposition is one base letter plus marks, and that letter."""
    source, target = [], []
    for code in [*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = [
            c for c in unicodedata.normalize("NFD", letter) if unicodedata.category(c) != "Mn"
        ]
        if len(base) == 1 and base[0] != letter:
            source.append(letter)
            target.append(base[0])
    return "".join(source), "".join(target)


_FROM, _TO = _folding_pairs()
_MARKS = "[\\u0300-\\u036F]"


def fold(text: Column) -> Column:
    """Lower case without accents; null stays null. Text in plain ASCII is only lower-cased."""
    lower = F.lower(text)
    folded = F.regexp_replace(F.translate(lower, _FROM, _TO), _MARKS, "")
    return F.when(F.octet_length(text) == F.char_length(text), lower).otherwise(folded)


def ascii_fold(text: Column) -> Column:
    """As ``fold``, then every remaining non-ASCII character is dropped and blanks trimmed."""
    return F.trim(F.regexp_replace(fold(text), "[^\\x00-\\x7F]", ""))


def place_key(text: Column) -> Column:
    """Join key of a place name: folded, without blanks or hyphens; null gives ''."""
    return F.coalesce(F.translate(F.trim(fold(text)), " -", ""), F.lit(""))


def has_keyword(text: Column, keywords: list[str] | tuple[str, ...]) -> Column:
    """Any keyword occurs in the folded text; null counts as no match.

    One pattern for all keywords, so that a row is folded once.
    """
    pattern = "|".join(re.escape(k) for k in keywords)
    return F.coalesce(fold(text).rlike(pattern), F.lit(False))


def matches_keyword(text: Column, keywords: list[str] | tuple[str, ...]) -> Column:
    """Regex alternation on the lower-cased text, accents kept; null counts as no match."""
    return F.coalesce(F.lower(text).rlike("|".join(keywords)), F.lit(False))

