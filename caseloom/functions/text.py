"""String columns: accents, person names, match keys, safe extraction, labels."""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Connecting words left out of person names.
STOP_WORDS = ("de", "da", "do", "das", "dos", "e", "a", "o", "os", "as")


def _accent_table() -> tuple[str, str]:
    """Every composed character of the basic plane paired with its base letter."""
    composed, base = [], []
    for point in (*range(0x00C0, 0xD800), *range(0xE000, 0x10000)):
        char = chr(point)
        decomposed = unicodedata.normalize("NFD", char)
        if decomposed != char and all(unicodedata.combining(c) for c in decomposed[1:]):
            composed.append(char)
            base.append(decomposed[0])
    return "".join(composed), "".join(base)


_COMPOSED, _BASE = _accent_table()


def strip_accents(col: Column) -> Column:
    """Canonical decomposition followed by removal of combining marks."""
    return F.regexp_replace(F.translate(col, _COMPOSED, _BASE), r"\p{M}", "")


def clean_name(col: Column) -> Column:
    """Accent-free lower-case words separated by single blanks."""
    letters = F.regexp_replace(F.lower(strip_accents(col)), r"[^a-z\s]", " ")
    return F.trim(F.regexp_replace(letters, r"\s+", " "))


def name_tokens(col: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Words of an already cleaned name without the connecting words."""
    return F.filter(F.split(col, " "), lambda w: ~w.isin(*stop_words))


def standard_name(col: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    return F.array_join(name_tokens(clean_name(col), stop_words), " ")


def match_key(col: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    """Upper-case letters and digits only, connecting words dropped, never NULL."""
    spaced = F.regexp_replace(strip_accents(F.coalesce(col, F.lit(""))), "[^a-zA-Z0-9]", " ")
    kept = F.filter(F.split(spaced, " "), lambda w: ~F.lower(w).isin(*stop_words))
    return F.upper(F.array_join(kept, ""))


def digits_key(col: Column) -> Column:
    return F.regexp_replace(F.coalesce(col, F.lit("")), "[^0-9]", "")


def extract_or_null(col: Column, pattern: str, group: int = 1) -> Column:
    """``regexp_extract`` that yields NULL, not an empty string, on no match."""
    return F.when(col.rlike(pattern), F.regexp_extract(col, pattern, group))


def null_words(col: Column, words: Sequence[str] = ("none", "nan", "null", "", "nat", "<na>")) -> Column:
    """Text stand-ins for a missing value become NULL."""
    return F.when(~F.lower(F.trim(col)).isin(*words), col)


def contains_any(col: Column, *words: str) -> Column:
    """Case-insensitive substring test; NULL input stays NULL."""
    test = F.lit(False)
    for word in words:
        test = test | F.lower(col).contains(word.lower())
    return test


# Blanks that count as white space at the ends of a value.
WHITE_SPACE = " \t\n\r\x0b\x0c\x85\xa0\u2007\u202f\u3000"


def trim_space(col: Column) -> Column:
    return F.btrim(col, F.lit(WHITE_SPACE))


def is_test_name(col: Column, words: Sequence[str] = ("teste",)) -> Column:
    """True when a name marks a test record; an unknown name is not a test record."""
    return F.coalesce(contains_any(col, *words), F.lit(False))


def is_admin_account(login: Column, name: Column) -> Column:
    """True for test, administration and support accounts."""
    words = ("teste", "admin", "suporte")
    return F.coalesce(contains_any(login, *words), F.lit(False)) | F.coalesce(
        contains_any(name, *words), F.lit(False)
    )


def hhmm(col: Column) -> Column:
    """One to four digits as ``HH:MM``; any other text is kept as it is."""
    padded = F.lpad(col, 4, "0")
    clock = F.concat(F.substring(padded, 1, 2), F.lit(":"), F.substring(padded, 3, 2))
    return F.when(F.length(col).between(1, 4), clock).otherwise(col)


def hhmm_from_number(col: Column) -> Column:
    """Integer 930 as ``09:30``."""
    return F.format_string("%02d:%02d", F.floor(col / 100).cast("int"), (col % 100).cast("int"))


def strip_tags(col: Column, mark: str = ";") -> Column:
    """Markup replaced by single delimiters."""
    return F.regexp_replace(F.regexp_replace(col, "<[^>]+>", mark), f"{mark}+", mark)


def labelled_segment(col: Column, label_pattern: str, stops: Sequence[str]) -> Column:
    """Text after a label up to the next stop label, from tag-stripped text."""
    ends = "|".join(f";{s}" for s in stops)
    return extract_or_null(col, f"{label_pattern}:\\s*;?([^;]+?)(?:{ends}|$)")
