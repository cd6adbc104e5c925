"""Scalar text functions (F01 to F12, F20): built-in expressions, with one Arrow UDF for what they can't express.

Texts made of ASCII, Latin-1 letters and basic Cyrillic are their own NFKC form
and casefold by a lower-case rule, so only other texts travel to Python.
"""

from __future__ import annotations

import html
import html.entities
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Said as what it holds: the negated class takes Java fifteen times as long.
_OTHER = r"[\x80-\xBF\x{100}-\x{3FF}\x{460}-\x{10FFFF}]"
_ENTITY = re.compile(r"&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[0-9A-Za-z]+);")
TAG = r"<[^>]{0,10000}>"
URL = r"(?i)(?:https?://|www\.)[^\s<]+"
WORD = "[а-яёa-z]+"
TOKEN = r"[\p{L}\p{N}]+"
EMAIL = r"\b[^\s@]+@[^\s@]+\.[^\s@]+\b"
PHONE = r"(?<!\d)(?:\+?\d[\s().-]?){7,}\d(?!\d)"


@F.pandas_udf(StringType())
def _unescaped_nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", html.unescape(t)))


def closed_entities(text: str) -> str:
    """As ``html.unescape``, but only what a semicolon closes is an entity."""
    return _ENTITY.sub(lambda m: html.unescape(m[0]) if m[0][1] == "#" or m[0][1:] in html.entities.html5 else m[0], text)


@F.pandas_udf(StringType())
def _closed_nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", closed_entities(t)))


@F.pandas_udf(StringType())
def _nfkc_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(StringType())
def _casefold_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else t.casefold())


@F.pandas_udf(StringType())
def _leakage_udf(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t).casefold())


def _guarded(text: Column, needs: Column, udf, otherwise: Column) -> Column:
    """``udf`` where ``needs`` holds; other rows reach Python as nulls only, come back as nulls and are filled in."""
    return F.coalesce(udf(F.when(needs, text)), otherwise)


def _folded(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("ß"), F.lit("ss"))


def nfkc(text: Column) -> Column:
    """F01."""
    return _guarded(text, text.rlike(_OTHER), _nfkc_udf, text)


def unescaped_nfkc(text: Column, closed: bool = False) -> Column:
    """F04 then F01; with ``closed``, an entity without its semicolon is text."""
    return _guarded(text, text.rlike(f"{_OTHER}|&"), _closed_nfkc if closed else _unescaped_nfkc, text)


def casefold(text: Column) -> Column:
    """F02."""
    return _guarded(text, text.rlike(_OTHER), _casefold_udf, _folded(text))


def collapse(text: Column) -> Column:
    """any white space, as Python splits on it, to single spaces; none at the ends."""
    return F.trim(F.regexp_replace(text, r"[\s\x0B\x1C-\x1F\x85\p{Z}]+", " "))


def strip(text: Column) -> Column:
    """White space off both ends."""
    return F.regexp_replace(text, r"^[\s\x0B\x1C-\x1F\x85\p{Z}]+|[\s\x0B\x1C-\x1F\x85\p{Z}]+$", "")


def strip_tags(text: Column) -> Column:
    """F05."""
    return F.regexp_replace(text, TAG, " ")


def urls(text: Column, handling: str = "token") -> Column:
    """URLs replaced by a token, removed or kept."""
    if handling == "keep":
        return text
    return F.regexp_replace(text, URL, " <URL> " if handling == "token" else " ")


def strip_controls(text: Column) -> Column:
    """characters of the categories C* to spaces."""
    return F.regexp_replace(text, r"\p{C}", " ")


def alnum_key(text: Column) -> Column:
    """F08 of a casefolded text."""
    return F.trim(F.regexp_replace(text, r"[^\p{L}\p{N}]+", " "))


def words(text: Column) -> Column:
    """runs of a to z and basic Cyrillic in the lower-cased text."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def tokens(text: Column) -> Column:
    """runs of letters and digits."""
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def leakage_key(text: Column) -> Column:
    """NFKC, casefold, collapse; one trip to Python for both."""
    return collapse(_guarded(text, text.rlike(_OTHER), _leakage_udf, _folded(text)))


def has_email(text: Column) -> Column:
    """F20."""
    return text.rlike(EMAIL)


def has_phone(text: Column) -> Column:
    """F20."""
    return text.rlike(PHONE)


def without_bom(text: Column) -> Column:
    """F30."""
    return F.regexp_replace(text, "^﻿", "")
