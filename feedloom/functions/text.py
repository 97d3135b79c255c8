"""Text cleaning and title keys as column expressions."""

from __future__ import annotations

import json
from functools import lru_cache
from html import unescape
from html.entities import html5

from pyspark.sql import Column, functions as F

# Java's \s knows ASCII only; this class also takes the separators feeds carry (NBSP, U+3000, ...).
SPACES = r"[\s\x1c-\x1f\x85\p{Z}]+"

_REFERENCE = r"&(?:#(?:[0-9]+|[xX][0-9a-fA-F]+);?|[^\t\n\f <&#;]{1,32};?)"
# Names that also count without a semicolon, longest first: such a name may be the beginning of a word.
_BARE_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
_HIGHEST = 0x10FFFF


@lru_cache(maxsize=1)
def _odd_numbers() -> str:
    """Numbers up to the first page of letters that stand for something else than their code point."""
    return json.dumps({str(n): unescape(f"&#{n};") for n in range(160) if unescape(f"&#{n};") != chr(n)})


def _table(text: str) -> Column:
    """A constant map; the planner folds it into one value."""
    return F.from_json(F.lit(text), "map<string,string>")


def _numbered(code: Column) -> Column:
    """The text of a code point, as HTML reads it; beyond the last one, and for halves of pairs, a replacement sign."""
    low = code.bitwiseAND(F.lit(0xFFFF).cast("bigint"))
    nothing = code.between(0xFDD0, 0xFDEF) | (low >= 0xFFFE)
    own = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(code.between(0xD800, 0xDFFF) | (code > _HIGHEST), "�")
        .when(code < 160, F.coalesce(F.try_element_at(_table(_odd_numbers()), code.cast("string")), own))
        .when(nothing, "")
        .otherwise(own)
    )


def _decoded(reference: Column) -> Column:
    """The text of one reference; what is none stays as it is."""
    decimal = F.ltrim(F.regexp_extract(reference, "^&#([0-9]+)", 1), F.lit("0"))
    digits = F.ltrim(F.regexp_extract(reference, "^&#[xX]([0-9a-fA-F]+)", 1), F.lit("0"))
    is_hex = reference.rlike("^&#[xX]")
    number = F.when(is_hex, F.conv(F.right(F.concat(F.lit("0"), digits), F.lit(9)), 16, 10)).otherwise(F.right(F.concat(F.lit("0"), decimal), F.lit(9)))
    code = F.when((F.length(digits) > 8) | (F.length(decimal) > 8), F.lit(_HIGHEST + 1).cast("bigint")).otherwise(number.cast("bigint"))
    name = F.substr(reference, F.lit(2))
    known = F.try_element_at(_table(json.dumps(html5)), name)
    bare = F.regexp_extract(name, f"^({'|'.join(_BARE_NAMES)})", 1)
    begins = F.concat(F.try_element_at(_table(json.dumps(html5)), bare), F.substr(name, F.length(bare) + 1))
    return F.when(reference.startswith("&#"), _numbered(code)).otherwise(F.coalesce(known, F.when(bare != "", begins), reference))


def unescape_entities(text: Column) -> Column:
    """Decode HTML character references; texts without an ampersand are left alone."""
    gaps, found = F.split(text, _REFERENCE), F.regexp_extract_all(text, F.lit(_REFERENCE), F.lit(0))
    parts = F.zip_with(gaps, F.transform(found, _decoded), lambda gap, sign: F.concat(gap, F.coalesce(sign, F.lit(""))))
    return F.when(text.contains("&"), F.array_join(parts, "")).otherwise(text)


def collapse_spaces(text: Column) -> Column:
    """One blank for each run of white space, none at the ends."""
    return F.trim(F.regexp_replace(text, SPACES, " "))


def strip_markup(text: Column) -> Column:
    """Drop tags from already decoded text; null gives an empty text."""
    return collapse_spaces(F.regexp_replace(F.coalesce(text, F.lit("")), "<[^>]+>", " "))


def clean_text(text: Column) -> Column:
    """Decode entities, then drop tags, then collapse white space."""
    return strip_markup(unescape_entities(F.coalesce(text, F.lit(""))))


# Everything but a-z, 0-9 and U+4E00 to U+9FFF. Java matches these ranges in a quarter of the time that [^a-z0-9一-鿿] takes.
_NO_KEY = r"[\x00-/:-`{-\x{4dff}\x{a000}-\x{10ffff}]+"


def title_key(title: Column) -> Column:
    """Key under which two titles are the same: lower-case latin letters, digits and Han only."""
    return F.trim(F.regexp_replace(F.lower(title), _NO_KEY, " "))
