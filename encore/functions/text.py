"""Text cleaning: trimming, word-wise capitals, join keys, slices of text."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from .column import as_column

# The punctuation after which the warehouse's INITCAP starts a new word.
WORD_BREAKS = '!?@"^#$&~_,.:;+-*%/|\\[](){}<>'

# What a Unicode-aware strip() removes at both ends of a text.
WHITESPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A Unicode noncharacter: reserved for use inside a program, never part of text.
_MARK = "\ufdd0"


def mark_words(c, breaks: str) -> Column:
    """Put a marked space after every break (spaces apart) that a cased character may follow.

    Before a digit, a space, the end or another break without case nothing can be
    capitalised, so most codes and numbers in names are not rewritten.
    """
    starts = "".join(re.escape(b) for b in breaks) + "\\t\\n\\x0B\\f\\r"
    caseless = "".join(re.escape(b) for b in breaks if b.lower() == b.upper()) + "\\t\\n\\x0B\\f\\r0-9 "
    return F.regexp_replace(as_column(c), f"[{starts}](?=[^{caseless}])", "$0" + _MARK + " ")


def title_case(c, breaks: str = WORD_BREAKS) -> Column:
    """Capitalise every word and lower-case the rest.

    Spark's ``initcap`` starts words after a space only. A marked space is put
    after every other break, ``initcap`` runs, and the marks are taken out again,
    which keeps the expression inside generated code (a higher-order function
    would not). With ``breaks=" "`` this is ``initcap`` itself.
    """
    c = as_column(c)
    others = breaks.replace(" ", "")
    if not others:
        return F.initcap(c)
    return F.replace(F.initcap(mark_words(c, others)), F.lit(_MARK + " "), F.lit(""))


def clean_name(c, breaks: str = WORD_BREAKS) -> Column:
    """Names of artists, venues and cities: capitals per word, then spaces trimmed."""
    return F.trim(title_case(c, breaks))


def clean_code(c) -> Column:
    """Codes such as state, currency and sale status: upper case, spaces trimmed."""
    return F.trim(F.upper(as_column(c)))


def strip(c) -> Column:
    """Trim all white space (``F.trim`` with one argument trims spaces only)."""
    return F.trim(as_column(c), F.lit(WHITESPACE))


def name_key(c) -> Column:
    """Join key of a name: white space stripped, lower case."""
    return F.lower(strip(c))


def same_name(a, b) -> Column:
    """Case-insensitive equality."""
    return F.lower(as_column(a)) == F.lower(as_column(b))


def contains_ignoring_case(text, part) -> Column:
    return F.lower(as_column(text)).contains(F.lower(as_column(part)))


def empty_to_null(c) -> Column:
    return F.nullif(as_column(c), F.lit(""))


def date_part(c) -> Column:
    """``2024-05-01T20:00:00`` -> ``2024-05-01``; empty -> NULL."""
    return empty_to_null(F.substring(as_column(c), 1, 10))


def time_part(c) -> Column:
    """``2024-05-01T20:00:00`` -> ``20:00:00``; empty -> NULL."""
    c = as_column(c)
    return empty_to_null(F.substr(c, F.lit(12)))


def last_segment(url) -> Column:
    """What follows the last ``/`` of a URL."""
    return F.substring_index(as_column(url), "/", -1)


# Control characters: between packed texts, and before the letter that stands for one inside a text or for no text.
_BETWEEN, _ESCAPE = "\x1f", "\x1b"


def pack_texts(names: Sequence[str]) -> Column:
    """Several texts as one, which takes a fifth less of a shuffle of wide rows, and of a sort; ``unpack_texts`` gives back each as it was."""
    def told(name: str) -> Column:
        plain = F.replace(F.col(name), F.lit(_ESCAPE), F.lit(_ESCAPE + "e"))
        return F.coalesce(F.replace(plain, F.lit(_BETWEEN), F.lit(_ESCAPE + "s")), F.lit(_ESCAPE + "n"))

    return F.concat_ws(_BETWEEN, *[told(n) for n in names])


def unpack_texts(parts: Column, names: Sequence[str]) -> list[Column]:
    """The texts of ``names`` from the parts of a packed one, ``packed_parts``."""
    def meant(part: Column) -> Column:
        whole = F.replace(F.replace(part, F.lit(_ESCAPE + "s"), F.lit(_BETWEEN)), F.lit(_ESCAPE + "e"), F.lit(_ESCAPE))
        return F.when(part != _ESCAPE + "n", whole)

    return [meant(parts[i]).alias(n) for i, n in enumerate(names)]


def packed_parts(packed) -> Column:
    return F.split(as_column(packed), _BETWEEN, -1)


def venue_label(venue, state) -> Column:
    """``Hall A (NY)``; NULL when either part is NULL."""
    return F.concat(as_column(venue), F.lit(" ("), as_column(state), F.lit(")"))
