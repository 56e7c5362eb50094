"""Text expressions: trimming, key parts, collation-free equality keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHITESPACE = " \t\n\r\x0b\x0c"

# Latin letters folded by an accent-insensitive collation.
ACCENTED = "ÁÀÂÃÄÅÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑÝ"
UNACCENTED = "AAAAAAEEEEIIIIOOOOOUUUUCNY"

MISSING_TEXT = "N/A"
UNIT_PREFIX = "SP - "


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing white space of every kind."""
    return F.btrim(c, F.lit(WHITESPACE))


def clean_text(c: Column) -> Column:
    """Trimmed key text; a missing one becomes ``N/A`` so that keys never hold nulls."""
    return F.coalesce(strip_ws(c.cast("string")), F.lit(MISSING_TEXT))


def norm_key(c: Column) -> Column:
    """Key under which texts differing by case, accents or trailing blanks are equal.

    A plain string column keeps joins hashable and broadcastable; comparing
    collated columns directly forces a sort-merge join.
    """
    return F.translate(F.upper(F.rtrim(c)), ACCENTED, UNACCENTED)


def standard_unit(c: Column) -> Column:
    """Unit name without the state prefix, trimmed, upper case; null counts as one unit."""
    text = F.coalesce(c.cast("string"), F.lit(MISSING_TEXT))
    return F.upper(strip_ws(F.replace(text, F.lit(UNIT_PREFIX), F.lit(""))))


def drop_last_segment(c: Column) -> Column:
    """Remove the last dot-separated segment; a code without a dot stays as it is."""
    return F.regexp_replace(c, r"\.[^.]*$", "")


def join_key(*parts: Column) -> Column:
    """Composite text key. Callers must have replaced nulls: ``concat_ws`` skips them."""
    return F.concat_ws("|", *[p.cast("string") for p in parts])


def key_part(key: Column, position: int) -> Column:
    """Part of a composite key by zero-based position, null when there are fewer parts."""
    return F.get(F.split(key, r"\|"), F.lit(position))


def slug(c: Column) -> Column:
    """File-safe name: blanks and slashes become underscores."""
    return F.translate(c, " /", "__")
