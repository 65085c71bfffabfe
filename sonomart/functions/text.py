"""Text keys for record linkage, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip and re's \s take as white space.
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"


def strip(c: Column) -> Column:
    """Trim every kind of Unicode white space, not only blanks."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def normalise(c: Column) -> Column:
    """Lower-cased title or artist without (...) and [...] remarks; null becomes the empty key."""
    bare = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    for remark in (r"(?d)\(.*?\)", r"(?d)\[.*?\]"):
        bare = F.regexp_replace(bare, remark, "")
    # White space at the ends cannot change what a remark is, so one pass at the end is enough.
    return F.trim(F.regexp_replace(bare, rf"{SPACE}+", " "))


def lead_artist(c: Column) -> Column:
    """First name of an artist list literal such as ``['A', 'B']``; null becomes empty."""
    names = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"""[\[\]'"]""", "")
    return strip(F.split(names, ",", 2)[0])


def strip_non_ascii(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]+", "")


def match_key(title: Column, artist: Column) -> Column:
    return F.concat_ws(" ", title, artist)


def token_sorted(c: Column) -> Column:
    """White-space tokens in code-point order, joined by single blanks."""
    tokens = F.filter(F.split(c, rf"{SPACE}+"), lambda t: t != "")
    return F.array_join(F.array_sort(tokens), " ")


def is_filled(c: Column) -> Column:
    """Neither null nor empty."""
    return F.length(F.coalesce(c, F.lit(""))) > 0
