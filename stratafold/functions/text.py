"""Text expressions: accent folding, sentinels, canonical keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The one-to-one accent map.  Letters outside it stay as they are.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ"
PLAIN = "aaaaaeeeeiiiiooooouuuucAAAAAEEEEIIIIOOOOOUUUUC"

# Fixed value: stands for "no value" in partitioning columns.
UNKNOWN_SENTINEL = "__UNKNOWN__"

KEY_SEPARATOR = "|"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_accents(c: Column | str) -> Column:
    """Replace each mapped accented letter by its plain letter; a text of one byte a letter has none."""
    text = _col(c)
    return F.when(F.octet_length(text) == F.char_length(text), text).otherwise(F.translate(text, ACCENTED, PLAIN))


def null_to_sentinel(c: Column | str, sentinel: str = UNKNOWN_SENTINEL) -> Column:
    return F.coalesce(_col(c), F.lit(sentinel))


def trimmed(c: Column | str) -> Column:
    """Trimmed text, NULL as the empty string."""
    return F.trim(F.coalesce(_col(c), F.lit("")))


def canonical(c: Column | str) -> Column:
    """Text compared without regard to case, outer spaces or NULL."""
    return F.upper(trimmed(c))


def surrogate_key(*parts: Column | str) -> Column:
    """MD5 over the canonical parts; never NULL."""
    return F.md5(F.concat_ws(KEY_SEPARATOR, *[canonical(p) for p in parts]))


def business_key(c: Column | str) -> Column:
    """MD5 of a natural identifier; a NULL identifier gives a NULL key."""
    return F.md5(F.upper(F.trim(_col(c))))


def regex_group(c: Column | str, pattern: str, group: int = 1) -> Column:
    """A group of the first match, the empty string where nothing matches."""
    return F.regexp_extract(_col(c), pattern, group)
