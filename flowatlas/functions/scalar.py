"""Scalar expressions used by several operators. All stay inside generated code."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F



def _decompositions() -> dict[str, str]:
    """ASCII letters of every letter of the Latin blocks of Unicode that has some, by compatibility decomposition."""
    blocks = [range(0xC0, 0x250), range(0x1E00, 0x1F00), range(0xFB00, 0xFB07)]
    found = {chr(code): unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode() for block in blocks for code in block}
    return {letter: plain for letter, plain in found.items() if plain}


_SINGLE = {letter: plain for letter, plain in _decompositions().items() if len(plain) == 1}
_SEVERAL = {letter: plain for letter, plain in _decompositions().items() if len(plain) > 1}


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage of a total, null when the total is 0."""
    return 100.0 * part / F.nullif(whole.cast("double"), F.lit(0.0))


def ratio_to_max(value: Column, maximum: Column) -> Column:
    """``value / max``, 0 when the maximum is 0."""
    return F.when(maximum > 0, value / maximum).otherwise(0.0)


def slug(name: Column) -> Column:
    """ASCII folder name: accents off (any letter that decomposes), other non-ASCII dropped, lower case, spaces to underscores."""
    plain = F.translate(name, "".join(_SINGLE), "".join(_SINGLE.values()))
    for letters, value in _SEVERAL.items():
        plain = F.replace(plain, F.lit(letters), F.lit(value))
    return F.lower(F.replace(F.regexp_replace(plain, "[^\\x00-\\x7F]", ""), F.lit(" "), F.lit("_")))


def compact_count(n: Column) -> Column:
    """1.2M above a million, 35K above a thousand, else the number; comma as decimal mark."""
    tenths = F.floor(n / F.lit(100000.0) + F.lit(0.5)).cast("long")
    millions = F.concat(F.floor(tenths / 10).cast("long").cast("string"), F.lit(","),
                        (tenths % 10).cast("string"), F.lit("M"))
    thousands = F.concat(F.floor(n / F.lit(1000.0) + F.lit(0.5)).cast("long").cast("string"), F.lit("K"))
    return F.when(n >= 1_000_000, millions).when(n >= 1_000, thousands).otherwise(n.cast("string"))


def uniform(key: Column) -> Column:
    """Repeatable draw in [0, 1) from a text key: the first 32 bits of its MD5."""
    return F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
