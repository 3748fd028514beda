"""Text folding, tokens and similarities as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented letters and what they fold to, one for one (fixed values).
ACCENTED = "ÀÂÄÁÃÅÇÉÈÊËÎÏÍÌÑÔÖÓÒÕÛÜÚÙŸÝàâäáãåçéèêëîïíìñôöóòõûüúùÿý"
PLAIN = "AAAAAACEEEEIIIINOOOOOUUUUYYaaaaaaceeeeiiiinooooouuuuyy"


def let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unaccent(c: Column) -> Column:
    """Letters without accents, composed or decomposed; ligatures as two letters."""
    plain = F.translate(F.regexp_replace(c, r"\p{M}+", ""), ACCENTED, PLAIN)
    for ligature, letters in (("œ", "oe"), ("Œ", "OE"), ("æ", "ae"), ("Æ", "AE")):
        plain = F.replace(plain, F.lit(ligature), F.lit(letters))
    return plain


#: Lower-case accented letters, what they fold to, and the combining marks, which are dropped.
_LOW, _LOW_PLAIN = zip(*[(a, p) for a, p in zip(ACCENTED, PLAIN) if a.islower()])
_MARKS = "".join(map(chr, range(0x300, 0x370)))


def words(c: Column, least: int = 2) -> Column:
    """Words of a text in order: letters only, lower case, without accents; markup, addresses and tags left out.

    One pass takes markup out, one folds all letters: a tag ends at the next bracket of either kind, so an open one
    swallows nothing.
    """
    bare = F.lower(F.regexp_replace(c, r"<[^<>]*>|&\w{1,10};|https?://\S+|#\w+|\S+@\S+", " "))
    folded = F.translate(bare, "".join(_LOW) + _MARKS, "".join(_LOW_PLAIN))
    for ligature, letters in (("œ", "oe"), ("æ", "ae")):
        folded = F.replace(folded, F.lit(ligature), F.lit(letters))
    return F.regexp_extract_all(folded, F.lit(f"[a-z]{{{least},}}"), F.lit(0))


def norm(c: Column) -> Column:
    """Upper case without accents, runs of anything but letters and digits as one blank, trimmed."""
    return F.trim(F.regexp_replace(F.upper(unaccent(c)), "[^A-Z0-9]+", " "))
