"""Postcodes, departments, towns and the repair of shifted address cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.contact import clean_postal_code
from gristmill.functions.text import let, norm

#: Welded codes are told from free ones by this mark behind them while a cell is read; no cell holds it.
WELD = "\x1f"
CODE = rf"^\d{{5}}{WELD}?$"


def department(postcode: Column) -> Column:
    """Department of a postcode: overseas by three digits, Corsica 2A below 202, 2B from there, else two digits."""
    named = lambda x: F.when(x.rlike("^9[78]"), F.substring(x, 1, 3)).when(x.rlike("^20[01]"), F.lit("2A")).when(x.rlike("^20"), F.lit("2B")).otherwise(F.substring(x, 1, 2))
    return let(clean_postal_code(postcode), named)


def repair_town(postcode: Column, town: Column) -> Column:
    """STRUCT(postcode, town, changed) of a pair of cells whose parts slipped into each other.

    The town cell is read as a row of words: codes (free, welded to the next word, or in brackets), dashes, numbers and
    names. What stands behind a dash and a welded code is the town and its code, whatever the postcode cell holds.
    Else a phone number at the end goes, then a bracketed code, and of what is left an unusable postcode cell takes the
    first code with the words behind it, while a usable one only drops its own code in front and a second copy of the
    town behind a code. NULL counts as empty; a cell is never emptied.
    """
    cells = F.struct(F.trim(F.coalesce(postcode, F.lit(""))).alias("code"), F.trim(F.coalesce(town, F.lit(""))).alias("name"))
    return let(cells, lambda c: let(let(_cell_words(c["name"]), lambda w: _read_cell(c["code"], w)), lambda x: _told(c, x)))


def _cell_words(name: Column) -> Column:
    """Words of a town cell, welded codes marked and cut off, brackets free, without a phone number at the end."""
    marked = F.regexp_replace(F.regexp_replace(name, r"(?<!\d)(\d{5})(?=\p{L})", f"$1{WELD} "), r"\((\d{5})\)", " ($1)")

    def shortened(words: Column) -> Column:
        numeric = F.transform(F.reverse(words), lambda w: w.rlike(r"^[\d./-]+$"))
        behind = F.coalesce(F.nullif(F.array_position(numeric, F.lit(False)), F.lit(0)) - 1, F.lit(0)).cast("int")  # numbers at the end; a cell of numbers alone keeps them
        digits = F.regexp_replace(F.array_join(F.slice(words, F.size(words) - behind + 1, behind), ""), r"\D", "")
        kept = F.when(digits.rlike(r"^0\d{9,}$"), F.slice(words, F.lit(1), F.size(words) - behind)).otherwise(words)
        label = (F.size(kept) < F.size(words)) & (F.size(kept) > 1) & F.lower(F.element_at(kept, -1)).rlike("^(t|tel|tél)[.:]?$")
        return F.when(label, F.slice(kept, F.lit(1), F.size(kept) - 1)).otherwise(kept)

    return let(F.split(F.trim(marked), r"\s+"), shortened)


def _read_cell(code: Column, words: Column) -> Column:
    """STRUCT(postcode, words): what the two cells say together."""
    usable, first_true = code.rlike(r"^\d{5}$"), lambda flags: F.array_position(flags, F.lit(True)).cast("int")
    behind = lambda w, k: F.slice(w, k + 1, F.size(w))
    said = lambda c, w: F.struct(F.replace(c, F.lit(WELD), F.lit("")).alias("postcode"), w.alias("words"))
    shifted = first_true(F.transform(words, lambda w, i: w.endswith(WELD) & (i >= 2) & F.get(words, i - 1).isin("-", "–")))
    bracketed = F.element_at(words, -1).rlike(r"^\(\d{5}\)$") & (F.size(words) > 1)
    bare = F.when(bracketed, F.slice(words, F.lit(1), F.size(words) - 1)).otherwise(words)

    def unaided(w: Column, k: Column) -> Column:
        """The postcode cell is no help: the first code, and the words behind it if a name starts there."""
        names_follow = F.coalesce(F.get(w, k).rlike(r"^\p{L}"), F.lit(False))
        others = F.when(names_follow, behind(w, k)).otherwise(F.concat(F.slice(w, F.lit(1), F.greatest(k - 1, F.lit(0))), behind(w, k)))
        return F.when(k > 0, said(F.get(w, k - 1), others)).otherwise(said(F.when(bracketed, F.substring(F.element_at(words, -1), 2, 5)), w))

    def aided(w: Column, k: Column) -> Column:
        """The postcode cell stands: its own code in front and a twin of the town behind a code go."""
        before, after = F.slice(w, F.lit(1), F.greatest(k - 1, F.lit(0))), behind(w, k)
        twin = (k > 1) & (F.lower(F.array_join(before, " ")) == F.lower(F.array_join(after, " ")))
        own = (k == 1) & (F.replace(F.get(w, F.lit(0)), F.lit(WELD), F.lit("")) == code)
        return said(code, F.when(twin, before).when(own, after).otherwise(w))

    rest = let(bare, lambda w: let(first_true(F.transform(w, lambda x: x.rlike(CODE))), lambda k: F.when(usable, aided(w, k)).otherwise(unaided(w, k))))
    return F.when(shifted > 0, said(F.get(words, shifted - 1), behind(words, shifted))).otherwise(rest)


def _told(cells: Column, x: Column) -> Column:
    """STRUCT(postcode, town, changed) from the words that are left, outer marks off, welds that stay closed again."""
    town = F.regexp_replace(F.replace(F.array_join(x["words"], " "), F.lit(f"{WELD} "), F.lit("")), r"^[\s\-–,;.]+|[\s\-,;.]+$", "")
    filled = F.coalesce(F.nullif(town, F.lit("")), cells["name"])
    return let(filled, lambda t: F.struct(x["postcode"].alias("postcode"), t.alias("town"), ((F.coalesce(x["postcode"], F.lit("")) != cells["code"]) | (t != cells["name"])).alias("changed")))


def strip_postcode_town(c: Column) -> Column:
    """An address without the postcode and town at its end."""
    return F.regexp_replace(c, r"[\s,;-]+\d{5}(\s.*)?$", "")


def postcode_town(c: Column) -> Column:
    """STRUCT(postcode, town) at the end of an address."""
    return F.struct(F.nullif(F.regexp_extract(c, r"(\d{5})\s+([^\d].*)$", 1), F.lit("")).alias("postcode"), F.nullif(F.trim(F.regexp_extract(c, r"(\d{5})\s+([^\d].*)$", 2)), F.lit("")).alias("town"))


#: How the kinds of way are abbreviated (fixed values).
WAY_WORDS = {"AV": "AVENUE", "AVE": "AVENUE", "BD": "BOULEVARD", "BLD": "BOULEVARD", "BVD": "BOULEVARD", "CH": "CHEMIN", "CHE": "CHEMIN", "CHEM": "CHEMIN", "RTE": "ROUTE", "R": "RUE", "PL": "PLACE", "IMP": "IMPASSE", "ALL": "ALLEE", "ST": "SAINT", "STE": "SAINTE"}


def address_parts(c: Column) -> Column:
    """STRUCT(house, words): the first number, and the street's words with abbreviations written out, as a sorted set."""
    return let(norm(F.regexp_replace(c, r"[\s,;-]+\d{5}\b.*$", "")), _parts)


def _parts(bare: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in WAY_WORDS.items() for x in pair])
    words = F.transform(F.split(bare, " "), lambda w: F.coalesce(F.element_at(table, w), w))
    kept = F.filter(words, lambda w: ~w.rlike(r"^(\d+(BIS|TER|B|T)?|BIS|TER|N|NO|[A-Z])?$") & ~w.isin("DE", "DU", "DES", "LA", "LE", "LES"))
    return F.struct(F.nullif(F.regexp_extract(bare, r"\b(\d{1,4})(?:BIS|TER|B|T)?\b", 1), F.lit("")).alias("house"), F.array_sort(F.array_distinct(kept)).alias("words"))


#: Regions and their departments (fixed values).
REGIONS = {
    "Auvergne-Rhone-Alpes": "01 03 07 15 26 38 42 43 63 69 73 74",
    "Bourgogne-Franche-Comte": "21 25 39 58 70 71 89 90",
    "Bretagne": "22 29 35 56",
    "Centre-Val-de-Loire": "18 28 36 37 41 45",
    "Corse": "2A 2B",
    "Grand-Est": "08 10 51 52 54 55 57 67 68 88",
    "Hauts-de-France": "02 59 60 62 80",
    "Ile-de-France": "75 77 78 91 92 93 94 95",
    "Normandie": "14 27 50 61 76",
    "Nouvelle-Aquitaine": "16 17 19 23 24 33 40 47 64 79 86 87",
    "Occitanie": "09 11 12 30 31 32 34 46 48 65 66 81 82",
    "Pays-de-la-Loire": "44 49 53 72 85",
    "Provence-Alpes-Cote-d-Azur": "04 05 06 13 83 84",
}
ELSEWHERE = "Hors-region"


def region(code: Column) -> Column:
    """Region of a department code; ``ELSEWHERE`` for any other, overseas ones too, NULL for NULL."""
    table = F.create_map(*[F.lit(x) for name, codes in REGIONS.items() for c in codes.split() for x in (c, name)])
    return F.when(code.isNotNull(), F.coalesce(F.element_at(table, code), F.lit(ELSEWHERE)))


def departments_of(spec: str | None) -> list[str]:
    """Department codes that a request names: ``all``, a region (with or without ``region:``), or codes between commas.

    A code that no region has is refused, as it would look like a department without rows; blanks and case don't count,
    one digit is padded, repeats go.
    """
    asked = (spec or "").strip()
    by_name = {name.lower(): codes.split() for name, codes in REGIONS.items()}
    every = sorted(c for codes in by_name.values() for c in codes)
    if asked.lower() == "all":
        return every
    named = by_name.get(asked.lower().removeprefix("region:").strip().replace(" ", "-"))
    if named:
        return sorted(named)
    codes = list(dict.fromkeys(c.strip().upper().zfill(2) for c in asked.split(",") if c.strip()))
    unknown = [c for c in codes if c not in every]
    if unknown:
        raise ValueError(f"unknown departments: {', '.join(unknown)}")
    return codes
