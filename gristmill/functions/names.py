"""Names of businesses and people: keys, overlaps, similarity."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from gristmill.functions.text import norm, unaccent

#: Legal forms (fixed values).
LEGAL_FORMS = "EARL GAEC SARL EURL SASU SAS SCEA SCI SCA SNC GFA CUMA SC SA EA EI COOP SCV SEP".split()
#: What is set aside before a person's name is read: legal forms, civility, nouns of the trade, articles (fixed values).
ASIDE = LEGAL_FORMS + """M MR MME MLLE MONSIEUR MADAME ELEVAGE ELEVEUR ELEVEUSE FERME DOMAINE EXPLOITATION AGRICOLE AGRICULTEUR
PRODUCTEUR PRODUCTEURS VERGER RUCHER HARAS ECURIE ECURIES CHATEAU MAS CLOS BERGERIE LA LE LES DE DU DES ET AU AUX D L EN""".split()
SAINTS = ["SAINT", "SAINTE", "SAINTS", "SAINTES", "ST", "STE"]


def tokens(c: Column) -> Column:
    """Words of the normal form, in order."""
    return F.filter(F.split(norm(c), " "), lambda t: t != "")


def stripped_key(c: Column) -> Column:
    """Normal form without legal forms."""
    return F.array_join(F.filter(tokens(c), lambda t: ~t.isin(*LEGAL_FORMS)), " ")


def sorted_key(c: Column) -> Column:
    """Words without legal forms, sorted, repeated ones kept: the same for any order of words."""
    return F.array_join(F.array_sort(F.filter(tokens(c), lambda t: ~t.isin(*LEGAL_FORMS))), " ")


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct words; 0 where both are empty."""
    x, y = tokens(a), tokens(b)
    return F.coalesce(F.try_divide(F.size(F.array_intersect(x, y)), F.size(F.array_union(x, y))), F.lit(0.0))


def trigrams(c: Column) -> Column:
    """Distinct trigrams of each lower-case word, two blanks before and one behind."""
    words = F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    padded = F.transform(words, lambda w: F.concat(F.lit("  "), w, F.lit(" ")))
    return F.array_distinct(F.flatten(F.transform(padded, lambda w: F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3))))))


def trigram_similarity(a: Column, b: Column) -> Column:
    """Shared over all distinct trigrams."""
    return array_jaccard(trigrams(a), trigrams(b))


def array_jaccard(x: Column, y: Column) -> Column:
    """Jaccard similarity of two arrays of distinct values, from their sizes and overlap."""
    both = F.size(F.array_intersect(x, y))
    return F.coalesce(F.try_divide(both, F.size(x) + F.size(y) - both), F.lit(0.0))


def shares_evidence(a: Column, b: Column) -> Column:
    """Whether a word of four letters or more of either name stands inside the other."""
    x, y = norm(a), norm(b)
    inside = lambda words, hay: F.exists(F.split(words, " "), lambda t: (F.length(t) >= 4) & hay.contains(t))
    return F.coalesce(inside(x, y) | inside(y, x), F.lit(False))


@pandas_udf(T.DoubleType())
def sequence_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two texts; no built-in has it."""
    return pd.Series([difflib.SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])


def person_tokens(c: Column) -> Column:
    """(place, word) of a name's words that aren't set aside; empty where a saint is named."""
    words = F.filter(F.split(F.regexp_replace(F.upper(unaccent(c)), "[^A-Z]+", " "), " "), lambda t: t != "")
    placed = F.transform(words, lambda t, i: F.struct(i.alias("place"), t.alias("word")))
    kept = F.filter(placed, lambda p: ~p["word"].isin(*ASIDE))
    return F.when(F.exists(words, lambda t: t.isin(*SAINTS)), F.slice(kept, 1, 0)).otherwise(kept)


def parse_person(c: Column, first_names: Column) -> Column:
    """STRUCT(first_name, last_name) where two adjacent words remain and exactly one is a first name; else NULL."""
    kept = person_tokens(c)
    a, b = F.get(kept, F.lit(0)), F.get(kept, F.lit(1))
    sound = (F.size(kept) == 2) & (F.length(a["word"]) >= 3) & (F.length(b["word"]) >= 3) & (b["place"] - a["place"] == 1) & (a["word"] != b["word"])
    first, second = F.array_contains(first_names, a["word"]), F.array_contains(first_names, b["word"])
    pair = lambda x, y: F.struct(x["word"].alias("first_name"), y["word"].alias("last_name"))
    return F.when(sound & first & ~second, pair(a, b)).when(sound & second & ~first, pair(b, a))


def clean_surname(c: Column) -> Column:
    """A surname without what follows in brackets."""
    return F.trim(F.split(c, r"\(")[0])
