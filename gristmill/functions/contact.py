"""Identifiers, phones, e-mail addresses and hosts as pure Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gristmill.functions.text import let

#: Texts that mean "no value" in spreadsheets (fixed values).
SENTINELS = ("", "nan", "none", "null")
#: Premium-rate prefixes (fixed values).
PREMIUM = r"^08[129]"


def trimmed(c: Column) -> Column:
    """Outer white space off, no-break spaces included."""
    return F.regexp_replace(c, r"^[\s\xa0]+|[\s\xa0]+$", "")


def clean_text(c: Column) -> Column:
    """No-break spaces as blanks, trimmed, sentinels as NULL."""
    return let(F.trim(F.regexp_replace(c, r"\xa0", " ")), lambda x: F.when(~F.lower(x).isin(*SENTINELS), x))


def strip_float(c: Column) -> Column:
    """Clean text without the ``.0`` that spreadsheets add to numbers."""
    return F.regexp_replace(clean_text(c), r"\.0+$", "")


def _bare(c: Column) -> Column:
    return F.regexp_replace(strip_float(c), r"[\s.\-]", "")


def clean_siret(c: Column) -> Column:
    """Exactly 14 digits once blanks, dots and hyphens are gone, not all zero; never padded."""
    return let(_bare(c), lambda x: F.when(x.rlike("^[0-9]{14}$") & (x != "0" * 14), x))


def clean_siren(c: Column) -> Column:
    """Exactly 9 digits, else NULL."""
    return let(_bare(c), lambda x: F.when(x.rlike("^[0-9]{9}$") & (x != "0" * 9), x))


def siret_to_siren(c: Column) -> Column:
    """First nine of fourteen characters."""
    return F.when(F.length(c) == 14, F.substring(c, 1, 9))


def truncated_identifier(c: Column) -> Column:
    """8, 12 or 13 digits kept as they are for later recovery."""
    return let(_bare(c), lambda x: F.when(x.rlike("^([0-9]{8}|[0-9]{12}|[0-9]{13})$"), x))


def clean_naf(c: Column) -> Column:
    """Activity code as ``NN.NNX``: two digits, a dot, one or two digits, a letter."""
    code = F.upper(F.regexp_replace(strip_float(c), r"[\s\-]", ""))
    return F.when(code.rlike(r"^[0-9]{2}\.?[0-9]{1,2}[A-Z]$"), F.regexp_replace(code, r"^([0-9]{2})\.?", "$1."))


def luhn_ok(c: Column) -> Column:
    """Whether the digits pass the Luhn check; NULL for what isn't all digits."""
    return F.when(c.rlike("^[0-9]+$"), F.call_function("luhn_check", c))


def normalize_status(c: Column) -> Column:
    """TRUE for active, FALSE for closed or struck off, NULL for anything else."""
    low = F.lower(F.trim(c))
    closed = low.contains("ferm") | low.contains("cess") | low.contains("radié") | low.contains("radie")
    return F.when(low.contains("actif"), F.lit(True)).when(closed, F.lit(False))


def clean_postal_code(c: Column) -> Column:
    """Five digits: blanks and dots off, cut at five, four padded; else NULL."""
    code = F.substring(F.regexp_replace(strip_float(c), r"[\s.]", ""), 1, 5)
    return let(code, lambda x: F.when(x.rlike("^[0-9]{4}$"), F.lpad(x, 5, "0")).when(x.rlike("^[0-9]{5}$"), x))


def clean_department(c: Column) -> Column:
    """Department code: two digits, 2A or 2B, or three digits overseas."""
    code = F.upper(strip_float(c))
    code = F.when(code.rlike("^[0-9]$"), F.lpad(code, 2, "0")).otherwise(code)
    return F.when(code.rlike("^([0-9]{2}|2[AB]|9[78][0-9])$"), code)


def national_digits(c: Column) -> Column:
    """Ten national digits, 0 and then 1-9, of a phone number in any notation; else NULL."""
    digits = F.regexp_replace(F.regexp_replace(c, r"\(0\)", ""), "[^0-9]", "")
    return let(F.regexp_replace(digits, "^(0033|33)(?=[0-9]{9}$)", "0"), lambda x: F.when(x.rlike("^0[1-9][0-9]{8}$"), x))


def spaced_phone(digits: Column) -> Column:
    """Ten digits in pairs."""
    return F.regexp_replace(digits, r"(\d{2})(?=\d)", "$1 ")


def normalize_phone(c: Column) -> Column:
    """``0X XX XX XX XX``, or NULL."""
    return spaced_phone(national_digits(c))


def clean_phone(c: Column) -> Column:
    """As ``normalize_phone``, float artefacts off; nine bare digits get their leading 0."""
    text = strip_float(c)
    digits = F.regexp_replace(text, "[^0-9]", "")
    return normalize_phone(F.when(text.rlike(r"^[1-9][0-9]{8}$"), F.concat(F.lit("0"), digits)).otherwise(text))


#: A phone number in running text: national or international notation, pairs with at most one mark between, no digit
#: or slash in front and no digit behind, so none is read out of a longer number (fixed value).
PHONE_IN_TEXT = r"(?<![\d/])(?:\+33|0033|0)[\s.\-]?[1-9](?:[\s.\-]?\d{2}){4}(?!\d)"


def phones_in_text(c: Column) -> Column:
    """Distinct phone numbers of a text as ten national digits, sorted; identifiers and dates give none."""
    return F.array_sort(F.array_distinct(F.array_compact(F.transform(F.regexp_extract_all(c, F.lit(PHONE_IN_TEXT), F.lit(0)), national_digits))))


def is_premium(c: Column) -> Column:
    """Whether a phone number is premium-rate."""
    return F.coalesce(national_digits(c).rlike(PREMIUM), F.lit(False))


def plausible_number(c: Column) -> Column:
    """Whether ten digits may be a real number: their prefix is none that isn't allotted."""
    return F.coalesce(~national_digits(c).rlike("^(011|012|030|059)"), F.lit(False))


def host_of(c: Column) -> Column:
    """Host of a URL or bare domain, lower case, without ``www.``; NULL for empty text."""
    url = F.lower(trimmed(c))
    host = F.regexp_replace(F.regexp_replace(url, r"^[a-z][a-z0-9+.\-]*://", ""), r"[/?#].*$", "")
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", ""), r"^www\.", "")
    return F.nullif(host, F.lit(""))


def root_domain(c: Column) -> Column:
    """Last two labels of the host."""
    labels = F.split(host_of(c), r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")


def usable_website(c: Column) -> Column:
    """Whether the host, without ``www.``, is one with a dot and no blank."""
    return F.coalesce(host_of(c).rlike(r"^[^\s.]+(\.[^\s.]+)+\.?$"), F.lit(False))


def usable_email(c: Column) -> Column:
    """Whether the trimmed text has one @, a name, a dotted domain and no blank."""
    return F.coalesce(trimmed(c).rlike(r"^[^@\s\xa0]+@[^@\s\xa0.]+(\.[^@\s\xa0.]+)+$"), F.lit(False))


def source_label(c: Column) -> Column:
    """A source without case, outer blanks and anything from its first bracket on."""
    return F.lower(trimmed(F.regexp_replace(c, r"(?s)\(.*$", "")))
