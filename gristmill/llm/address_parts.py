"""Postal addresses taken apart: number, suffix, kind of way, name, place name, postcode and commune."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

#: Kinds of way and how they are written (fixed values).
WAY_KINDS = {
    "ALLEE": "ALLEE ALLEES ALL AL ALLE",
    "AVENUE": "AVENUE AVENUES AV AVE AVN AVEN",
    "BOULEVARD": "BOULEVARD BOULEVARDS BD BLD BVD BOUL BLVD",
    "CHEMIN": "CHEMIN CHEMINS CHE CHEM CH CHM CHMN",
    "COURS": "COURS CRS",
    "IMPASSE": "IMPASSE IMP IMPASSES",
    "PLACE": "PLACE PL PLACES PLC",
    "QUAI": "QUAI QU QUAIS",
    "ROUTE": "ROUTE RTE RT ROUTES RTES",
    "RUE": "RUE R RUES",
    "RUELLE": "RUELLE RLE",
    "SENTIER": "SENTIER SENTE SEN",
    "SQUARE": "SQUARE SQ",
    "TRAVERSE": "TRAVERSE TRA",
    "VOIE": "VOIE VOI",
}
#: Words of a name that come and go (fixed values).
ARTICLES = frozenset("DE DU DES LA LE LES AU AUX ET EN".split())
#: Words of a commune's name and what they stand for (fixed values).
COMMUNE_WORDS = {"ST": "SAINT", "STE": "SAINTE", "S": "SUR", "SS": "SOUS"}
#: Repetition of a number and how it is written (fixed values).
SUFFIXES = {"BIS": "B", "B": "B", "TER": "T", "T": "T", "QUATER": "Q", "Q": "Q"}

#: Letters that sound alike (fixed values).
_ALIKE = str.maketrans("CQZYW", "KKSIV")

KIND_OF = {word: kind for kind, words in WAY_KINDS.items() for word in words.split()}
_TAIL = re.compile(r"[\s,;-]+(\d{2} ?\d{3}|\d{4})(?:\s+([A-Z][A-Z '/.-]*))?$")
_PLACE = re.compile(r"^(?:LIEU[\s-]*DIT|L\.\s?D\.|LD)(?![A-Z])[\s:]*")
_AHEAD = re.compile(r"^(?:N(?:O|UMERO)?[°.\s]*)?(\d{1,4})\s*(?:(BIS|TER|QUATER)\b|([BTQ])(?=[\s,.]))?[\s,.]*(?=\D)")
_BEHIND = re.compile(r"[\s,]+(?:N(?:O|UMERO)?[°.\s]*)?(\d{1,4})\s*(BIS|TER|QUATER|[BTQ])?$")
#: The first word and what follows; a way where the word is a kind of way.
_FIRST = re.compile(r"^([A-Z]+)(?=[\s.])[\s.]*(.*)$")
#: Elided articles: before an apostrophe, or a lone L after DE; any other lone letter is an initial.
_ELIDED = re.compile(r"\b[DL]'|(?<=\bDE )L (?=[A-Z]{2})")
_ALONE = re.compile(r"^(?:N(?:O|UMERO)?[°.\s]*)?\d{1,4}\s*(?:BIS|TER|QUATER|[BTQ])?$")
_SPLIT = re.compile(r"\s*,\s*|\s+-\s+")
_NUMBERED = re.compile(r"^(N[°O. ]*)?\d")
_OTHER, _ZEROS, _UNDER = re.compile(r"[^A-Z0-9]+"), re.compile(r"\.0+$"), re.compile(r"\bS/")
_QUOTES, _WORD, _BEYOND_ASCII = re.compile(r"[\"«»()]"), re.compile(r"[A-Z0-9]+"), re.compile(r"[^\x00-\x7f]+")
#: What a number that stands behind ends in, if not in a digit.
_ENDS = frozenset("BTQSR\n")


class Address(NamedTuple):
    """Parts of an address; '' where one is missing. ``kind`` is PLACE_NAME for a lieu-dit."""

    number: str
    suffix: str
    kind: str
    name: str
    postcode: str
    commune: str


#: Upper-case letters with an accent and what they are without (fixed values).
_ACCENTED = "ÀÂÄÁÃÅÇÉÈÊËÎÏÍÌÑÔÖÓÒÕÛÜÚÙŸÝ"
_FLAT = str.maketrans(dict(zip(_ACCENTED, "AAAAAACEEEEIIIINOOOOOUUUUYY")) | {"Œ": "OE", "Æ": "AE", "\u00a0": " ", "’": "'"} | {chr(k): None for k in range(0x300, 0x370)})


def upper(text: str | None) -> str:
    """Upper case without accents, composed or not; ligatures as two letters."""
    if not text:
        return ""
    return text.upper() if text.isascii() else text.upper().translate(_FLAT)


def upper_lines(texts: list[str | None]) -> str:
    """``upper`` of many texts at once, a line for each; what a text has of line breaks itself stays."""
    return _BEYOND_ASCII.sub(lambda m: m[0].translate(_FLAT), "\n".join([t or "" for t in texts]).upper())


@lru_cache(maxsize=100_000)
def postcode_of(text: str | None) -> str:
    """Five digits; four are padded, a trailing ``.0`` and blanks go; anything else is ''."""
    digits = _ZEROS.sub("", (text or "").strip()).replace(" ", "").replace("\u00a0", "")
    return digits.zfill(5) if digits.isascii() and digits.isdigit() and len(digits) in (4, 5) else ""


@lru_cache(maxsize=100_000)
def commune_of(text: str | None) -> str:
    """Name of a commune without CEDEX, its short words written out, blanks between words."""
    words = _OTHER.sub(" ", _UNDER.sub("SUR ", upper(text))).split()
    if "CEDEX" in words:
        words = words[: words.index("CEDEX")]
    return " ".join(COMMUNE_WORDS.get(w, w) for w in words if not w.isdigit())


def _name(text: str) -> str:
    if "'" in text or "DE L " in text:
        text = _ELIDED.sub(" ", text)
    words = _WORD.findall(text)
    return " ".join([w for w in words if w not in ARTICLES] or words)


def _way(text: str) -> re.Match | None:
    """(kind of way as written, rest) of a text that begins with one."""
    first = _FIRST.match(text + " ")
    return first if first and first[1] in KIND_OF else None


def parse(address: str | None, postcode: str | None, commune: str | None) -> Address:
    """Take an address apart; parts standing in the address field fill those missing in their own."""
    return Address(*_parted(_QUOTES.sub(" ", upper(address)), postcode, commune))


def parsed(addresses: list[str | None], postcodes: list[str | None], communes: list[str | None]) -> Iterator[tuple[str, str, str, str, str, str]]:
    """``parse`` of many, as plain tuples."""
    lines = _QUOTES.sub(" ", upper_lines(addresses)).split("\n")
    if len(lines) != len(addresses):  # an address has several lines itself
        lines = [_QUOTES.sub(" ", upper(a)) for a in addresses]
    return map(_parted, lines, postcodes, communes)


def _parted(text: str, postcode: str | None, commune: str | None) -> tuple[str, str, str, str, str, str]:
    """``parse`` of an address in upper case without quotes. A pattern is tried only where the text has what it can't do without."""
    text = text.strip(" ,;-.")
    code, town = postcode_of(postcode), commune_of(commune)
    if not text:
        return "", "", "", "", code, town
    tail = _TAIL.search(" " + text)
    if tail and (tail[2] or len(tail[1].replace(" ", "")) == 5):
        text = (" " + text)[: tail.start()].strip(" ,;-")
        code, town = code or postcode_of(tail[1]), town or commune_of(tail[2])
    parts = [p for p in _SPLIT.split(text) if p] if "," in text or "-" in text else [text]
    for k in range(len(parts) - 1, -1, -1):  # a number alone belongs to what follows, or else to what stands before
        if len(parts) > 1 and _ALONE.match(parts[k]):
            at = k if k + 1 < len(parts) else k - 1
            parts[at : at + 2] = [" ".join(parts[at : at + 2])]
    if len(parts) > 1:  # a building or hamlet before or after the way itself
        rated = [bool(_way(p) or _PLACE.match(p) or _NUMBERED.match(p)) for p in parts]
        if any(rated):
            parts = [p for p, good in zip(parts, rated) if good]
        else:
            parts = parts[-1:]
    text = ", ".join(parts)
    if not text:
        return "", "", "", "", code, town
    number = suffix = ""
    place = _PLACE.match(text) if text[0] == "L" else None
    if place:
        return "", "", "PLACE_NAME", _name(text[place.end():]), code, town
    ahead = _AHEAD.match(text + " ") if text[0] == "N" or text[0].isdecimal() else None
    if ahead and text[ahead.end():].strip(" ,."):
        number, suffix = ahead[1].lstrip("0") or "0", SUFFIXES.get(ahead[2] or ahead[3] or "", "")
        text = text[ahead.end():].strip(" ,.")
    elif text[-1] in _ENDS or text[-1].isdecimal():
        behind = _BEHIND.search(text)
        if behind:
            number, suffix = behind[1].lstrip("0") or "0", SUFFIXES.get(behind[2] or "", "")
            text = text[: behind.start()].strip(" ,.")
    way = _way(text)
    if way:
        return number, suffix, KIND_OF[way[1]], _name(way[2]), code, town
    if number:
        return number, suffix, "", _name(text), code, town
    return "", "", "PLACE_NAME" if text else "", _name(text), code, town


def near(a: str, b: str, most: int = 1) -> bool:
    """Whether at most ``most`` letters were changed, left out, added or swapped with the next."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > most:
        return False
    short, head, tail = min(len(a), len(b)), 0, 0
    while head < short and a[head] == b[head]:
        head += 1
    while tail < short - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    a, b = a[head : len(a) - tail], b[head : len(b) - tail]
    if most <= 0 or not (a or b):
        return not (a or b)
    if len(a) >= 2 and len(b) >= 2 and a[0] == b[1] and a[1] == b[0] and near(a[2:], b[2:], most - 1):
        return True
    return near(a[1:], b, most - 1) or near(a, b[1:], most - 1) or near(a[1:], b[1:], most - 1)


def sounds(text: str) -> list[str]:
    """Keys of how a name's start and end sound: letters that sound alike count as one.

    The two windows don't overlap, so a slip of one letter leaves the start or the end as it is; lengths at which the
    window widens have the keys of both widths, so a letter left out changes nothing.
    """
    bare = text.replace(" ", "").translate(_ALIKE)
    n = len(bare)
    sizes = [4] if n >= 9 else [4, 3] if n == 8 else [3] if n == 7 else [3, 2] if n == 6 else [2] if n == 5 else [n]
    return [k for size in sizes for k in ("<" + bare[:size], ">" + bare[n - size :])]
