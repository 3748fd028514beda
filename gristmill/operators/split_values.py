"""Several values packed in one field: a parsing expression grammar over delimited text.

    field   <- sep* (value (sep+ value)*)? sep* end
    value   <- quoted &(blank* (sep / end))  /  bare
    quoted  <- '"' ( '""' / [^"] )* '"'
    bare    <- ( quoted / bracket / unit )+
    bracket <- '(' ( bracket / quoted / [^()"] )* ')'
    unit    <- !sep .
    sep     <- strong / blank+ '-' &blank   (for addresses also: blank)

Choices are ordered: each alternative is tried at the same place, and a failed one gives its input back. A quote or a
bracket that never closes therefore falls back to an ordinary character, and the value is flagged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Marks that separate wherever they stand outside quotes and brackets (fixed values).
STRONG = ";,|/•+\t\n\r\x0b\x0c"

_QUOTED = re.compile(r'"((?:""|[^"])*)"')
_PLAIN = re.compile(r'[^";,|/•+()\s-]+')
_DASH = re.compile(r"\s+[-–—]+(?=\s)|^\s*[-–—]+(?=\s)|\s+[-–—]+$")
_BLANK = re.compile(r"\s*")

class FieldGrammar:
    """The grammar above; ``blanks_separate`` for fields of addresses.

    ``parse`` gives (item, kind, error) in order, kind one of quoted, bracketed, bare. Empty values don't appear,
    repeated ones do. ``+`` and ``/`` separate in lists of labels; in addresses ``+`` only between blanks, since it
    may stand inside a mailbox name.
    """

    def __init__(self, blanks_separate: bool = False):
        self.blanks_separate = blanks_separate

    def _separator(self, text: str, at: int, start: int) -> int:
        """End of the separator at ``at``, or -1."""
        mark = text[at]
        if mark in STRONG:
            if mark == "+" and self.blanks_separate and 0 < at < len(text) - 1 and not text[at - 1].isspace() and not text[at + 1].isspace():
                return -1
            return at + 1
        if mark.isspace():
            if self.blanks_separate:
                return _BLANK.match(text, at).end()
            dash = _DASH.match(text, at)
            return dash.end() if dash else -1
        if mark in "-–—" and at == start:
            dash = _DASH.match(text) if at == 0 else None
            if dash:
                return dash.end()
            if at + 1 == len(text) or text[at + 1].isspace():
                return at + 1
        return -1

    @staticmethod
    def _brackets(text: str) -> dict[int, int]:
        """End of each balanced bracket by its start, in one pass; marks inside quotes don't count."""
        ends: dict[int, int] = {}
        if "(" not in text:
            return ends
        opened, here = [], 0
        while here < len(text):
            mark = text[here]
            if mark == '"' and (quoted := _QUOTED.match(text, here)):
                here = quoted.end()
                continue
            here += 1
            if mark == "(":
                opened.append(here - 1)
            elif mark == ")" and opened:
                ends[opened.pop()] = here
        return ends

    def _value(self, text: str, at: int, brackets: dict[int, int]) -> tuple[int, str, str, str | None]:
        quoted = _QUOTED.match(text, at) if text[at] == '"' else None
        if quoted:
            after = _BLANK.match(text, quoted.end()).end()
            if after == len(text) or self._separator(text, after, -1) > 0 or self._separator(text, quoted.end(), -1) > 0:
                return quoted.end(), quoted[1].replace('""', '"').strip(), "quoted", None
        here, kind, error, parts = at, "bare", None, []
        while here < len(text):
            plain = _PLAIN.match(text, here)
            if plain:
                parts.append(plain[0])
                here = plain.end()
                continue
            mark = text[here]
            if mark == '"':
                inner = _QUOTED.match(text, here)
                if inner:
                    parts.append(inner[1].replace('""', '"'))
                    here = inner.end()
                    continue
                error = "open_quote"
            elif mark == "(":
                end = brackets.get(here)
                if end:
                    parts.append(text[here:end])
                    kind, here = "bracketed", end
                    continue
                error = "open_bracket"
            elif mark == ")":
                error = "stray_bracket"
            elif self._separator(text, here, -1) > 0:
                break
            parts.append(mark)
            here += 1
        return here, "".join(parts).strip(), kind, error

    def parse(self, text: str | None) -> list[tuple[str, str, str | None]]:
        if not text:
            return []
        found, here, start = [], 0, 0
        brackets = self._brackets(text)
        while here < len(text):
            end = self._separator(text, here, start)
            if end > 0:
                here = start = end
                continue
            if text[here].isspace():
                here += 1
                start = here
                continue
            here, item, kind, error = self._value(text, here, brackets)
            start = -1
            if item:
                found.append((item, kind, error))
        return found


def split_fields(df: DataFrame, key: str, fields: dict[str, bool], least: int = 1) -> DataFrame:
    """One row per value: (``key``, field, pos from 1, item, kind, error).

    ``fields`` names the columns; True where blanks separate. Fields with fewer than ``least`` values are left out.
    NULL and empty text hold no value; repeated rows give repeated values; columns of any other name are ignored.
    The parser runs over Arrow batches, no shuffle; each distinct text of a batch is parsed once.
    """
    names = list(fields)

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grammars = {name: FieldGrammar(blank) for name, blank in fields.items()}
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("key", "field", "pos", "item", "kind", "error")}
            for name in names:
                seen: dict[str, list] = {}
                for key_value, text in zip(batch["key"], batch[name]):
                    if not text:
                        continue
                    values = seen.get(text)
                    if values is None:
                        values = seen[text] = grammars[name].parse(text)
                    if len(values) < least:
                        continue
                    for pos, (item, kind, error) in enumerate(values, 1):
                        for column, value in zip(out, (key_value, name, pos, item, kind, error)):
                            out[column].append(value)
            if out["key"]:
                yield pd.DataFrame(out)

    kind = df.schema[key].dataType.simpleString()
    lean = df.select(F.col(f"`{key}`").alias("key"), *[F.col(f"`{n}`").cast("string").alias(n) for n in names])
    parsed = lean.mapInPandas(parse, f"key {kind}, field string, pos int, item string, kind string, error string")
    return parsed.withColumnRenamed("key", key)
