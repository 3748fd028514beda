"""Duplicates hidden by formatting: records equal but for white space, case, punctuation or the order of fields.

Text streams through a skip-and-fold table into two rolling polynomial hashes; no canonical string is made. A code
point maps to nothing (skipped) or to the few symbols it folds to, so an accented letter gives the same symbols
whether it came composed or decomposed. Rows whose hashes collide are then compared with their group's first row by
two pointers that skip the same marks. Should a row of a group fail that comparison (a true collision of hashes), it
is grouped again by a digest of its folded symbols, so the result is exact.
"""

from __future__ import annotations

import hashlib
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.session import cut_lineage

P1, P2 = (1 << 31) - 1, (1 << 31) - 19
B1, B2 = 911_382_323, 972_663_749


def fold_symbols(mark: str, loose: bool) -> str:
    """What one character folds to: letters, digits and accents only, or (``loose``) all but white space."""
    folded = unicodedata.normalize("NFD", unicodedata.normalize("NFC", mark).casefold())
    if loose:
        return "".join(c for c in folded if not c.isspace())
    return "".join(c for c in folded if c.isalnum() or unicodedata.combining(c))


class FoldTable:
    """Lookup table over all code points, filled when a code point is first met."""

    def __init__(self, loose: bool = False):
        self.loose = loose
        self.known = np.zeros(0x110000, dtype=bool)
        self.start = np.zeros(0x110000, dtype=np.int64)
        self.count = np.zeros(0x110000, dtype=np.int64)
        self.pool = np.zeros(1, dtype=np.int64)
        self.solid = np.zeros(0x110000, dtype=bool)

    def learn(self, points: np.ndarray) -> None:
        fresh = np.unique(points[~self.known[points]])
        more, size = [], len(self.pool)
        for point in fresh.tolist():
            symbols = [ord(c) for c in fold_symbols(chr(point), self.loose)] if not 0xD800 <= point < 0xE000 else []
            self.start[point], self.count[point] = size + len(more), len(symbols)
            more += symbols
        self.known[fresh] = True
        if more:
            self.pool = np.concatenate([self.pool, np.array(more, dtype=np.int64)])
            for symbol in set(more):
                self.solid[symbol] = _solid(chr(symbol))

    def symbols(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All folded symbols, and the start and end of each row's."""
        texts = pc.fill_null(texts, "")
        points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
        if not self.known[points].all():
            self.learn(points)
        count = self.count[points]
        before = np.concatenate([[0], np.cumsum(count)])
        within = np.arange(before[-1]) - np.repeat(before[:-1], count)
        out = self.pool[np.repeat(self.start[points], count) + within]
        row_end = before[np.cumsum(lengths)]
        row_start = np.concatenate([[0], row_end[:-1]])
        if self.loose:  # marks before the first and after the last letter, accent or digit don't count
            solid = np.nonzero(self.solid[out])[0]
            a, b = np.searchsorted(solid, row_start), np.searchsorted(solid, row_end)
            some = b > a
            row_start = np.where(some, solid[np.minimum(a, max(len(solid) - 1, 0))] if len(solid) else 0, 0)
            row_end = np.where(some, (solid[b - 1] if len(solid) else 0) + 1, 0)
        return out, row_start, row_end


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(max(n, 1), dtype=np.uint64)
    size, step = 1, base
    while size < n:
        more = min(size, n - size)
        out[size : size + more] = out[:more] * np.uint64(step) % np.uint64(prime)
        size, step = size + more, step * step % prime
    return out


def polynomial_hashes(symbols: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each row: the sum of symbol times base to the power of its place, modulo a prime.

    An empty row hashes to zero.
    """
    at, hashes = np.arange(len(symbols)), []
    row = np.searchsorted(start, at, side="right") - 1 if len(start) else at
    owner = np.zeros(len(symbols), dtype=np.int64)
    filled = np.nonzero(end > start)[0]
    if len(filled):
        row = filled[np.maximum(np.searchsorted(start[filled], at, side="right") - 1, 0)]
        owner = start[row]
    place = np.maximum(at - owner, 0)
    for base, prime in ((B1, P1), (B2, P2)):
        power = _powers(base, prime, int(place.max()) + 1 if len(place) else 1)
        terms = (symbols + 1).astype(np.uint64) * power[place] % np.uint64(prime)
        total = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
        hashes.append((total[end] - total[start]) % np.uint64(prime))
    return hashes[0], hashes[1]


def _skip_equal(a: str, b: str, loose: bool, memo: dict[tuple[str, bool], str]) -> bool:
    """Two pointers over raw text, each skipping what doesn't count."""

    def symbol_stream(text: str) -> Iterator[str]:
        for mark in text:
            folded = memo.get((mark, loose))
            if folded is None:
                folded = memo[(mark, loose)] = fold_symbols(mark, loose)
            yield from folded

    if loose:
        a, b = _trim_marks(a), _trim_marks(b)
    left, right = symbol_stream(a), symbol_stream(b)
    while True:
        x, y = next(left, None), next(right, None)
        if x != y:
            return False
        if x is None:
            return True


def _solid(mark: str) -> bool:
    """Letters, digits and accents: an accent at the end counts, whether it came composed or not."""
    return mark.isalnum() or unicodedata.combining(mark) != 0


def _trim_marks(text: str) -> str:
    first, last = 0, len(text)
    while first < last and not _solid(text[first]):
        first += 1
    while last > first and not _solid(text[last - 1]):
        last -= 1
    return text[first:last]


def with_key(df: DataFrame, id_col: str, columns: list[str], loose: list[str], swaps: list[tuple[str, str]]) -> DataFrame:
    """(id, key, columns as text): ``key`` combines the field hashes, in either order for each pair of ``swaps``."""
    order = [c for c in columns if not any(c in pair for pair in swaps)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = {False: FoldTable(False), True: FoldTable(True)}
        for batch in batches:
            hashed = {}
            for c in columns:
                table = tables[c in loose]
                hashed[c] = polynomial_hashes(*table.symbols(batch.column(batch.schema.get_field_index(c))))
            parts = [hashed[c] for c in order]
            for a, b in swaps:
                (a1, a2), (b1, b2) = hashed[a], hashed[b]
                first = (a1 < b1) | ((a1 == b1) & (a2 <= b2))
                parts += [(np.where(first, a1, b1), np.where(first, a2, b2)), (np.where(first, b1, a1), np.where(first, b2, a2))]
            k1 = k2 = np.zeros(batch.num_rows, dtype=np.uint64)
            for h1, h2 in parts:
                k1 = (k1 * np.uint64(B1) + h1 + np.uint64(1)) % np.uint64(P1)
                k2 = (k2 * np.uint64(B2) + h2 + np.uint64(1)) % np.uint64(P2)
            key = ((k1 << np.uint64(31)) | k2).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(key), *batch.columns[1:]], names=["id", "key", *columns])

    lean = df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), *[F.col(f"`{c}`").cast("string").alias(c) for c in columns])
    return lean.mapInArrow(run, "id bigint, key bigint, " + ", ".join(f"`{c}` string" for c in columns))


def repeated_rows(df: DataFrame, id_col: str, columns: list[str], loose: list[str] | None = None, swaps: list[tuple[str, str]] | None = None) -> DataFrame:
    """(first_id, copy_id): one row for each row that repeats another in other writing.

    ``first_id`` is the least id of the record. NULL equals empty. ``loose`` columns (addresses) only disregard case,
    white space and marks at either end; ``swaps`` are pairs of columns that may change places. Columns not named
    don't count. Ids must be unique and not NULL. An empty table gives no row.

    Only (id, key) of all rows is grouped first, with map-side counts. A group of more than a thousandth of the rows
    is hot: there are fewer than a thousand, so their first rows are broadcast. The texts of the rest of the repeated
    rows meet their first row in a join on the key.
    """
    inner = {c: f"c{k}" for k, c in enumerate(columns)}  # names of our own, whatever the table's are
    df = df.select(F.col(f"`{id_col}`").alias("row"), *[F.col(f"`{c}`").alias(k) for c, k in inner.items()])
    id_col, columns, loose, swaps = "row", list(inner.values()), [inner[c] for c in loose or []], [(inner[a], inner[b]) for a, b in swaps or []]
    rows = with_key(df, id_col, columns, loose, swaps)
    keys = cut_lineage(rows.select("id", "key"))
    total = keys.count()
    groups = cut_lineage(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id")).filter("n > 1"))
    hot_from = max(10_000, total // 1000)
    hot, cold = groups.filter(F.col("n") > hot_from).drop("n"), groups.filter(F.col("n") <= hot_from).drop("n")
    text = F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in columns]).alias("text")
    texts = rows.select("id", "key", text)

    def against_first(members: DataFrame, small: bool) -> DataFrame:
        firsts = members.filter("id = first_id").select("key", F.col("text").alias("first_text"))
        copies = members.filter("id <> first_id")
        return copies.join(F.broadcast(firsts) if small else firsts, "key")

    pairs = against_first(texts.join(cold, "key"), False)
    if not hot.isEmpty():
        pairs = pairs.unionByName(against_first(texts.join(F.broadcast(hot), "key"), True))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[tuple[str, bool], str] = {}
        place = {c: k for k, c in enumerate(columns)}
        straight = [(k, k, c in loose) for c, k in place.items() if not any(c in pair for pair in swaps)]
        crossed = [(place[a], place[b]) for a, b in swaps]

        def same(a: list, b: list) -> bool:
            equal = lambda i, j, free: a[i] == b[j] or _skip_equal(a[i], b[j], free, memo)
            return all(equal(*x) for x in straight) and all(
                (equal(i, i, False) and equal(j, j, False)) or (equal(i, j, False) and equal(j, i, False)) for i, j in crossed
            )

        def digest(a: list) -> str:
            parts = ["".join(fold_symbols(m, free) for m in (_trim_marks(a[i]) if free else a[i])) for i, _, free in straight]
            parts += [x for i, j in crossed for x in sorted("".join(fold_symbols(m, False) for m in a[k]) for k in (i, j))]
            return hashlib.sha256("\x00".join(parts).encode("utf-8", "surrogatepass")).hexdigest()

        for b in batches:
            ok = [same(x, y) for x, y in zip(b["text"], b["first_text"])]
            marks = [None if good else digest(x) for good, x in zip(ok, b["text"])]
            yield pd.DataFrame({"id": b["id"], "first_id": b["first_id"], "key": b["key"], "digest": marks})

    checked = cut_lineage(pairs.mapInPandas(verify, "id bigint, first_id bigint, key bigint, digest string"))
    found = checked.filter("digest IS NULL").select("first_id", F.col("id").alias("copy_id"))
    failed = checked.filter("digest IS NOT NULL")
    if failed.isEmpty():
        return found
    again = failed.groupBy("key", "digest").agg(F.min("id").alias("first_id"))
    return found.unionByName(failed.drop("first_id").join(again, ["key", "digest"]).filter("id <> first_id").select("first_id", F.col("id").alias("copy_id")))


def collapse(df: DataFrame, id_col: str, found: DataFrame) -> DataFrame:
    """One row per record: (first_id, n_copies), 1 for rows that nothing repeats."""
    copies = found.groupBy("first_id").agg(F.count(F.lit(1)).alias("more"))
    ids = df.select(F.col(f"`{id_col}`").cast("bigint").alias("first_id")).join(found.select(F.col("copy_id").alias("first_id")), "first_id", "left_anti")
    return ids.join(copies, "first_id", "left").select("first_id", (1 + F.coalesce("more", F.lit(0))).alias("n_copies"))
