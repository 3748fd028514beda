"""Reading level of documents from the grades at which words are acquired.

Graded texts give each word's distribution over the grades; its acquisition grade is a quantile of that distribution.
A document is described by quantiles of the acquisition grades of its known words, and calibrated to the grades of
the graded sample. The calibration uses grades of words learned without the document's own fold, so a word that
occurs in one graded text alone can't vouch for itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.functions import text as T
from gristmill.session import cut_lineage

GRADES, FOLDS, BINS = 5, 4, 50
QUANTILES = np.array([0.1, 0.25, 0.5, 0.75, 0.9, 0.97])


@dataclass
class LevelModel:
    """Word grades and the calibration; ``vocabulary`` is a DataFrame (word, grade, f0..f3 without that fold)."""

    vocabulary: DataFrame
    small: bool
    weights: np.ndarray


def acquisition(counts: np.ndarray, totals: np.ndarray, quantile: float = 0.5, least: float = 2.0) -> np.ndarray:
    """Acquisition grade of each word: the interpolated quantile of its rate over the grades; NaN below ``least`` texts."""
    rate = (counts + 0.02) / np.maximum(totals, 1e-9)
    share = rate / rate.sum(axis=1, keepdims=True)
    reached = np.cumsum(share, axis=1)
    k = np.minimum((reached < quantile).sum(axis=1), GRADES - 1)
    rows = np.arange(len(counts))
    before = np.where(k > 0, reached[rows, np.maximum(k - 1, 0)], 0.0)
    grade = k + 0.5 + (quantile - before) / share[rows, k]
    return np.where(counts.sum(axis=1) >= least, grade, np.nan)


def describe(bins: np.ndarray) -> np.ndarray:
    """Quantiles, mean and log count of word grades, from rows of bin counts."""
    total = bins.sum(axis=1, keepdims=True)
    centre = 0.5 + (np.arange(BINS) + 0.5) * GRADES / BINS
    reached = np.cumsum(bins, axis=1)
    at = [centre[np.argmax(reached >= q * total, axis=1)] for q in QUANTILES]
    x = np.stack([*at, (bins * centre).sum(axis=1) / total[:, 0], np.log1p(total[:, 0])], axis=1)
    return np.concatenate([x, x**2, np.ones((len(x), 1))], axis=1)


def _histograms(words: DataFrame, grade: str, keep: list[str]) -> DataFrame:
    """(keep..., hist) with hist the counts of word grades by bin: at most ``BINS`` entries a document."""
    place = F.least(F.greatest(F.floor((F.col(grade) - 0.5) * (BINS / GRADES)), F.lit(0)), F.lit(BINS - 1)).cast("int").alias("bin")
    counted = words.filter(F.col(grade).isNotNull()).groupBy(*keep, place).agg(F.sum("n").alias("n"))
    return counted.groupBy(*keep).agg(F.collect_list(F.struct("bin", "n")).alias("hist"))


def _dense(hists: pd.Series) -> np.ndarray:
    bins = np.zeros((len(hists), BINS))
    for k, hist in enumerate(hists):
        for entry in hist:
            bins[k, entry["bin"]] += entry["n"]
    return bins


def fit(documents: DataFrame, levels: DataFrame, max_labelled: int = 20_000, broadcast_words: int = 500_000) -> LevelModel:
    """Learn from at most ``max_labelled`` graded documents (those least by a hash of their id).

    A document graded more than once counts with its median grade; grades outside 1 to 5 or NULL, and graded documents
    that are missing or empty, count nothing. Word counts stay distributed; only calibration rows reach the driver.
    """
    graded = levels.filter(F.col("grade").between(1, GRADES)).groupBy("doc_id").agg(F.median("grade").alias("grade"))
    graded = graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    fold = F.pmod(F.xxhash64(F.lit("fold"), "doc_id"), F.lit(FOLDS)).cast("int")
    texts = documents.select("doc_id", "text").join(F.broadcast(graded) if max_labelled <= 100_000 else graded, "doc_id")
    occurring = cut_lineage(
        texts.select("doc_id", "grade", fold.alias("fold"), F.explode(T.words(F.col("text"))).alias("word"))
        .groupBy("doc_id", "grade", "fold", "word").agg(F.count(F.lit(1)).alias("n"))
    )
    half = lambda g: (F.floor("grade") == g).cast("double") / 2 + (F.ceil("grade") == g).cast("double") / 2
    cells = [F.sum(half(g) * (F.col("fold") == f).cast("double")).alias(f"c{f}_{g}") for f in range(FOLDS) for g in range(1, GRADES + 1)]
    row = occurring.select("doc_id", "grade", "fold").distinct().agg(*cells).collect()[0]
    totals = np.array([row[k] or 0.0 for k in range(FOLDS * GRADES)]).reshape(FOLDS, GRADES)

    def grades(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts = b.drop(columns="word").to_numpy(dtype=float).reshape(len(b), FOLDS, GRADES)
            out = {"word": b["word"], "grade": acquisition(counts.sum(axis=1), totals.sum(axis=0))}
            for f in range(FOLDS):
                out[f"f{f}"] = acquisition(counts.sum(axis=1) - counts[:, f], totals.sum(axis=0) - totals[f])
            yield pd.DataFrame(out)

    shape = "word string, grade double, " + ", ".join(f"f{f} double" for f in range(FOLDS))
    vocabulary = occurring.groupBy("word").agg(*cells).mapInPandas(grades, shape)
    vocabulary = cut_lineage(vocabulary.select("word", *[F.nanvl(c, F.lit(None)).alias(c) for c in ("grade", *[f"f{f}" for f in range(FOLDS)])]).filter("grade IS NOT NULL"))
    small = vocabulary.count() <= broadcast_words
    own = F.element_at(F.array(*[F.col(f"f{f}") for f in range(FOLDS)]), F.col("fold") + 1).alias("own")
    table = F.broadcast(vocabulary) if small else vocabulary
    scored = occurring.withColumnRenamed("grade", "target").join(table, "word").select("doc_id", "target", "n", own)
    sample = _histograms(scored, "own", ["doc_id", "target"]).orderBy("doc_id").toPandas()
    if not len(sample):
        return LevelModel(vocabulary, small, np.zeros(2 * (len(QUANTILES) + 2) + 1))
    x, y = describe(_dense(sample["hist"])), sample["target"].to_numpy(dtype=float)
    weights = np.linalg.solve(x.T @ x + 0.1 * np.eye(x.shape[1]), x.T @ y)
    return LevelModel(vocabulary, small, weights)


def predict(documents: DataFrame, model: LevelModel) -> DataFrame:
    """(doc_id, score, level) of every document; both NULL where no word is known (empty, NULL, other scripts).

    Words are exploded, met with the word table and counted back by document inside one partition; only the bin
    counts of each document are shuffled. The word table is broadcast where its counted size allows, else joined.
    """
    weights = model.weights
    exploded = documents.select("doc_id", F.explode(T.words(F.col("text"))).alias("word"), F.lit(1).alias("n"))
    table = model.vocabulary.select("word", "grade")
    hists = _histograms(exploded.join(F.broadcast(table) if model.small else table, "word"), "grade", ["doc_id"])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            value = np.clip(describe(_dense(b["hist"])) @ weights, 1, GRADES) if len(b) else np.zeros(0)
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": value, "level": np.floor(value + 0.5).astype("int32")})

    found = hists.mapInPandas(score, "doc_id bigint, score double, level int")
    return documents.select(F.col("doc_id").cast("bigint")).join(found, "doc_id", "left")
