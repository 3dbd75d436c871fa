"""Document quality by regularised quadratic discriminant analysis.

A text becomes a short vector of transformed statistics (FEATURES), written
once.  For each class of labelled rows, counts, sums and cross products of the
vectors are summed in Spark, so the driver receives one number per class and
cell however many rows there are.  A class's covariance is shrunk towards the
diagonal of the pooled one, which keeps it invertible where a statistic hardly
varies inside the class.  Its Cholesky factor is inverted once and kept; a
score is the difference of the two Mahalanobis log-densities, plus the log
ratio of the class sizes, as a probability.

Defined results: a null text is empty; every text has a score; a null or
unlabelled id teaches nothing; every label row counts, so repeated ones count
again, and so do repeated documents; labels other than 0 and 1 are left out.
Rows with a null id are not held out.  Without labels of both classes every
score is the share of label 1 among the labels (0.5 without any).  Rows stay
independent and other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricepanel.lineage import ship
from pricepanel.llm.columns import VISIBLE, Runs, Words, mix, text_slices
from pricepanel.llm.registry import saved

#: Weight of the pooled diagonal in a class's covariance.
SHRINKAGE = 0.1
#: Least pooled variance of a statistic.
FLOOR = 1e-4
#: Scores from here on predict label 1.
THRESHOLD = 0.3

FEATURES = (
    "log words",
    "log word length",
    "spread of word length",
    "upper-case letters",
    "digits",
    "symbols",
    "exclamation and question marks",
    "other punctuation",
    "bytes beyond ASCII",
    "line ends a word",
    "distinct words",
    "repeated pairs of words",
    "repeated triples of words",
    "repeated lines",
    "words ending in a sentence end",
    "words ending in a symbol",
    "words without letters",
)

_OTHER, _UPPER, _LOWER, _DIGIT, _SYMBOL, _MARK, _PUNCTUATION, _WIDE = range(8)
_CLASS = np.full(256, _OTHER, np.int64)
for _kind, _signs in ((_SYMBOL, "#*$%&|<>@^~_=+\\/{}[]`"), (_MARK, "!?"), (_PUNCTUATION, ".,;:'\"()-")):
    _CLASS[[ord(c) for c in _signs]] = _kind
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[128:] = _WIDE
_NEWLINE = ord("\n")


def _per_row(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``flags`` over every range first[r]:first[r+1]."""
    total = np.concatenate([[0], np.cumsum(flags)])
    return total[first[1:]] - total[first[:-1]]


def _repeated(values: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Per row, how many values equal an earlier one of the row."""
    key = mix(values + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    again = order[1:][key[order[1:]] == key[order[:-1]]]
    return np.bincount(row[again], minlength=n_rows)


def _angle(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """Variance-stabilised share; zero of nothing."""
    return np.arcsin(np.sqrt(np.clip(part / np.maximum(whole, 1), 0, 1)))


def features(texts: pa.Array) -> np.ndarray:
    """One row of FEATURES per text."""
    words = Words(texts, VISIBLE)
    n_rows, count, row = len(texts), words.count, words.row
    size = np.diff(words.offsets)
    kinds = _CLASS[words.bytes]
    byte_row = np.repeat(np.arange(n_rows), size)
    by = np.bincount(byte_row * 8 + kinds, minlength=8 * n_rows).reshape(n_rows, 8)
    visible = by.sum(axis=1) - by[:, _OTHER]
    letters = by[:, _UPPER] + by[:, _LOWER]

    lengths = (words.end - words.start).astype(float)
    mean = _per_row(lengths, words.first) / np.maximum(count, 1)
    spread = np.sqrt(_per_row((lengths - mean[row]) ** 2, words.first) / np.maximum(count, 1))

    hashes = words.hashes()
    runs = Runs(hashes)
    repeats = [_repeated(hashes, row, n_rows)]
    for n in (2, 3):
        at = np.flatnonzero(row[n - 1 :] == row[: len(row) - n + 1]) if len(row) >= n else np.zeros(0, np.int64)
        repeats.append(_repeated(runs.of(at, at + n), row[at], n_rows))

    ends = np.flatnonzero(words.bytes == _NEWLINE)
    starts = np.unique(np.concatenate([words.offsets, ends + 1]))
    lo = np.searchsorted(words.start, starts)
    hi = np.append(lo[1:], len(words.start))
    full = np.flatnonzero(hi > lo)
    line_row = row[lo[full]] if len(row) else np.zeros(0, np.int64)
    lines = np.bincount(line_row, minlength=n_rows)
    same_lines = _repeated(runs.of(lo[full], hi[full]), line_row, n_rows)

    last = kinds[words.end - 1]
    sentence = (words.bytes[words.end - 1] == ord(".")) | (last == _MARK)
    alphabetic = np.concatenate([[0], np.cumsum((kinds == _UPPER) | (kinds == _LOWER) | (kinds == _WIDE))])
    bare = alphabetic[words.end] == alphabetic[words.start]

    columns = [
        np.log1p(count),
        np.log1p(mean),
        np.log1p(spread),
        _angle(by[:, _UPPER], letters),
        _angle(by[:, _DIGIT], visible),
        _angle(by[:, _SYMBOL], visible),
        _angle(by[:, _MARK], visible),
        _angle(by[:, _PUNCTUATION], visible),
        _angle(by[:, _WIDE], visible),
        _angle(lines, count),
        np.log1p(count) - np.log1p(count - repeats[0]),
        _angle(repeats[1], count - 1),
        _angle(repeats[2], count - 2),
        _angle(same_lines, lines),
        _angle(_per_row(sentence, words.first), count),
        _angle(_per_row(last == _SYMBOL, words.first), count),
        _angle(_per_row(bare, words.first), count),
    ]
    return np.stack(columns, axis=1)


def measure(docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, x): the statistics of every whole text."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            x = features(part.column("text"))
            lists = pa.ListArray.from_arrays(
                np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.ravel())
            )
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), lists], names=["doc_id", "x"])

    chosen = docs.selectExpr(f"cast(`{id_col}` as long) AS doc_id", f"`{text}` AS text")
    return chosen.mapInArrow(run, "doc_id long, x array<double>")


class Discriminant:
    """Class means, shrunk covariances as inverted Cholesky factors, and log sizes."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]], shrinkage: float = SHRINKAGE):
        """``moments``: class -> (rows, sums, cross products)."""
        self.share = None
        rows = sum(n for n, _, _ in moments.values())
        if set(moments) != {0, 1}:
            self.share = moments[1][0] / rows if 1 in moments else 0.0 if moments else 0.5
            return
        within = {c: cross - np.outer(total, total) / n for c, (n, total, cross) in moments.items()}
        pooled = np.diag(np.maximum(np.diag(sum(within.values()) / rows), FLOOR))
        self.parts = []
        for c in (0, 1):
            n, total, _ = moments[c]
            covariance = (1 - shrinkage) * within[c] / n + shrinkage * pooled
            factor = np.linalg.cholesky(covariance)
            constant = np.log(n / rows) - np.log(np.diag(factor)).sum()
            self.parts.append((total / n, np.linalg.inv(factor), constant))

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        sides = []
        for mean, inverse, constant in self.parts:
            z = (x - mean) @ inverse.T
            sides.append(constant - 0.5 * (z * z).sum(axis=1))
        return sides[1] - sides[0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.share is not None:
            return np.full(len(x), self.share)
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -500, 500)))


def fit(measured: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """``labels``: (doc_id, quality); sums and cross products are added up in Spark."""
    p = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            x = np.column_stack([np.ones(len(x)), x])
            label = batch.column("quality").to_numpy(zero_copy_only=False)
            for c in (0, 1):
                part = x[label == c]
                if len(part):
                    sums[c] = sums.get(c, 0) + part.T @ part
        for c, cross in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], pa.int32()), pa.array([cross.ravel()], pa.list_(pa.float64()))],
                names=["quality", "cells"],
            )

    known = labels.filter(F.col("quality").isin(0, 1)).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")
    )
    partial = measured.join(known, "doc_id").mapInArrow(run, "quality int, cells array<double>")
    cells = partial.select("quality", F.posexplode("cells").alias("cell", "v"))
    found = cells.groupBy("quality", "cell").agg(F.sum("v").alias("v")).collect()
    moments = {}
    for c in {r["quality"] for r in found}:
        cross = np.zeros((p + 1) ** 2)
        for r in found:
            if r["quality"] == c:
                cross[r["cell"]] = r["v"]
        cross = cross.reshape(p + 1, p + 1)
        moments[c] = (cross[0, 0], cross[0, 1:], cross[1:, 1:])
    return Discriminant(moments, shrinkage)


def score(measured: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every measured row."""
    p = len(FEATURES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, p)
            value = model.scores(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(value), pa.array((value >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"],
            )

    return measured.mapInArrow(run, "doc_id long, score double, predicted int")


def rate(docs: DataFrame, labels: DataFrame, learns: Column, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Scores of all ``docs``; labels are learned from rows of ``labels`` that meet ``learns`` only."""
    measured = saved(measure(docs, text, id_col), "quality")
    return score(measured, fit(measured, labels.filter(learns)))
