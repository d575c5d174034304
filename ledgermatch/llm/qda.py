"""Document quality by regularised quadratic discriminant analysis.

A text becomes a vector of statistics: rates of symbols, capitals, digits and
marks, over the whole text and in its worst stretch, word lengths, and measures
of repetition, each put on a log or log-odds scale.  The labelled training rows
of each class give a mean and a covariance.  Covariances are shrunk towards a
multiple of the identity by the share that Ledoit and Wolf derive from the
scatter of the rows, and their Cholesky factors are computed once.  A text's
log-odds are the difference of the two classes' log densities (Mahalanobis
distance by a triangular solve, log determinant from the factor's diagonal)
plus that of the class shares.

Nothing is sampled: the moments are sums over all labelled training rows,
added up by Spark; the driver gets some hundred numbers per class whatever the
size of the data.

The score is ``(1 + d) / (2 + d)`` for log-odds d >= 0 and ``1 / (2 - d)`` below:
0.5 at even odds, in the order of d, and never rounded to 0 or 1.  A null or
empty text has the statistics of no words and the score that goes with them.
Without labelled rows of both classes all scores are 0.5.  A document with several labels counts
with the least of them; labels other than 0 and 1 are ignored.  Repeated rows
are scored alike and count each in training.  Further columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold_of, slices, text_of, written

THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
WINDOW = 160
SYMBOLS = "#*$%&|<>"

NAMES = ["words", "word_length", "word_spread", "symbols", "exclamations", "capitals", "digits", "letters", "ends",
         "distinct", "top_word", "repeated", "repeated_lines", "worst_symbols", "worst_exclamations", "worst_capitals",
         "least_letters"]


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Per code point: bit 1 letter, 2 capital, 4 digit, 8 space, 16 symbol, 32 exclamation mark, 64 sentence end."""
    table = np.zeros(0x110000, np.uint8)
    for i in range(0x110000):
        c = chr(i)
        table[i] = c.isalpha() | c.isupper() << 1 | c.isdigit() << 2 | c.isspace() << 3
    for c in SYMBOLS:
        table[ord(c)] |= 16
    table[ord("!")] |= 32
    for c in ".?!":
        table[ord(c)] |= 64
    return table


def _odds(part: float, whole: float) -> float:
    """Log-odds of a share, half a case added to either side."""
    return float(np.log((part + 0.5) / (whole - part + 0.5)))


def statistics(text: str) -> list[float]:
    kinds = _classes()[np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)]
    letter, capital, digit, space, symbol, mark, end = ((kinds >> b & 1).astype(np.int32) for b in range(7))
    words = text.split()
    n = len(words)
    lengths = np.fromiter(map(len, words), np.float64, n) if n else np.zeros(1)
    counts = Counter(words)
    triples = max(n - 2, 0)
    repeated = triples - len(set(zip(words, words[1:], words[2:])))
    lines = [x for x in text.split("\n") if x.strip()]
    letters, black = int(letter.sum()), int(len(kinds) - space.sum())
    at = np.arange(0, max(len(kinds) - WINDOW // 2, 1), WINDOW)  # the last stretch takes up to half of one more

    def worst(part: np.ndarray, whole: np.ndarray, sign: int = 1) -> float:
        if not len(kinds):
            return _odds(0, 0)
        p, w = np.add.reduceat(part, at), np.add.reduceat(whole, at)
        return float(sign * (sign * np.log((p + 0.5) / (w - p + 0.5))).max())

    dark = 1 - space
    return [float(np.log1p(n)), float(np.log1p(lengths.mean())), float(np.log1p(lengths.std())),
            _odds(int(symbol.sum()), black), _odds(int(mark.sum()), black), _odds(int(capital.sum()), letters),
            _odds(int(digit.sum()), black), _odds(letters, black), _odds(int(end.sum()), black),
            float(np.log1p(len(counts)) / np.log1p(max(n, 1))), _odds(max(counts.values(), default=0), n),
            _odds(repeated, triples), _odds(len(lines) - len(set(lines)), len(lines)),
            worst(symbol, dark), worst(mark, dark), worst(capital, np.maximum(letter, capital)), worst(letter, dark, -1)]


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, x``: the statistics of each whole text, written to the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in slices(texts):
                x = pa.array([statistics(t) for t in texts[lo:hi]], pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), x], ["doc_id", "x"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, x array<double>")
    return written(rows, "qda-statistics")


# -- moments ----------------------------------------------------------------------------------
def _sums(rows: DataFrame, of, size: int) -> dict[int, np.ndarray]:
    """Per class, the sum over its rows of ``of(class, matrix of rows)``, ``size`` numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            ys = b.column(0).to_numpy(zero_copy_only=False)
            xs = np.array(b.column(1).to_pylist(), dtype=np.float64)
            for y in (0, 1):
                if (ys == y).any():
                    total[y] = total.get(y, 0) + of(y, xs[ys == y])
        for y, values in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([y] * size, pa.int32()), pa.array(range(size), pa.int32()),
                                              pa.array(values, pa.float64())], ["y", "i", "v"])

    parts = rows.select("y", "x").mapInArrow(run, "y int, i int, v double")
    got: dict[int, np.ndarray] = {}
    for r in parts.groupBy("y", "i").agg(F.sum("v").alias("v")).collect():  # 2 * size rows
        got.setdefault(r.y, np.zeros(size))[r.i] = r.v
    return got


@dataclass
class Normal:
    """A class: log share, mean, Cholesky factor of the shrunk covariance, half its log determinant."""

    log_share: float
    mean: np.ndarray
    factor: np.ndarray
    half_log_det: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = np.linalg.solve(self.factor, (x - self.mean).T)
        return self.log_share - self.half_log_det - 0.5 * (z * z).sum(axis=0)


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    classes: tuple[Normal, Normal] | None
    shrinkage: tuple[float, float] = (0.0, 0.0)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        if self.classes is None:
            return np.zeros(len(x))
        x = (x - self.center) / self.scale
        return self.classes[1].log_density(x) - self.classes[0].log_density(x)


def shrunk(cov: np.ndarray, scatter: float, n: float, least: float = 1e-3) -> tuple[np.ndarray, float]:
    """Ledoit and Wolf: the covariance mixed with its mean variance times the identity, and the share of the latter.

    ``scatter`` is the mean over the rows of ``|x x' - cov|²`` for centred x.
    """
    target = np.trace(cov) / len(cov) * np.eye(len(cov))
    apart = ((cov - target) ** 2).sum()
    share = min(1.0, max(least, scatter / n / apart if apart > 0 else 1.0))
    out = (1 - share) * cov + share * target
    return out + 1e-9 * np.eye(len(cov)), float(share)


def fit(rows: DataFrame, labels: DataFrame) -> Model:
    """From all rows of ``measured`` with a label 0 or 1 in ``labels.quality``."""
    size = len(NAMES)
    marked = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("y")))
    rows = written(rows.join(marked, "doc_id").select("y", "x"), "qda-training")  # read twice

    def moments(_, x):
        return np.concatenate([[len(x)], x.sum(axis=0), (x.T @ x).ravel()])

    got = _sums(rows, moments, 1 + size + size * size)
    if set(got) != {0, 1}:
        return Model(np.zeros(size), np.ones(size), None)
    n = {y: v[0] for y, v in got.items()}
    means = {y: v[1:size + 1] / n[y] for y, v in got.items()}
    both = sum(got.values())
    center = both[1:size + 1] / both[0]
    scale = np.sqrt(np.maximum(np.diag(both[size + 1:].reshape(size, size)) / both[0] - center ** 2, 0))
    scale[scale < 1e-6] = 1.0
    covs = {y: (v[size + 1:].reshape(size, size) / n[y] - np.outer(means[y], means[y])) / np.outer(scale, scale)
            for y, v in got.items()}

    def scatter(y, x):
        z = (x - means[y]) / scale
        return np.array([((z * z).sum(axis=1) ** 2).sum()])

    fourth = _sums(rows, scatter, 1)
    classes, shares = [], []
    for y in (0, 1):
        cov, share = shrunk(covs[y], fourth[y][0] / n[y] - (covs[y] ** 2).sum(), n[y])
        factor = np.linalg.cholesky(cov)
        classes.append(Normal(float(np.log(n[y] / (n[0] + n[1]))), (means[y] - center) / scale, factor,
                              float(np.log(np.diag(factor)).sum())))
        shares.append(share)
    return Model(center, scale, (classes[0], classes[1]), (shares[0], shares[1]))


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, log_odds`` for every row of ``measured``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = model.log_odds(np.array(b.column(1).to_pylist(), dtype=np.float64).reshape(-1, len(NAMES)))
            score = np.where(d >= 0, (1 + d) / (2 + np.abs(d)), 1 / (2 + np.abs(d)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array(d)], ["doc_id", "score", "log_odds"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "x").mapInArrow(run, f"doc_id {kind}, score double, log_odds double")


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, log_odds`` for all documents; learns from rows that are not held out."""
    fold = fold_of(F.col("doc_id"), FOLDS)
    rows = measured(docs)  # every text is read once
    model = fit(rows.where(fold != HELD_OUT), labels)
    return scored(rows, model).select(
        "doc_id", (fold == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "log_odds")
