"""Quality classifier: random Fourier features over document statistics, ridge regression, isotonic calibration.

1. A text is described by about twenty statistics (lengths, shares of character classes, repetition).
2. Standardised statistics are mapped to ``WIDTH`` random cosine features, whose inner products approximate a
   Gaussian kernel; the random numbers come from a fixed seed.
3. Each partition sums its part of the normal equations of all labelled rows; the sums are added in Spark, and
   a system of WIDTH + 1 unknowns is solved on the driver, whatever the number of rows.
4. Ridge outputs are binned into ``BINS`` equal steps, counted by label in Spark, and made monotone by pooling adjacent
   violators; a score is the calibrated probability of label 1.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from changeflow.llm.common import held_out, load, short_batches, stage

WIDTH = 256
SEED = 8
GAMMA = 0.02  # of the Gaussian kernel over standardised statistics
RIDGE = 1e-3  # per labelled row
BINS = 1024
FOLDS, FOLD = 3, 1

UPPER = bytes(range(65, 91))
LOWER = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
SPACES = b" \t\n\r\x0b\x0c"
STOPS = b".!?"
PUNCTUATION = b",;:'\"-()"
SYMBOLS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and c not in STOPS + PUNCTUATION)
HIGH = bytes(range(128, 256))
N_STATS = 22


def _statistics(text: str | None) -> list[float]:
    """The statistics of a whole text; a NULL or empty one has zeros throughout."""
    raw = (text or "").encode("utf-8")
    words = raw.split()
    if not words:
        return [0.0] * N_STATS

    def share(chars: bytes) -> float:
        return (len(raw) - len(raw.translate(None, chars))) / len(raw)

    n = len(words)
    counts = Counter(words)
    top = counts.most_common(1)[0][1]
    same_as_before = sum(a == b for a, b in zip(words, words[1:]))
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    pairs = len(set(zip(words, words[1:])))
    upper = sum(w.isupper() for w in words)
    return [
        np.log1p(len(raw)), np.log1p(n), float(np.log1p(lengths.mean())), float(np.log1p(lengths.std())),
        np.log1p(lengths.max()), share(UPPER), share(LOWER), share(DIGITS), share(SPACES), share(STOPS),
        share(PUNCTUATION), share(SYMBOLS), share(HIGH), share(b"|"), share(b"!"), len(counts) / n, top / n,
        same_as_before / n, pairs / n, upper / n, len(set(lines)) / len(lines), np.log1p(n / len(lines)),
    ]


def statistics(text: Column) -> Column:
    """The statistics of a text as array<double>."""

    @pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([_statistics(t) for t in texts])

    return of(text)


@dataclass
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    edges: tuple[float, float]
    levels: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return _features(stats, self.mean, self.scale) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return self.levels[_bin(self.raw(stats), self.edges)]


def _projection() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.normal(0, np.sqrt(2 * GAMMA), (N_STATS, WIDTH)), rng.uniform(0, 2 * np.pi, WIDTH)


def _features(stats: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Random Fourier features and a constant."""
    turn, shift = _projection()
    z = np.sqrt(2 / WIDTH) * np.cos(np.clip((stats - mean) / scale, -8, 8) @ turn + shift)
    return np.hstack([z, np.ones((len(z), 1))])


def _bin(raw: np.ndarray, edges: tuple[float, float]) -> np.ndarray:
    low, high = edges
    return np.clip((raw - low) / (high - low) * BINS, 0, BINS - 1).astype(np.int64)


def _pooled(ones: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The non-decreasing levels closest to the bins' shares of ones (pool adjacent violators); an empty bin gets
    the level of the bin below it, or of the first bin that has rows."""
    pools: list[list[float]] = []  # ones, rows, bins
    for one, row in zip(ones, rows):
        pools.append([one, row, 1])
        while len(pools) > 1 and (
            pools[-1][1] == 0 or pools[-2][1] == 0 or pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]
        ):
            last = pools.pop()
            pools[-1] = [x + y for x, y in zip(pools[-1], last)]
    return np.concatenate([np.full(int(bins), one / row) for one, row, bins in pools])


def _sums(frame: DataFrame, schema_size: int, part) -> np.ndarray:
    """The element-wise sum, over partitions, of the vectors that ``part`` makes of each batch; only the sum is
    collected, and its length doesn't depend on the number of rows or partitions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(schema_size)
        for batch in batches:
            if len(batch):
                total += part(np.stack(batch.stats.tolist()), batch.label.to_numpy(np.float64))
        yield pd.DataFrame({"at": np.arange(schema_size), "v": total})

    sums = frame.mapInPandas(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(schema_size)
    out[sums["at"].to_numpy()] = sums.v.to_numpy()
    return out


def fit(labelled: DataFrame) -> QualityModel:
    """A model from rows (stats array<double>, label 0/1). Rows whose label is neither are left out; with labels of
    one kind only, or none, every text gets that label's share (one half without any row)."""
    rows = stage(labelled.where("label IN (0, 1)").select("stats", F.col("label").cast("double").alias("label")))
    moments = _sums(rows, 2 * N_STATS + 2, lambda x, y: np.concatenate([x.sum(0), (x * x).sum(0), [len(y), y.sum()]]))
    n, ones = moments[-2:]
    if ones in (0, n):
        level = 0.5 if n == 0 else ones / n
        return QualityModel(np.zeros(N_STATS), np.ones(N_STATS), np.zeros(WIDTH + 1), (0.0, 1.0), np.full(BINS, level))
    mean = moments[:N_STATS] / n
    scale = np.sqrt(np.maximum(moments[N_STATS:2 * N_STATS] / n - mean**2, 1e-6))
    size = WIDTH + 1

    def normal(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        z = _features(x, mean, scale)
        # Both labels weigh the same, however rare one is.
        weight = np.where(y == 1, n / (2 * ones), n / (2 * (n - ones)))
        return np.concatenate([(z.T @ (z * weight[:, None])).ravel(), z.T @ (weight * y)])

    sums = _sums(rows, size * size + size, normal)
    gram = sums[:size * size].reshape(size, size)
    penalty = np.eye(size) * RIDGE * n
    penalty[-1, -1] = 0
    weights = np.linalg.solve(gram + penalty, sums[size * size:])
    edges = (-0.5, 1.5)

    def binned(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        at = _bin(_features(x, mean, scale) @ weights, edges)
        return np.concatenate([np.bincount(at, y, BINS), np.bincount(at, minlength=BINS)])

    counts = _sums(rows, 2 * BINS, binned)
    return QualityModel(mean, scale, weights, edges, _pooled(counts[:BINS], counts[BINS:]))


def described(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, stats) of each row."""
    return short_batches(docs).select(F.col(doc_id).alias("doc_id"), statistics(F.col(text)).alias("stats"))


def labelled(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """(stats, label) of those rows (doc_id, stats) that ``labels(doc_id, quality)`` marks, outside the held-out fold."""
    marks = labels.where(~held_out("doc_id", FOLDS, FOLD)).where("quality IN (0, 1)")
    marks = marks.select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    stats = stats.where(~held_out("doc_id", FOLDS, FOLD))
    return stats.join(marks, F.col("doc_id") == F.col("id")).select("stats", "label")


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> QualityModel:
    """A model from the documents that ``labels(doc_id, quality)`` marks, outside the held-out fold. A NULL label is
    none; repeated labels and documents count each. Statistics are made before the join with the labels: twenty numbers
    a document are shuffled, not its text."""
    learned = docs.where(~held_out(doc_id, FOLDS, FOLD))
    return fit(labelled(described(learned, doc_id, text), labels))


def score_stats(stats: Column, model: QualityModel) -> Column:
    """The calibrated probability (0 to 1) of label 1, from a text's statistics alone."""

    @pandas_udf("double")
    def of(rows: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.stack(rows.tolist())) if len(rows) else [], dtype="float64")

    return of(stats)


def score(text: Column, model: QualityModel) -> Column:
    """The calibrated probability (0 to 1) that a text has label 1, from the text alone."""
    return score_stats(statistics(text), model)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Stored, as the model is fitted to some of the rows and then scores all: each text is read and described once.
    stats = stage(described(load(spark, sf_dir, "documents")))
    model = fit(labelled(stats, load(spark, sf_dir, "labels")))
    scored = stats.select(
        "doc_id", held_out("doc_id", FOLDS, FOLD).alias("held_out"), score_stats(F.col("stats"), model).alias("score")
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
