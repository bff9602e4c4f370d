"""Quality classifier: regularised quadratic discriminant over text statistics.

Each text gives nine transformed statistics, smoothed by the corpus's ratios.  The two classes are Gaussians
whose covariances are shrunk to the pooled one and to a scaled identity; a score
is the logistic of prior and Mahalanobis log-density differences, computed with
Cholesky factors that are factored once and shipped with the task.

All labelled rows count: means and covariances come from sums that Spark adds up
per class, so the fit moves a few hundred numbers to the driver at any size.

Null or empty texts have all statistics 0 and get a score like any other.  A
document with several labels counts once per label; null labels and ids don't
count.  With one class only, the score is that class; with no label it is 1.
Repeated rows are scored each on its own.  Own columns replace columns of the
same name.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEATURES = ["word_length", "upper", "symbols", "marks", "digits", "distinct", "repeats", "top_word", "line_words"]
COUNTS = ["words", "chars", "letters", "upper", "symbols", "marks", "digits", "distinct", "repeats", "top", "lines"]

#: Strength of the corpus's ratios in a text's: a short text stays near them.
PRIOR = 30.0

#: Shares of the pooled covariance and of the scaled identity in a class's covariance.
TO_POOLED, TO_IDENTITY = 0.1, 0.02

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGITS = np.zeros(256, bool)
_DIGITS[48:58] = True
_MARKS = np.zeros(256, bool)
_MARKS[[ord(c) for c in "!?"]] = True
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#$%&*+/<=>@[\\]^_`{|}~"]] = True


def counts_of(text: str | None) -> list[int]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    words = (text or "").split()
    if not words:
        return [0] * len(COUNTS)
    n = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    chars = n[:128].sum() + n[192:].sum() - n[32] - n[9:14].sum()  # a lead byte per character
    seen = Counter(words)
    return [len(words), int(chars), int(n[_LETTERS].sum()), int(n[_UPPER].sum()), int(n[_SYMBOLS].sum()), int(n[_MARKS].sum()),
            int(n[_DIGITS].sum()), len(seen), sum(map(eq, words, words[1:])), max(seen.values()), 1 + int(n[10])]


def statistics(counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Transformed statistics of rows of counts; ``sums``: the corpus's."""
    words, chars, letters, upper, symbols, marks, digits, distinct, repeats, top, lines = np.asarray(counts, float).T
    s = dict(zip(COUNTS, sums))

    def ratio(part, whole, name, base):
        return (part + PRIOR * s[name] / max(s[base], 1)) / (whole + PRIOR)

    def share(*a):  # variance-stabilised
        return np.arcsin(np.sqrt(np.clip(ratio(*a), 0, 1)))

    return np.stack([
        np.log(np.maximum(ratio(chars, words, "chars", "words"), 1e-9)), share(upper, letters, "upper", "letters"),
        share(symbols, chars, "symbols", "chars"), share(marks, chars, "marks", "chars"), share(digits, chars, "digits", "chars"),
        np.log(distinct + PRIOR) / np.log(words + PRIOR), share(repeats, words, "repeats", "words"),
        share(top, words, "top", "words"), np.log1p(words / (lines + words / PRIOR + 1)),
    ], 1)


def with_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n): every row's id and its counts."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.record_batch([b.column(0), pa.array([counts_of(t.as_py()) for t in b.column(1)],
                                                         pa.list_(pa.int64()))], names=["id", "n"])

    return rows.mapInArrow(run, f"id {rows.schema[0].dataType.simpleString()}, n array<long>")


def corpus_sums(counts: DataFrame) -> np.ndarray:
    """Sum of each count over all rows."""
    row = counts.agg(*[F.sum(F.col("n")[i]) for i in range(len(COUNTS))]).first()
    return np.array([x or 0 for x in row], float)


def with_statistics(counts: DataFrame, sums: np.ndarray) -> DataFrame:
    """(id, x): every row's statistics."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = statistics(b.column(1).flatten().to_numpy().reshape(-1, len(COUNTS)), sums)
            yield pa.record_batch([b.column(0), pa.array(x.tolist(), pa.list_(pa.float64()))], names=["id", "x"])

    return counts.select("id", "n").mapInArrow(run, f"id {counts.schema['id'].dataType.simpleString()}, x array<double>")


@dataclass
class Model:
    sums: np.ndarray  # the corpus's counts
    priors: np.ndarray
    means: np.ndarray
    factors: np.ndarray  # inverses of the Cholesky factors
    log_dets: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 of each row."""
        if len(self.means) < 2:
            return np.full(len(x), self.priors[0])
        logs = []
        for prior, mean, factor, log_det in zip(self.priors, self.means, self.factors, self.log_dets):
            z = (x - mean) @ factor.T
            logs.append(math.log(prior) - 0.5 * (log_det + (z * z).sum(1)))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))


def fit(counts: DataFrame, sums: np.ndarray, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Model:
    """Model from all rows of ``counts`` (id, n) that ``labels`` marks 0 or 1."""
    d = len(FEATURES)
    stats = with_statistics(counts, sums)
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).filter("id is not null and y in (0, 1)")
    pairs = [(i, j) for i in range(d) for j in range(i + 1)]
    x = F.col("x")
    groups = stats.join(marks, "id").groupBy("y").agg(
        F.count("*").alias("n"), *[F.sum(x[i]).alias(f"s{i}") for i in range(d)],
        *[F.sum(x[i] * x[j]).alias(f"s{i}_{j}") for i, j in pairs]).orderBy("y").collect()  # two rows at most
    if len(groups) < 2:
        return Model(sums, np.array([float(groups[0].y) if groups else 1.0]), np.zeros((1, d)), np.zeros((1, d, d)), np.zeros(1))
    n = np.array([r.n for r in groups], float)
    means = np.array([[r[f"s{i}"] for i in range(d)] for r in groups]) / n[:, None]
    scatter = np.zeros((2, d, d))
    for c, r in enumerate(groups):
        for i, j in pairs:
            scatter[c, i, j] = scatter[c, j, i] = r[f"s{i}_{j}"] - n[c] * means[c, i] * means[c, j]
    pooled = scatter.sum(0) / n.sum() + np.diag(np.full(d, 1e-9))
    scale = np.sqrt(np.diag(pooled))
    covariances = []
    for c in range(2):
        cov = (1 - TO_POOLED) * scatter[c] / n[c] + TO_POOLED * pooled
        unit = cov / np.outer(scale, scale)
        covariances.append(((1 - TO_IDENTITY) * unit + TO_IDENTITY * np.trace(unit) / d * np.eye(d)) * np.outer(scale, scale))
    lower = np.linalg.cholesky(np.array(covariances))
    return Model(sums, n / n.sum(), means, np.linalg.inv(lower), 2 * np.log(np.diagonal(lower, axis1=1, axis2=2)).sum(1))


def score(counts: DataFrame, model: Model) -> DataFrame:
    """(id, score) of each row of ``counts``; the factors go out with the task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(1).flatten().to_numpy().reshape(-1, len(COUNTS))
            yield pa.record_batch([b.column(0), pa.array(model.score(statistics(n, model.sums)))], names=["id", "score"])

    return counts.select("id", "n").mapInArrow(run, f"id {counts.schema['id'].dataType.simpleString()}, score double")


def score_text(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of each row's text, in one pass without a shuffle."""
    @F.pandas_udf("double")
    def of(texts: pd.Series) -> pd.Series:
        n = np.array([counts_of(t) for t in texts], float).reshape(-1, len(COUNTS))
        return pd.Series(model.score(statistics(n, model.sums)))

    return docs.withColumn(out, of(F.col(text_col)))
