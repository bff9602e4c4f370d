"""Language identification by nearest centroid.

A text becomes a normalised TF-IDF vector of hashed character n-grams (1 to 3
letters, everything that is no letter read as one space).  Each language has a
few centroids, found by spherical k-means; the nearest by cosine gives the
language.  A text farther from its centroid than that centroid's own documents
ever are, by a wide margin, is rejected.

Document frequencies count all rows with a language that the caller allows.
Only the centroids are fitted on a bounded sample: ``SAMPLE`` rows per language.

Null texts and texts without a letter: ``und``, score 0, rejected.  Null
languages teach nothing.  Repeated rows are predicted each on its own.  With
nothing to learn from, every text is ``und`` and rejected.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Dimensions of the hashed n-gram space, centroids per language, rounds of
#: k-means, and rows per language of the sample that the centroids are fitted on.
DIMS, CENTROIDS, ROUNDS, SAMPLE = 4096, 3, 8, 1000

#: Samples' worth of rows that a hash picks before the sample is taken by order.
OVERSAMPLE = 2

#: A centroid rejects what is less similar to it than this share of the least
#: similar of its own sample's texts (at their 1 % quantile).  Few n-grams say
#: little about distance: below ``FULL`` of them the threshold falls in proportion.
LEAST, FULL = 0.5, 600

UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")  # letters alone: numeric signs such as ½ or ① are none
_GAP = re.compile(r"[\W\d_]+")
_MULTIPLY = [np.uint32(2654435761), np.uint32(2246822519), np.uint32(3266489917)]


def counts_of(text: str | None) -> np.ndarray | None:
    """Hashed n-gram counts of a whole text; None without a letter."""
    if not text or not _LETTER.search(text):
        return None
    codes = np.frombuffer((" " + _GAP.sub(" ", text.lower()).strip() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    h = codes * _MULTIPLY[0]
    total = np.bincount(h >> np.uint32(20), minlength=DIMS)
    for n in (1, 2):
        h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * _MULTIPLY[n] + codes[n:] * _MULTIPLY[0]
        total += np.bincount(h >> np.uint32(20), minlength=DIMS)
    return total


def vectors(counts: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Unit TF-IDF vectors."""
    x = np.log1p(np.array(counts, np.float32)) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def document_frequencies(rows: DataFrame) -> tuple[dict[str, int], np.ndarray]:
    """Texts with a letter per language, and texts with each n-gram; over all rows
    of (text, lang)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, langs = np.zeros(DIMS, np.int64), Counter()
        for b in batches:
            for t, lang in zip(b.column(0), b.column(1).to_pylist()):
                c = counts_of(t.as_py())
                if c is not None:
                    df += c > 0
                    langs[lang] += 1
        dims = np.flatnonzero(df)
        yield pa.record_batch([pa.array([*dims, *[-1] * len(langs)], pa.int64()), pa.array([*[None] * len(dims), *langs], pa.string()),
                               pa.array([*df[dims], *langs.values()], pa.int64())], names=["dim", "lang", "n"])

    out, counts = np.zeros(DIMS, np.int64), {}
    # DIMS rows, and one per language
    for r in rows.mapInArrow(run, "dim long, lang string, n long").groupBy("dim", "lang").agg(F.sum("n").alias("n")).collect():
        if r.dim < 0:
            counts[r.lang] = r.n
        else:
            out[r.dim] = r.n
    return counts, out


def spherical_kmeans(x: np.ndarray, k: int, rounds: int) -> np.ndarray:
    """Unit centroids; starts from rows that are far from each other."""
    mean = x.mean(0)
    centers = [x[np.argmax(x @ mean)]]
    while len(centers) < min(k, len(x)):
        centers.append(x[np.argmin((x @ np.array(centers).T).max(1))])
    centers = np.array(centers)
    for _ in range(rounds):
        near = (x @ centers.T).argmax(1)
        for c in range(len(centers)):
            if (near == c).any():
                m = x[near == c].mean(0)
                centers[c] = m / max(np.linalg.norm(m), 1e-9)
    return centers


@dataclass
class Model:
    idf: np.ndarray
    langs: list[str]
    centroids: np.ndarray
    least: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score (cosine, 0 to 1) and rejection of each text."""
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        rejected = np.ones(len(texts), bool)
        if not self.langs:
            return langs, scores, rejected
        for at in range(0, len(texts), 256):  # counts of this many texts at a time
            part = [(i, c) for i, t in enumerate(texts[at:at + 256], at) if (c := counts_of(t)) is not None]
            if not part:
                continue
            near = vectors([c for _, c in part], self.idf) @ self.centroids.T
            for (i, c), b, cosine in zip(part, near.argmax(1), near.max(1)):
                langs[i] = self.langs[b]
                scores[i] = min(1.0, max(0.0, float(cosine)))
                rejected[i] = cosine < self.least[b] * min(1.0, c.sum() / FULL)
        return langs, scores, rejected


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Model from the given rows; the caller leaves out what must not be learned from."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")) \
        .filter("lang is not null and text is not null")
    counts, df = document_frequencies(rows.select("text", "lang"))
    if not counts:
        return Model(np.ones(DIMS, np.float32), [], np.zeros((0, DIMS), np.float32), np.zeros(0))
    idf = np.log((1 + sum(counts.values())) / (1 + df)).astype(np.float32) + 1
    # a hashed share of each language's rows, several samples large at any size, then the sample
    share = docs.sparkSession.createDataFrame([(k, min(1.0, OVERSAMPLE * sample / n)) for k, n in sorted(counts.items())], "lang string, share double")
    place = F.xxhash64("id", "text")
    some = rows.join(F.broadcast(share), "lang").filter(F.pmod(place, F.lit(1 << 32)) < F.col("share") * 2.0**32)
    taken = some.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy(place, "id"))).filter(F.col("nth") <= sample)

    def centers(key: tuple[pa.Scalar, ...], part: pa.Table) -> pa.Table:  # SAMPLE rows at most
        counts = [c for t in part["text"] if (c := counts_of(t.as_py())) is not None]
        rows = []
        if counts:
            x = vectors(counts, idf)
            c = spherical_kmeans(x, CENTROIDS, ROUNDS)
            near = x @ c.T
            for k in range(len(c)):
                own = near[near.argmax(1) == k, k]
                if len(own):
                    rows.append({"lang": key[0].as_py(), "centroid": c[k].tolist(), "least": LEAST * float(np.quantile(own, 0.01))})
        return pa.Table.from_pylist(rows, pa.schema([("lang", pa.string()), ("centroid", pa.list_(pa.float32())), ("least", pa.float64())]))

    found = taken.select("lang", "text", "nth").groupBy("lang").applyInArrow(
        centers, "lang string, centroid array<float>, least double").collect()  # CENTROIDS rows per language
    found.sort(key=lambda r: (r.lang, r.centroid))
    return Model(idf, [r.lang for r in found], np.array([r.centroid for r in found], np.float32).reshape(-1, DIMS),
                 np.array([r.least for r in found]))


def predict(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_id`` = (lang_pred, score, rejected) of each row's text."""
    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def of(texts: pd.Series) -> pd.DataFrame:
        langs, scores, rejected = model.predict(list(texts))
        return pd.DataFrame({"lang_pred": langs, "score": scores, "rejected": rejected})

    return docs.withColumn("lang_id", of(F.col(text_col)))
