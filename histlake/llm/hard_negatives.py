"""Hard-negative mining by angular triangle filtering.

Anchors are a query set of rows.  An anchor's positives are the ``positives``
other rows of its label with the highest integer inner products; for each of
them the first ``negatives`` rows of other labels are returned whose score lies
between ``low`` and ``high`` hundredths of the positive's.

Each row stores its angles to a few reference directions.  By the triangle
inequality the angle between two vectors is at least the largest difference of
their angles to a reference, and at most the smallest of their sums (or of what
the sums leave of a full turn).  The cosines of both, times the norms, bound the
score; the bounds are widened by more than all rounding of the stored angles.
Only rows whose bounds overlap a window get integer scoring:

* positives: the window reaches from the lowest of the best lower bounds upwards;
* negatives: it reaches from the least positive's ``low`` hundredths to the
  greatest positive's ``high``.

Rows are dealt into blocks of ``ROWS`` by label, nearest reference and angle,
anchors into blocks of ``ANCHORS``; blocks carry the ranges of their angles, norms
and labels, and pairs of blocks that cannot meet are dropped before any row is
shipped.  A pair of blocks is a group of bounded size, whatever a label or a
cluster holds.  The directions are fitted on a bounded sample (``SAMPLE`` rows by
hash); they decide how much is filtered, never the result.

Rows with a null label, a null vector or null or non-finite components take no
part.  Shorter vectors count as filled with zeros.  A null id is no anchor and
comes last among ties.  Rows that share an id are rows of their own, and not
"other rows" to each other.  No anchors or no rows: an empty result.  Components so
large that a score might not fit a long are an error.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from histlake.llm import vectors
from histlake.llm.common import cut, joined

#: Reference directions and the rows they are chosen from; rows and anchors of a block.
REFERENCES, SAMPLE, ROWS, ANCHORS = 16, 1024, 1024, 512
#: Radians by which angles are widened: stored as floats (2e-7) from an arccosine
#: that is off by 2e-7 at most near its ends.
SLACK = 1e-5

_NO_ID = np.iinfo(np.int64).max


# --- angles ------------------------------------------------------------------

def directions(rows: DataFrame, width: int) -> np.ndarray:
    """Up to ``REFERENCES`` unit vectors, each as far as can be from those before."""
    some = rows.select(F.xxhash64("id", "v").alias("h"), "id", "v").orderBy("h", "id").limit(SAMPLE).collect()
    x = np.zeros((len(some), width))
    for i, r in enumerate(some):
        x[i, : len(r.v)] = r.v
    norm = np.linalg.norm(x, axis=1)
    x = x[norm > 0] / norm[norm > 0, None]
    if not len(x):
        return np.zeros((0, width))
    chosen, near = [0], x @ x[0]
    while len(chosen) < min(REFERENCES, len(x)):
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    return x[chosen]


def with_angles(rows: DataFrame, width: int) -> DataFrame:
    """Adds norm, angles to the directions, and the nearest direction with its angle."""
    refs = directions(rows, width)
    keep = rows.columns

    def angles(batches):
        for batch in batches:
            x = vectors.matrix(batch.column("v"), width).astype(np.float64)
            norm = np.linalg.norm(x, axis=1)
            cosine = x @ refs.T / np.where(norm > 0, norm, 1)[:, None]
            angle = np.arccos(np.clip(cosine, -1, 1)).astype(np.float32)
            near = angle.argmin(1) if len(refs) else np.zeros(len(x), np.int64)
            at = angle[np.arange(len(x)), near] if len(refs) else np.zeros(len(x), np.float32)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norm), pa.array(list(angle), pa.list_(pa.float32())), pa.array(near.astype(np.int32)), pa.array(at)],
                [*keep, "norm", "angles", "near", "angle"])

    schema = type(rows.schema)(list(rows.schema.fields))
    for name, kind in (("norm", "double"), ("angles", ArrayType(FloatType())), ("near", "integer"), ("angle", "float")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(angles, schema)


def bounds(a: np.ndarray, a_norm: np.ndarray, x: np.ndarray, x_norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score that each row of ``a`` can have with each of ``x``."""
    least, most = np.zeros((len(a), len(x))), np.full((len(a), len(x)), np.pi)
    for r in range(a.shape[1]):
        p, q = a[:, r, None].astype(np.float64), x[None, :, r].astype(np.float64)
        np.maximum(least, np.abs(p - q), out=least)
        both = p + q
        np.minimum(most, np.minimum(both, 2 * np.pi - both), out=most)
    norms = a_norm[:, None] * x_norm[None, :]
    room = 1 + 1e-9 * norms
    low = np.cos(np.minimum(most + SLACK, np.pi)) * norms - room
    high = np.cos(np.maximum(least - SLACK, 0)) * norms + room
    return low, high


def scores(a: np.ndarray, x: np.ndarray, wanted: np.ndarray, a_norm: np.ndarray, x_norm: np.ndarray) -> tuple[np.ndarray, ...]:
    """(anchor, row, score) of the wanted pairs, exactly: in doubles while every partial
    sum is below 2^53 (their norms' product bounds it), else in longs."""
    anchor, row = np.nonzero(wanted)
    kind = np.float64 if float(a_norm.max(initial=0)) * float(x_norm.max(initial=0)) < 2**52 else np.int64
    if len(anchor) * 8 > wanted.size:
        used = wanted.any(0)
        place = np.cumsum(used) - 1
        found = (a.astype(kind) @ x[used].astype(kind).T)[anchor, place[row]]
    else:
        found = np.concatenate([np.zeros(0, kind)] + [np.einsum("ij,ij->i", a[anchor[i:i + 65536]].astype(kind), x[row[i:i + 65536]].astype(kind))
                                                      for i in range(0, len(anchor), 65536)])
    return anchor, row, found.astype(np.int64)


def leading(group: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the first ``k`` of each group: higher scores, then smaller ids."""
    order = np.lexsort((row, ids, -score, group))
    g = group[order]
    start = np.searchsorted(g, g)
    return order[np.arange(len(g)) - start < k]


# --- blocks ------------------------------------------------------------------

def blocked(rows: DataFrame, size: int, name: str) -> DataFrame:
    """Adds ``row``, a number of its own, and the block ``name`` it is in."""
    order = [F.col("label"), F.col("near"), F.col("angle"), F.xxhash64("id", "v"), F.col("id")]
    return vectors.numbered(rows, order, "row").withColumn(name, F.floor(F.col("row") / size))


def summary(rows: DataFrame, block: str, n_refs: int, prefix: str) -> DataFrame:
    """Ranges of labels, norms and angles of each block."""
    edge = lambda f: F.array(*[f(F.col("angles")[r]) for r in range(n_refs)]).cast("array<double>")
    return rows.groupBy(block).agg(
        F.min("label").alias(f"{prefix}_label0"), F.max("label").alias(f"{prefix}_label1"), F.min("norm").alias(f"{prefix}_norm0"),
        F.max("norm").alias(f"{prefix}_norm1"), edge(F.min).alias(f"{prefix}_angle0"), edge(F.max).alias(f"{prefix}_angle1"))


def block_pairs(rows: DataFrame, anchors: DataFrame, n_blocks: int, n_refs: int) -> DataFrame:
    """Every block of rows against every block of anchors, as their ranges."""
    every = rows.withColumn("ab", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
    return joined(every, anchors, "ab", "inner", n_blocks, 200 + 16 * n_refs)


def may_reach(low: Column, high: Column) -> Column:
    """Whether any pair of rows of two blocks can score between ``low`` and ``high``."""
    per = lambda f, *names: F.transform(F.arrays_zip(*[F.col(n) for n in names]), lambda z: f(*[z[n] for n in names]))
    apart = per(lambda a0, a1, b0, b1: F.greatest(a0 - b1, b0 - a1), "a_angle0", "a_angle1", "b_angle0", "b_angle1")
    widest = per(lambda a0, a1, b0, b1: F.least(a1 + b1, F.lit(2 * np.pi) - a0 - b0), "a_angle0", "a_angle1", "b_angle0", "b_angle1")
    least = F.greatest(F.coalesce(F.array_max(apart), F.lit(0.0)) - SLACK, F.lit(0.0))
    most = F.least(F.coalesce(F.array_min(widest), F.lit(np.pi)) + SLACK, F.lit(np.pi))
    small, large = F.col("a_norm0") * F.col("b_norm0"), F.col("a_norm1") * F.col("b_norm1")
    top = F.cos(least) * F.when(F.cos(least) >= 0, large).otherwise(small) + 1 + large * 1e-9
    bottom = F.cos(most) * F.when(F.cos(most) >= 0, small).otherwise(large) - 1 - large * 1e-9
    return (top >= low) & (bottom <= high)


def met(rows: DataFrame, anchors: DataFrame, pairs: DataFrame, fn: Callable[[dict, dict], pa.Table], schema: str) -> DataFrame:
    """``fn`` on every pair of blocks; each pair is a group of its own."""
    pairs = cut(pairs.select("rb", "ab"))
    n, key = pairs.count(), ["rb", "ab"]
    fresh = lambda df: df.toDF(*df.columns)  # noqa: E731  both sides stem from the same rows
    left, right = joined(rows, pairs, "rb", "inner", n, 32), joined(anchors, fresh(pairs), "ab", "inner", n, 32)
    return left.groupBy(*key).cogroup(fresh(right).groupBy(*key)).applyInArrow(fn, schema)


class Side:
    """One side of a pair of blocks, as arrays."""

    def __init__(self, table: pa.Table, width: int, n_refs: int):
        self.v = vectors.matrix(table["v"], width)
        self.angles = vectors.matrix(table["angles"], n_refs, np.float32)
        self.norm, self.row = table["norm"].to_numpy(), table["row"].to_numpy()
        self.known = ~np.asarray(table["id"].is_null())
        self.id = table["id"].fill_null(_NO_ID).to_numpy()
        self.label = np.asarray(table["label"].to_pylist())


def mine(docs: DataFrame, id_col: str, vector: str, label: str, is_anchor: Column, scale: int = 256, positives: int = 5,
         negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).
    ``is_anchor``: a condition on the column ``id``."""
    rows = docs.filter(vectors.complete(vector) & F.col(label).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(label).alias("label"), vectors.scaled(vector, scale).alias("v"))
    rows = cut(rows)
    width, most = rows.agg(F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("decimal(20,0)")))))).first()
    width = width or 0
    if width * int(most or 0) ** 2 * max(low, high, 100) >= 1 << 63:
        raise ValueError(f"components up to {most} are too large for exact 64-bit scores")
    rows = with_angles(rows, width)
    base = cut(blocked(rows, ROWS, "rb"))
    n_refs = base.select(F.max(F.size("angles"))).first()[0] or 0
    anchors = cut(blocked(base.drop("row", "rb").filter(F.col("id").isNotNull() & is_anchor), ANCHORS, "ab"))
    n_blocks = -(-anchors.count() // ANCHORS)
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_blocks:
        return docs.sparkSession.createDataFrame([], empty)
    ranges, anchor_ranges = cut(summary(base, "rb", n_refs, "b")), cut(summary(anchors, "ab", n_refs, "a"))

    def best_positives(left: pa.Table, right: pa.Table) -> pa.Table:
        x, a = Side(left, width, n_refs), Side(right, width, n_refs)
        wanted = (a.label[:, None] == x.label[None, :]) & (a.id[:, None] != x.id[None, :])
        lower, upper = bounds(a.angles, a.norm, x.angles, x.norm)
        if x.v.shape[0] > positives:
            floor = np.partition(np.where(wanted, lower, -np.inf), -positives, axis=1)[:, -positives]
            wanted &= upper >= floor[:, None]
        anchor, row, score = scores(a.v, x.v, wanted, a.norm, x.norm)
        top = leading(anchor, score, x.id[row], x.row[row], positives)
        anchor, row = anchor[top], row[top]
        return pa.table({"anchor": a.row[anchor], "row": x.row[row], "id": pa.array(x.id[row], mask=~x.known[row]), "score": score[top]})

    sharing = (F.col("a_label0") <= F.col("b_label1")) & (F.col("b_label0") <= F.col("a_label1"))
    pairs = block_pairs(ranges, anchor_ranges, n_blocks, n_refs)
    found = met(base, anchors, pairs.filter(sharing), best_positives, "anchor long, row long, id long, score long")
    by_score = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    nth = F.row_number().over(Window.partitionBy("anchor").orderBy(*by_score))
    chosen = found.withColumn("nth", nth).filter(F.col("nth") <= positives).groupBy(F.col("anchor").alias("row")).agg(
        F.array_sort(F.collect_list(F.struct("nth", "id", "score"))).alias("p"))
    # a positive below zero has an empty window
    chosen = cut(anchors.join(chosen, "row").withColumn("p", F.filter("p", lambda p: p["score"] >= 0)).filter(F.size("p") > 0))
    window = chosen.groupBy("ab").agg((F.min(F.array_min(F.col("p.score"))) * (low / 100) - 1).alias("low"),
                                      (F.max(F.array_max(F.col("p.score"))) * (high / 100) + 1).alias("high"))

    def best_negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        x, a = Side(left, width, n_refs), Side(right, width, n_refs)
        lists = [sorted((p["nth"], p["id"], p["score"]) for p in ps) for ps in right["p"].to_pylist()]
        value = np.array([[p[2] for p in ps] + [-1] * (positives - len(ps)) for ps in lists], np.int64)
        lower, upper = bounds(a.angles, a.norm, x.angles, x.norm)
        least = np.where(value >= 0, value, np.iinfo(np.int64).max // 200).min(1) * low / 100
        wanted = (a.label[:, None] != x.label[None, :]) & (upper >= least[:, None]) & (lower <= value.max(1)[:, None] * high / 100)
        anchor, row, score = scores(a.v, x.v, wanted, a.norm, x.norm)
        parts = []
        for k in range(positives):
            p = value[anchor, k]
            inside = np.flatnonzero((p >= 0) & (low * p <= 100 * score) & (100 * score <= high * p))
            top = inside[leading(anchor[inside], score[inside], x.id[row[inside]], x.row[row[inside]], negatives)]
            an, ro = anchor[top], row[top]
            parts.append(pa.table({
                "anchor": a.row[an], "nth": np.full(len(top), k, np.int32), "anchor_id": a.id[an],
                "positive_id": pa.array([lists[i][k][1] for i in an], pa.int64()), "positive_score": value[an, k],
                "id": pa.array(x.id[ro], mask=~x.known[ro]), "row": x.row[ro], "score": score[top]}))
        return pa.concat_tables(parts)

    differing = ~((F.col("a_label0") == F.col("a_label1")) & (F.col("b_label0") == F.col("b_label1")) & (F.col("a_label0") == F.col("b_label0")))
    pairs = joined(pairs, window, "ab", "inner", n_blocks, 64).filter(differing & may_reach(F.col("low"), F.col("high")))
    found = met(base, chosen, pairs, best_negatives, "anchor long, nth int, anchor_id long, positive_id long, positive_score long, id long, row long, score long")
    rank = F.row_number().over(Window.partitionBy("anchor", "nth").orderBy(*by_score))
    return found.withColumn("rank", rank).filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


#: The same in SQL (DuckDB), for vectors of equal length and single ids.
ORACLE = """
WITH v AS MATERIALIZED (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, r.vec_id AS id, r.label, CAST(list_inner_product(a.q, r.q) AS BIGINT) AS score
  FROM v a JOIN v r ON r.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS nth FROM s WHERE label = anchor_label),
n AS (SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.anchor_label AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score WHERE nth <= 5)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
