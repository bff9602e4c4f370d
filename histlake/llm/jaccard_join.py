"""N-gram Jaccard self-join by chosen paths.

Documents are sets of five-word shingles.  Equal sets are one class with a
count.  Each set is embedded by ``T`` MinHash values, the tokens that paths are
chosen by: a tree node samples one or two of the ``T`` positions (1 / lambda on
average) and sends every set to the child named by its value there.  Buckets of
at most ``LEAF`` sets are compared by brute force on sketches; larger ones are
split again, for ``DEPTH`` levels.  A pair at the threshold survives a level
with a probability that ``survival`` gives, and the trees are grown as often as
the target recall asks.  What still is large at the last level (sets nearly
alike) is compared in blocks, in full.

Sketch matches only say which sets may be linked.  Connected groups of them are
then compared exactly, on whole shingle sets, in blocks of bounded size; tasks
give back sums and forests, never pairs.  Blocks of what needs several are dealt
one by one, smaller buckets and groups many together: what a task holds at a
time does not grow with a group of near copies.

Free style: numpy inside tasks; Spark deals the buckets and groups.

Null or empty texts (no word) have no shingle, are linked to nothing and are
classes of their own.  Fewer than five words: one shingle of all of them.  Rows
with equal ids and other texts are told apart; ids may be null.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import cut, joined

SHINGLE, SIMILARITY, RECALL = 5, 0.8, 0.999

#: MinHash values of a set, sets of a leaf, levels of a tree, and sets of a
#: block of the exact comparison.
T, LEAF, DEPTH, BLOCK = 64, 256, 4, 256

#: Share of equal sketch bytes from which a pair is compared exactly; at
#: similarity 0.8 fewer are equal once in 40,000 pairs.
SKETCH = 0.6

_WORD = re.compile(r"[^\W_]+")
_rng = np.random.default_rng(20240)
_A = _rng.integers(1, 1 << 63, T, np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 1 << 63, T, np.uint64)
_P = _rng.integers(1, 1 << 63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Hashes of the words met lately."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def shingle_set(text: str | None, cache: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    words = _WORD.findall((text or "").lower())
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    n = max(1, len(h) - SHINGLE + 1)
    k = min(SHINGLE, len(h))
    total = np.full(n, k, np.uint64)
    for j in range(k):
        total += h[j:j + n] * _P[j]
    return np.unique(mix(total))


def min_hashes(s: np.ndarray) -> np.ndarray:
    """The ``T`` MinHash values of a set."""
    best = np.full(T, np.iinfo(np.uint64).max)
    for at in range(0, len(s), 2048):
        best = np.minimum(best, (s[at:at + 2048, None] * _A + _B).min(0))
    return (best >> np.uint64(32)).astype(np.uint32)


def survival(similarity: float, depth: int) -> float:
    """Chance that one tree of ``depth`` levels brings a pair into one leaf: each
    node has one child, or two with chance 1 / similarity - 1."""
    two, s = 1 / similarity - 1, 1.0
    for _ in range(depth):
        s = (1 - two) * similarity * s + two * (1 - (1 - similarity * s) ** 2)
    return s


def runs_for(similarity: float, recall: float, depth: int) -> int:
    return math.ceil(math.log(1 - recall) / math.log(1 - survival(similarity, depth)))


def embedded(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, c, mh) of each row: c names the set (null: none)."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for b in batches:
            names, hashes = [], []
            for t in b.column(2):
                s = shingle_set(t.as_py(), cache)
                names.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                hashes.append(min_hashes(s).tobytes() if len(s) else None)
            yield pa.record_batch([b.column(0), b.column(1), pa.array(names, pa.binary()), pa.array(hashes, pa.binary())],
                                  names=["id", "key", "c", "mh"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, key long, c binary, mh binary")


def children(nodes: DataFrame, similarity: float, roots: int = 0) -> DataFrame:
    """(node, c, mh) to the (node, c, sketch) of its child nodes; with ``roots``
    every row of (c, mh) starts in that many trees.  A sketch is a byte of each value.

    A node samples the same positions for all its sets: one, or two with chance
    1 / similarity - 1."""
    two = np.uint64(int((1 / similarity - 1) * 2**64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c, mh = b.column("c"), b.column("mh")
            values = np.frombuffer(b"".join(mh.to_pylist()), np.uint32).reshape(-1, T)
            sketch = pa.array([x.tobytes() for x in values.astype(np.uint8)], pa.binary())
            if roots:
                here = [mix(np.full(len(c), r + 1, np.uint64)) for r in range(roots)]
            else:
                here = [b.column("node").to_numpy().view(np.uint64)]
            for node in here:
                first = mix(node ^ np.uint64(0x9E3779B97F4A7C15)) % np.uint64(T)
                second = (first + np.uint64(1) + mix(node ^ np.uint64(0xD1B54A32D192ED03)) % np.uint64(T - 1)) % np.uint64(T)
                for place, on in ((first, np.ones(len(node), bool)), (second, mix(node ^ np.uint64(0x8CB92BA72F3D8DD7)) < two)):
                    i = np.flatnonzero(on)
                    p = place[i].astype(np.int64)
                    to = mix(node[i] + mix((p.astype(np.uint64) << np.uint64(32)) | values[i, p].astype(np.uint64)))
                    yield pa.record_batch([pa.array(to.view(np.int64)), c.take(pa.array(i)), sketch.take(pa.array(i))],
                                          names=["node", "c", "sketch"])

    return nodes.mapInArrow(run, "node long, c binary, sketch binary")


def forest(alike: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each row of a symmetric matrix."""
    label = np.arange(len(alike))
    while True:
        low = np.where(alike, label[None, :], len(alike)).min(1, initial=len(alike))
        new = np.minimum(label, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def sketch_links(leaves: DataFrame, groups: int) -> DataFrame:
    """(a, b): links of a forest over the sets of each block whose sketches match.
    ``leaves``: (node, chunks, i, j, c, sketch), one block for each (node, i, j); in
    a block of two chunks all its sets are compared."""
    def of(part: pa.Table) -> pa.Table:
        c = part["c"].to_pylist()
        sketch = np.frombuffer(b"".join(part["sketch"].to_pylist()), np.uint8).reshape(-1, T)
        cells = np.stack([part[x].to_numpy() for x in ("node", "i", "j")])
        order = np.lexsort(cells)
        cells = cells[:, order]
        edges = np.flatnonzero(np.r_[True, (cells[:, 1:] != cells[:, :-1]).any(0), True])
        a, b = [], []
        for lo, hi in zip(edges[:-1], edges[1:]):
            if hi - lo < 2:
                continue
            at = order[lo:hi]
            s = sketch[at]
            if hi - lo == 2:
                if (s[0] == s[1]).sum() >= SKETCH * T:
                    a.append(c[at[0]])
                    b.append(c[at[1]])
                continue
            same = np.zeros((hi - lo, hi - lo), np.uint8)
            for k in range(T):
                same += s[:, k, None] == s[None, :, k]
            label = forest(same >= SKETCH * T)
            for k in np.flatnonzero(label != np.arange(hi - lo)):
                a.append(c[at[label[k]]])
                b.append(c[at[k]])
        return pa.table([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    return leaves.withColumn("group", dealt("node", groups)).drop("chunks").groupBy("group") \
        .applyInArrow(of, "a binary, b binary")


def blocks(n: str, chunk: str) -> F.Column:
    """(i, j) of the blocks of two chunks, out of ``n``, that ``chunk`` is in."""
    return F.transform(F.sequence(F.lit(0), F.col(n) - 1),
                       lambda o: F.struct(F.least(F.col(chunk), o).alias("i"), F.greatest(F.col(chunk), o).alias("j")))


def dealt(of: str, groups: int) -> F.Column:
    """Group that a block's rows go to: one of its own if ``of`` has several chunks,
    as these make k / 256 rows of each of k sets; else one of ``groups``."""
    return F.when(F.col("chunks") > 1, F.xxhash64(of, "i", "j")).otherwise(F.pmod(F.xxhash64(of), F.lit(groups)))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of the connected components of (a, b): alternating stars, each
    round a minimum per node and a join; stops when no edge changes.  The minima
    are written first: the join is then one of two plain shuffles, which Spark
    splits where one node has very many edges."""
    edges = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(rounds):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = cut(both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low")))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = cut(large)
        small_low = cut(large.groupBy("a").agg(F.min("b").alias("low")))
        small = large.join(small_low, "a").select(
            F.explode(F.array(F.struct("a", F.col("low").alias("b")), F.struct(F.col("b").alias("a"), F.col("low").alias("b")))).alias("e")) \
            .select("e.*").filter("a <> b").distinct()
        edges = cut(small)
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    root = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return root.union(root.select(F.col("root").alias("node"), "root").distinct())


def link_counts(sets: DataFrame, similarity: float, groups: int) -> DataFrame:
    """(c, root, links, texts) of each set and block: documents and sets linked to
    it in the block, and the smallest set that it reaches there.
    ``sets``: (comp, chunks, i, j, chunk, c, copies, s), s the whole shingle set."""
    def of(part: pa.Table) -> pa.Table:
        comp, c = part["comp"].to_pylist(), part["c"].to_pylist()
        i, j, chunk, copies = (part[x].to_numpy() for x in ("i", "j", "chunk", "copies"))
        blobs = part["s"]
        cells: dict[tuple, list[int]] = {}
        for k in range(len(c)):
            cells.setdefault((comp[k], i[k], j[k]), []).append(k)
        out: list[tuple] = []
        for (_, ci, cj), at in cells.items():
            at = np.array([k for _, k in sorted({c[k]: k for k in at}.items())])  # repeated rows once
            alike = similar([np.frombuffer(blobs[int(k)].as_py(), np.uint64) for k in at], similarity)
            if ci != cj:  # pairs within a chunk have a block of their own
                alike &= chunk[at][:, None] != chunk[at][None, :]
            label = forest(alike)
            links, texts = alike @ copies[at], alike.sum(1)
            out += [(c[k], c[at[r]], int(x), int(y)) for k, r, x, y in zip(at, label, links, texts)]
        cols = list(zip(*out)) if out else [[], [], [], []]
        return pa.table([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64()),
                         pa.array(cols[3], pa.int64())], names=["c", "root", "links", "texts"])

    return sets.withColumn("group", dealt("comp", groups)).drop("chunks").groupBy("group") \
        .applyInArrow(of, "c binary, root binary, links long, texts long")


def similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Which pairs of sets have that Jaccard similarity; the diagonal is False."""
    n = np.array([len(s) for s in sets], float)
    if len(sets) <= 6:
        shared = np.zeros((len(sets), len(sets)))
        for x in range(len(sets)):
            for y in range(x):
                if min(n[x], n[y]) >= similarity * max(n[x], n[y]) - 1e-9:
                    shared[x, y] = shared[y, x] = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
    else:
        owner = np.repeat(np.arange(len(sets)), n.astype(int))
        _, col, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        held = times[col] > 1
        owner, col = owner[held], col[held]
        _, col = np.unique(col, return_inverse=True)
        order = np.argsort(col, kind="stable")
        owner, col = owner[order], col[order]
        shared = np.zeros((len(sets), len(sets)), np.float32)
        width = int(col[-1]) + 1 if len(col) else 0
        for at in range(0, width, 8192):
            lo, hi = np.searchsorted(col, [at, at + 8192])
            m = np.zeros((len(sets), min(8192, width - at)), np.float32)
            m[owner[lo:hi], col[lo:hi] - at] = 1
            shared += m @ m.T
    union = n[:, None] + n[None, :] - shared
    alike = shared >= similarity * union - 1e-6
    np.fill_diagonal(alike, False)
    return alike


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                 recall: float = RECALL) -> DataFrame:
    """(id, key, class_key, class_id, n_links, n_text_links, n_copies) of each row.

    class_key names the class also where ids are null or repeated; class_id is
    the smallest id of the documents reached by links.  n_links: other
    documents of that similarity, copies included; n_text_links: other sets."""
    rows = cut(embedded(docs, id_col, text_col))
    classes = cut(rows.filter("c is not null").groupBy("c").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first"), F.count("*").alias("copies"), F.first("mh").alias("mh")))
    # grow the trees level by level; leaves are what is small enough
    level = children(classes.select("c", "mh"), similarity, runs_for(similarity, recall, DEPTH))
    leaves = []
    for depth in range(1, DEPTH + 1):
        sizes = cut(level.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1"))
        leaves.append(level.join(sizes if depth == DEPTH else sizes.filter(F.col("n") <= LEAF), "node"))
        large = sizes.filter(F.col("n") > LEAF).select("node")
        n_large = large.count()
        if not n_large or depth == DEPTH:
            break
        crowded = joined(level.select("node", "c"), large, "node", "left_semi", n_large, 16)
        level = cut(children(crowded.join(classes.select("c", "mh"), "c").select("node", "c", "mh"), similarity))  # read three times
    all_leaves = leaves[0]
    for more in leaves[1:]:
        all_leaves = all_leaves.union(more)
    all_leaves = all_leaves.withColumn("chunks", F.ceil(F.col("n") / LEAF).cast("int")) \
        .withColumn("chunk", F.pmod(F.xxhash64("c", "node"), F.col("chunks")).cast("int")) \
        .withColumn("b", F.explode(blocks("chunks", "chunk"))).select("node", "chunks", "b.i", "b.j", "c", "sketch")
    n_rows = classes.count()
    links = cut(sketch_links(all_leaves, max(1, n_rows // 512)).distinct())
    comps = cut(components(links)).withColumnRenamed("node", "c").withColumnRenamed("root", "comp")
    # compare the sets of each connected group exactly
    sized = comps.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"))
    members = cut(comps.join(sized, "comp").join(classes.drop("mh"), "c").select(
        "comp", "c", "copies", F.col("first.key").alias("key"), "chunks", F.pmod(F.xxhash64("c"), F.col("chunks")).cast("int").alias("chunk")))
    n_members = members.count()
    found = cut(link_counts(whole_sets(docs, members, n_members, id_col, text_col), similarity, max(1, n_members // 128)))
    roots = cut(components(found.select(F.col("c").alias("a"), F.col("root").alias("b")))).withColumnRenamed("node", "c")
    per_class = classes.select("c", F.col("first.id").alias("first"), "copies").join(
        found.groupBy("c").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts")), "c", "left").join(roots, "c", "left")
    per_class = cut(per_class.withColumn("root", F.coalesce("root", "c")))
    ids = per_class.groupBy("root").agg(F.min("first").alias("class_id"))
    per_class = per_class.join(ids, "root").select(
        "c", F.hex("root").alias("class_key"), "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"), F.col("copies").alias("n_copies"))
    return rows.select("id", "key", "c").join(per_class, "c", "left").select(
        "id", "key", F.coalesce("class_key", F.concat(F.lit("row "), F.col("key").cast("string"))).alias("class_key"),
        F.coalesce("class_id", "id").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("n_text_links", F.lit(0)).alias("n_text_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def whole_sets(docs: DataFrame, members: DataFrame, n_members: int, id_col: str, text_col: str) -> DataFrame:
    """(comp, chunks, i, j, chunk, c, copies, s): the whole set of each member, once for each block it is in."""
    rows = docs.select(F.xxhash64(id_col, text_col).alias("key"), F.col(text_col).alias("text"))
    held = joined(rows, members, "key", "inner", n_members, 96).select("comp", "c", "copies", "chunks", "chunk", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for part in (b.slice(at, 256) for b in batches for at in range(0, b.num_rows, 256)):
            sets = pa.array([shingle_set(t.as_py(), cache).tobytes() for t in part.column(5)], pa.binary())
            yield pa.record_batch([*part.columns[:5], sets], names=["comp", "c", "copies", "chunks", "chunk", "s"])

    return held.mapInArrow(run, "comp binary, c binary, copies long, chunks int, chunk int, s binary") \
        .withColumn("b", F.explode(blocks("chunks", "chunk"))).select("comp", "chunks", "b.i", "b.j", "chunk", "c", "copies", "s")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one document of each class: the one of smallest id, null last."""
    found = cut(jaccard_join(docs, id_col, text_col, similarity))
    kept = found.groupBy("class_key").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "key")).alias("first")).select("first.key")
    going = cut(found.select("key").distinct().join(kept, "key", "left_anti"))
    key = F.xxhash64(id_col, text_col)
    out = joined(docs.withColumn("__key", key), going.withColumnRenamed("key", "__key"), "__key", "left_anti", going.count(), 16)
    repeated = found.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").limit(1).count()
    return (out.dropDuplicates(["__key"]) if repeated else out).drop("__key")
