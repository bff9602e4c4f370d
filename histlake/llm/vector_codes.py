"""Vector code compression: product codes with an exact integer search.

Vectors become integers, floor(scale * x), and are cut into equal parts.  Every
part position has a codebook that starts as the parts of the first rows by id;
a round assigns every part to its nearest entry and moves each entry to the
floor of its parts' mean.

The search works on Walsh-Hadamard transforms of the zero-padded parts and
entries.  With D coefficients the squared differences of two transforms add up
to D times the squared distance, and their partial sums never fall, so
coefficients are added in sequency order (slow sign changes first) and an entry
goes as soon as its partial sum exceeds the full sum of the entry that was best
after the first coefficients.  Everything is integer arithmetic: equal sums stay
and the lowest index wins, exactly.

A round is one pass over the rows: tasks add up their parts by entry, Spark adds
up the tasks' sums, and only the codebooks (parts x entries) come to the driver.

Rows whose vector is null or has null or non-finite components are dropped.
Shorter vectors count as filled with zeros up to the longest, and that up to a
multiple of the parts; an empty vector is all zeros.  Rows that share an id are
rows of their own; first rows with equal ids go by vector, null ids come last.
With fewer rows than entries the codebooks have as many entries as rows.  An
empty table has empty codebooks and no codes.  A component so large that a scaled
distance might not fit a long is an error, not a wrong code.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.llm import vectors
from histlake.llm.common import cut, joined

#: Rows searched at a time, and coefficients added before entries are eliminated.
ROWS, FIRST, STEP = 1024, 4, 4


def sequency(n: int) -> np.ndarray:
    """Order in which the butterflies' ``n`` outputs have 0, 1, 2, ... sign changes."""
    signs = walsh(np.eye(n, dtype=np.int64), np.arange(n))  # row i: coefficient values of unit vector i
    return np.argsort((np.diff(signs, axis=0) != 0).sum(0), kind="stable")


def walsh(x: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows of ``x`` (a power of two wide), in ``order``."""
    x, n, h = x.copy(), x.shape[1], 1
    while h < n:
        pairs = x.reshape(len(x), n // (2 * h), 2, h)
        a, b = pairs[:, :, 0].copy(), pairs[:, :, 1].copy()
        pairs[:, :, 0], pairs[:, :, 1] = a + b, a - b
        h *= 2
    return x[:, order]


def transformed(part: np.ndarray) -> np.ndarray:
    """Transforms, in sequency order, of parts that are zero-padded to a power of two."""
    n = 1 << max(part.shape[1] - 1, 0).bit_length()
    padded = np.zeros((len(part), n), np.int64)
    padded[:, : part.shape[1]] = part
    return walsh(padded, sequency(n))


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row the lowest index of its nearest entry, and the squared distance;
    both sides are transforms."""
    n, d = rows.shape
    first = min(FIRST, d)
    sums = np.zeros((n, len(entries)), np.int64)
    for c in range(first):
        step = rows[:, c, None] - entries[None, :, c]
        sums += step * step
    promising = entries[sums.argmin(1)]
    limit = ((rows - promising) ** 2).sum(1)
    row, entry = np.nonzero(sums <= limit[:, None])
    full = sums[row, entry]
    for c in range(first, d, STEP):
        full = full + ((rows[row, c : c + STEP] - entries[entry, c : c + STEP]) ** 2).sum(1)
        stay = full <= limit[row]
        row, entry, full = row[stay], entry[stay], full[stay]
    start = np.searchsorted(row, np.arange(n))  # every row keeps its promising entry
    best = np.minimum.reduceat(full, start)
    hit = np.flatnonzero(full == best[row])
    hit = hit[np.searchsorted(row[hit], np.arange(n))]
    return entry[hit], best // d


class Codebooks:
    """Entries of each part position; sent to the tasks as a whole (parts x entries)."""

    def __init__(self, entries: np.ndarray, width: int):
        self.entries, self.width = entries, width  # (parts, entries, part width)

    def parts(self, rows: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
        """Of up to ``ROWS`` rows at a time: the rows, their parts, and each part's entry and distance."""
        n_parts = len(self.entries)
        coefficients = [transformed(e) for e in self.entries]
        for at in range(0, rows.num_rows, ROWS):
            some = rows.slice(at, ROWS)
            x = vectors.matrix(some.column("__v"), self.width).reshape(some.num_rows, n_parts, -1)
            found = [nearest(transformed(x[:, p]), coefficients[p]) for p in range(n_parts)]
            yield some, x, np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and position, comma-joined."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def integers(df: DataFrame, vector: str, scale: int) -> DataFrame:
    """The complete rows of ``df`` with their integer vector ``__v``, written once."""
    return cut(df.filter(vectors.complete(vector)).select("*", vectors.scaled(vector, scale).alias("__v")))


def first_entries(rows: DataFrame, id_col: str, parts: int, entries: int) -> Codebooks:
    """Codebooks of the first ``entries`` rows by id."""
    width, most = rows.agg(F.max(F.size("__v")), F.max(F.array_max(F.transform("__v", lambda x: F.abs(x.cast("decimal(20,0)")))))).first()
    width = -(-(width or 0) // parts) * parts
    d = 1 << max(width // parts - 1, 0).bit_length()
    if d * parts * d * (2 * int(most or 0)) ** 2 >= 1 << 63:
        raise ValueError(f"components up to {most} are too large for exact 64-bit distances")
    first = rows.select(F.col(id_col).alias("id"), "__v").orderBy(F.col("id").asc_nulls_last(), "__v").limit(entries).collect()
    x = np.zeros((len(first), width), np.int64)
    for i, r in enumerate(first):
        x[i, : len(r[1])] = r[1]
    return Codebooks(x.reshape(len(first), parts, width // parts).transpose(1, 0, 2).copy(), width)


def sums(rows: DataFrame, books: Codebooks) -> DataFrame:
    """(part, entry, n, sums): what is assigned to each entry, added up over all rows."""
    n_parts, n_entries, size = books.entries.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((n_parts, n_entries, size), np.int64), np.zeros((n_parts, n_entries), np.int64)
        for batch in batches:
            for _, x, entry, _ in books.parts(batch):
                for p in range(n_parts):
                    order = np.argsort(entry[:, p], kind="stable")
                    used, start = np.unique(entry[order, p], return_index=True)
                    total[p, used] += np.add.reduceat(x[order, p], start, axis=0)
                    count[p, used] += np.diff(np.append(start, len(order)))
        part, used = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(used, pa.int32()), pa.array(count[part, used]),
                                          pa.array(list(total[part, used]), pa.list_(pa.int64()))], ["part", "entry", "n", "s"])

    added = rows.select("__v").mapInArrow(add, "part int, entry int, n bigint, s array<bigint>")
    total = lambda i: F.sum(F.col("s")[i].cast("decimal(38,0)"))
    return added.groupBy("part", "entry").agg(F.sum("n").alias("n"), F.array(*[total(i) for i in range(size)]).alias("s"))


def fit(rows: DataFrame, id_col: str, parts: int = 4, entries: int = 256, rounds: int = 4) -> Codebooks:
    """Codebooks after ``rounds`` of assignment and update; unused entries stay."""
    books = first_entries(rows, id_col, parts, entries)
    for _ in range(rounds if books.entries.size else 0):
        moved = books.entries.copy()
        for r in sums(rows, books).collect():  # a row per part and entry
            moved[r.part, r.entry] = [int(x) // r.n for x in r.s]
        books = Codebooks(moved, books.width)
    return books


def encode(rows: DataFrame, books: Codebooks, code: str = "code", error: str = "error") -> DataFrame:
    """``rows`` without ``__v``, with the code (two hex digits a part, more beyond 256
    entries) and the summed squared distances."""
    keep = [f for f in rows.schema.fields if f.name not in ("__v", code, error)]
    digits = max(2, len(f"{max(books.entries.shape[1] - 1, 0):x}"))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, _, entry, distance in books.parts(batch):
                codes = ["".join(f"{e:0{digits}x}" for e in row) for row in entry.tolist()]
                yield pa.RecordBatch.from_arrays([*[some.column(f.name) for f in keep], pa.array(codes, pa.string()),
                                                  pa.array(distance.sum(1))], [*[f.name for f in keep], code, error])

    schema = type(rows.schema)(list(keep)).add(code, "string").add(error, "long")
    return rows.select(*[f.name for f in keep], "__v").mapInArrow(assign, schema)


def decode(code: Column, books: Codebooks) -> Column:
    """The entries that a code stands for, one after the other."""
    digits = max(2, len(f"{max(books.entries.shape[1] - 1, 0):x}"))
    of = lambda p, book: F.get(F.array(*[F.array(*[F.lit(int(x)) for x in e]) for e in book]),
                               F.conv(F.substring(code, p * digits + 1, digits), 16, 10).cast("int"))
    return F.concat(*[of(p, book) for p, book in enumerate(books.entries)])


def with_group_error(coded: DataFrame, group: str, error: str = "error", out: str = "label_error") -> DataFrame:
    """Adds the errors' sum over rows of equal ``group``, nulls together."""
    key = ["__group", "__null"]
    keyed = lambda d: d.withColumns({key[0]: F.coalesce(F.col(group).cast("string"), F.lit("")), key[1]: F.col(group).isNull()})
    total = cut(keyed(coded).groupBy(*key).agg(F.sum(error).alias(out)))
    size = total.agg(F.count("*"), F.max(F.octet_length(key[0]))).first()
    return joined(keyed(coded), total, key, "inner", size[0], 64 + (size[1] or 0)).drop(*key)


#: The same in SQL (DuckDB), for vectors of equal length; distances as |x|^2 - 2 x c + |c|^2.
def oracle(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    steps = [f"""v AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS id, vec_id, label, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS q
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT id, part, list_slice(q, part * len(q) // {parts} + 1, (part + 1) * len(q) // {parts}) AS x FROM v CROSS JOIN (SELECT unnest(range({parts})) AS part)),
c0 AS MATERIALIZED (SELECT part, id - 1 AS entry, x AS c FROM p WHERE id <= {entries})"""]
    for k in range(rounds + 1):
        steps.append(f"""d{k} AS MATERIALIZED (SELECT id, part, arg_min(entry, off * 1024 + entry) AS entry, min(off) AS off FROM (
    SELECT p.id, p.part, c.entry, list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS off FROM p JOIN c{k} c ON c.part = p.part)
    GROUP BY id, part)""")
        if k < rounds:
            steps.append(f"""m{k} AS (SELECT part, entry, list(CAST(m AS DOUBLE) ORDER BY i) AS c FROM (
    SELECT d.part, d.entry, i, floor(sum(x[i]) / count(*)) AS m FROM d{k} d JOIN p ON p.id = d.id AND p.part = d.part CROSS JOIN (SELECT unnest(range(1, 1 + (SELECT max(len(x)) FROM p))) AS i)
    GROUP BY d.part, d.entry, i) GROUP BY part, entry),
c{k + 1} AS MATERIALIZED (SELECT o.part, o.entry, coalesce(m.c, o.c) AS c FROM c{k} o LEFT JOIN m{k} m ON m.part = o.part AND m.entry = o.entry)""")
    return "WITH " + ",\n".join(steps) + f""",
h AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: CAST(x AS BIGINT)), ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{rounds}),
e AS (SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(off) AS BIGINT) AS error FROM d{rounds} GROUP BY id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM e JOIN v ON v.id = e.id CROSS JOIN h
"""


ORACLE = oracle()
