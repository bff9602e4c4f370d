"""Mixing sources to target weights.

Words per source give each source a repetition rate (target / words).  A
document is emitted floor(rate) times, plus one copy by a hash-seeded Bernoulli
draw whose probability is the rate's fraction.  Several seeds are tried per
source in one aggregation and the one whose total comes nearest the target is
used, so that a source of few or uneven documents also comes near it.

DataFrame functions only.  The table of sources may be of any size: ranks come
from range partitions, the level from sums, and it is broadcast only while small.

Null text: size 0.  A null source is a source, ordered last.  A source without
words has target 0 and rate 0.  Rows with equal ids and sources share their
draw, so reruns and repeated rows agree.  Document columns named as one of ``ADDED``
are replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histlake.llm.common import cut, joined

WORDS = r"[^\x20\x09-\x0D]+"
#: Seeds tried per source; four draws come from one md5.
SEEDS = 32
#: Columns that ``mix`` adds.
ADDED = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]


def size_of(text_col: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORDS)).cast("long")


def draw(id_col: str, seed: Column | int) -> Column:
    """Uniform in [0, 1): eight hex digits of md5(id:block)."""
    seed = seed if isinstance(seed, Column) else F.lit(seed)
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")),
                               F.floor(seed / 4).cast("string")).cast("binary"))
    return F.conv(F.substring(digest, (seed % 4 * 8 + 1).cast("int"), F.lit(8)), 16, 10).cast("double") / F.lit(2.0**32)


def ranked(sources: DataFrame) -> DataFrame:
    """Adds ``rank`` (from 0, by code point, null last) without one global sort task."""
    order = [F.col("source").isNull(), F.col("source")]
    dealt = cut(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    parts = dealt.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition
    before = parts.withColumn("before", F.coalesce(F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return dealt.withColumn("within", within).join(F.broadcast(before), "part") \
        .withColumn("rank", F.col("within") + F.col("before")).drop("part", "within", "before")


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """``sources(source, words)`` with its ``target``.

    Everyone gets weight x level, at most ``most`` x words; the level is raised
    until nothing is left over.  Each round is one sum over the sources; a round
    adds sources to the full ones, and most fill in the first rounds."""
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    s = cut(ranked(sources).withColumn("weight", weight).withColumn("cap", F.lit(most) * F.col("words"))
            .withColumn("full_at", F.col("cap") / F.col("weight")))
    total = share * float(s.agg(F.sum("words")).first()[0] or 0)
    level, full = 0.0, -1
    while True:
        is_full = F.col("full_at") <= F.lit(level)
        row = s.agg(F.sum(F.when(is_full, F.col("cap")).otherwise(0.0)), F.sum(F.when(is_full, 0.0).otherwise(F.col("weight"))),
                    F.count_if(is_full)).first()
        if row[2] == full or not row[1]:
            break
        level, full = (total - row[0]) / row[1], row[2]
    return s.withColumn("target", F.least("cap", F.col("weight") * F.lit(level))
                        if row[1] else F.col("cap")).select("source", "words", "target")


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``docs`` with mix_size, mix_source_size, mix_target and mix_copies."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ADDED])
    source = F.col(source_col).cast("string")
    sized = cut(docs.select(F.col(id_col).alias("id"), source.alias("source"), size_of(text_col).alias("size")))
    found = targets(sized.groupBy("source").agg(F.sum("size").alias("words")), weights, share, most)
    rate = F.when(F.col("words") > 0, F.col("target") / F.col("words")).otherwise(0.0)
    found = cut(found.withColumn("times", F.floor(rate).cast("long")).withColumn("chance", rate - F.floor(rate)))
    n, key = found.count(), ["__source_key", "__source_null"]
    keyed = lambda d, c: d.withColumns({key[0]: F.coalesce(c, F.lit("")), key[1]: c.isNull()})
    side = keyed(found, F.col("source")).drop("source")
    tried = [F.abs(F.sum(F.when(draw("id", j) < F.col("chance"), F.col("size")).otherwise(0))
                   - F.first(F.col("target") - F.col("times") * F.col("words"))).alias(f"off{j}") for j in range(SEEDS)]
    offs = joined(keyed(sized, F.col("source")).drop("source"), side, key, "inner", n, 200).groupBy(*key).agg(*tried)
    best = F.array_position(F.array(*[f"off{j}" for j in range(SEEDS)]), F.least(*[f"off{j}" for j in range(SEEDS)]))
    plan = cut(side.join(offs.select(*key, (best - 1).alias("seed")), key))
    plan = plan.select(*key, F.struct("words", "target", "times", "chance", "seed").alias("__plan"))
    out = joined(keyed(docs.withColumn("mix_size", size_of(text_col)), source), plan, key, "inner", n, 200)
    extra = (draw(id_col, F.col("__plan.seed")) < F.col("__plan.chance")).cast("long")
    return out.select(*docs.columns, "mix_size", F.col("__plan.words").alias("mix_source_size"), F.col("__plan.target").alias("mix_target"),
                      (F.col("__plan.times") + extra).alias("mix_copies"))


def emit(mixed: DataFrame) -> DataFrame:
    """Every document as often as the mix takes it, ``mix_copy`` counting from 1."""
    keep = [c for c in mixed.columns if c not in ADDED and c.lower() != "mix_copy"]
    return mixed.filter("mix_copies > 0").select(
        *keep, F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))).alias("mix_copy"))


#: The same in SQL (DuckDB); the closed form of the level takes a running sum over sources.
_DRAW = " + ".join(f"(strpos('0123456789abcdef', substr(h, b + {k}, 1)) - 1) * {16 ** (8 - k)}" for k in range(1, 9))
ORACLE = rf"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS words FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN source IS NULL THEN 1 ELSE 0 END, source) - 1 AS rk FROM s),
w AS (SELECT *, CAST(CASE rk % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS DOUBLE) AS weight, CAST(2 * words AS DOUBLE) AS cap FROM r),
o AS (SELECT *, cap / weight AS full_at, sum(cap) OVER (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - cap AS cap_before,
             sum(weight) OVER () + weight - sum(weight) OVER (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS left_over,
             CAST(1.5 * sum(words) OVER () AS DOUBLE) AS total FROM w),
f AS (SELECT *, CASE WHEN full_at <= (total - cap_before) / left_over THEN 1 ELSE 0 END AS is_full FROM o),
l AS (SELECT (max(total) - sum(is_full * cap)) / nullif(sum((1 - is_full) * weight), 0) AS level FROM f),
t AS (SELECT f.source, f.words, CASE WHEN l.level IS NULL THEN f.cap ELSE least(f.cap, f.weight * l.level) END AS target FROM f CROSS JOIN l),
p AS (SELECT *, CAST(floor(CASE WHEN words > 0 THEN target / words ELSE 0 END) AS BIGINT) AS times,
             CASE WHEN words > 0 THEN target / words - floor(target / words) ELSE 0 END AS chance FROM t),
j AS (SELECT unnest(range({SEEDS})) AS seed),
h AS (SELECT d.doc_id, d.source, d.size, j.seed, md5(coalesce(CAST(d.doc_id AS VARCHAR), 'null') || ':' || CAST(j.seed // 4 AS VARCHAR)) AS h,
             j.seed % 4 * 8 AS b FROM d CROSS JOIN j),
u AS (SELECT doc_id, source, size, seed, ({_DRAW}) / 4294967296.0 AS draw FROM h),
e AS (SELECT p.source, u.seed, abs(sum(CASE WHEN u.draw < p.chance THEN u.size ELSE 0 END) - max(p.target - p.times * p.words)) AS off
      FROM u JOIN p ON u.source IS NOT DISTINCT FROM p.source GROUP BY p.source, u.seed),
b AS (SELECT source, seed, row_number() OVER (PARTITION BY source ORDER BY off, seed) AS nth FROM e)
SELECT u.doc_id, u.size, p.words AS source_size, p.target, CAST(u.size * (p.times + CASE WHEN u.draw < p.chance THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM b JOIN u ON u.source IS NOT DISTINCT FROM b.source AND u.seed = b.seed JOIN p ON p.source IS NOT DISTINCT FROM b.source WHERE b.nth = 1
"""
