"""Column profiling and data-quality checks."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Sketches of this accuracy (some kilobytes) bracket a quantile; up to so many rows
#: inside a bracket are sorted to pick it.
SKETCH_ACCURACY, PICK_ROWS = 1_000, 100_000


def exact_quantiles(df: DataFrame, col: str, probabilities: Sequence[float], accuracy: int = SKETCH_ACCURACY,
                    pick_rows: int = PICK_ROWS) -> list:
    """Exact discrete quantiles of the non-null values: for each ``p`` the value
    of rank ``ceil(p * n)`` (at least 1), whatever the number of rows; None without values.

    A round sketches what is left of each quantile's range, around the rank that is sought,
    and counts the rows below and up to the values found.  Either one of them has
    the rank, or the rank lies strictly between two: a range of a few
    thousandths of the rows.  Rounds go on until a range holds ``pick_rows`` rows
    at most; those are sorted in one aggregate.  All quantiles share the passes: two
    a round, so about five for 10^12 rows.  A sketch that misses costs a round, never the result.
    """
    x = F.col(col)
    n = df.agg(F.count(x)).first()[0]
    if not n:
        return [None] * len(probabilities)
    # per quantile: its rank in the open range (low, high), and the rows in that range
    left = {i: [max(math.ceil(p * n - 1e-9), 1), None, None, n] for i, p in enumerate(probabilities)}
    found: dict[int, object] = {}
    inside = lambda low, high: x.isNotNull() & (F.lit(True) if low is None else x > F.lit(low)) & (F.lit(True) if high is None else x < F.lit(high))
    while wide := {i: r for i, r in left.items() if r[3] > pick_rows}:
        around = lambda k, n: [min(max(k / n + d / accuracy, 0.0), 1.0) for d in (-2, 0, 2)]
        marks = df.agg(*[F.percentile_approx(F.when(inside(low, high), x), around(k, n), accuracy).alias(f"q{i}")
                         for i, (k, low, high, n) in wide.items()]).first()
        marks = {i: sorted(set(marks[f"q{i}"])) for i in wide}
        counts = df.agg(*[F.count_if(inside(*wide[i][1:3]) & test).alias(f"{name}{i}_{j}") for i in wide for j, m in enumerate(marks[i])
                          for name, test in (("below", x < F.lit(m)), ("upto", x <= F.lit(m)))]).first()
        for i, (k, low, high, n) in wide.items():
            so_far, end, rows_to_end = 0, high, n
            for j, m in enumerate(marks[i]):
                below, upto = counts[f"below{i}_{j}"], counts[f"upto{i}_{j}"]
                if k <= below:
                    end, rows_to_end = m, below
                    break
                if k <= upto:
                    found[i] = m
                    break
                low, so_far = m, upto
            if i in found:
                del left[i]
            else:
                left[i] = [k - so_far, low, end, rows_to_end - so_far]
    if left:
        picked = df.agg(*[F.sort_array(F.collect_list(F.when(inside(low, high), x)))[k - 1].alias(f"p{i}")
                          for i, (k, low, high, _) in left.items()]).first()
        found |= {i: picked[f"p{i}"] for i in left}
    return [found[i] for i in range(len(probabilities))]


def describe(df: DataFrame, col: str, materialize: bool = False) -> DataFrame:
    """Typed descriptive statistics of one column (A17): count, mean, sample
    stddev, min, exact quartiles (``exact_quantiles``), max.

    The quartiles take a few passes over the column; when ``df`` is an expensive
    derived relation, ``materialize=True`` stores the column once (reliable checkpoint)."""
    df = df.select(col)
    if materialize:
        from histlake.session import checkpoint_root
        checkpoint_root(df.sparkSession)
        df = df.checkpoint()
    x, kind = F.col(col), df.schema[col].dataType
    quartiles = exact_quantiles(df, col, [0.25, 0.5, 0.75])
    return df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("stddev"), F.min(x).alias("min"),
                  *[F.lit(q).cast(kind).alias(name) for name, q in zip(("p25", "p50", "p75"), quartiles)], F.max(x).alias("max"))


def skewness_raw_and_log(df: DataFrame, col: str) -> DataFrame:
    """Population skewness of ``col`` and of ``log1p(col)``."""
    return df.agg(F.skewness(F.col(col)).alias("skew_original"),
                  F.skewness(F.log1p(F.col(col))).alias("skew_log"))


def histogram(df: DataFrame, col: str, bins: int = 100, materialize: bool = False) -> DataFrame:
    """Equal-width histogram (A19): bin = least(floor((x - min) / width),
    bins - 1).  Min and max come from one scalar subquery; the counts are a
    partial + final aggregate, so the result has at most ``bins`` rows
    whatever the input size.  Empty bins are not emitted.

    The two passes read ``df`` twice; when ``df`` is an expensive derived
    relation (joins), ``materialize=True`` stores its single value column
    once (reliable checkpoint) and both passes read that."""
    if materialize:
        from histlake.session import checkpoint_root
        checkpoint_root(df.sparkSession)
        df = df.select(col).where(F.col(col).isNotNull()).checkpoint(eager=True)
    x = F.col(col)
    bounds = df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(width > 0, F.least(F.floor((x - lo) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    return (df.where(x.isNotNull())
            .groupBy(b.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select("bin", (lo + F.col("bin") * width).alias("bin_start"),
                    (lo + (F.col("bin") + 1) * width).alias("bin_end"), "count"))


def quality_report(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] | None = None,
                   domains: Mapping[str, Sequence[str]] | None = None) -> DataFrame:
    """Constraint report (X4) in long form ``(check, column, violations)``.

    * ``not_null``: rows with NULL in the column (Parquet does not enforce
      NOT NULL);
    * ``domains``: non-NULL values outside the allowed list;
    * ``unique``: rows that share their key with another row.
    NULL and domain checks share one aggregate pass; the uniqueness check
    is a grouped count (partial aggregate on the key).
    """
    domains = dict(domains or {})
    exprs = []
    for c in not_null:
        exprs.append(F.struct(F.lit("not_null").alias("check"), F.lit(c).alias("column"),
                              F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).cast("long")
                              .alias("violations")))
    for c, allowed in domains.items():
        exprs.append(F.struct(F.lit("domain").alias("check"), F.lit(c).alias("column"),
                              F.sum(F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(allowed)), 1)
                                    .otherwise(0)).cast("long").alias("violations")))
    parts = []
    if exprs:
        parts.append(df.agg(F.array(*exprs).alias("_r"))
                     .select(F.inline("_r")))
    if unique:
        key = list(unique)
        dup = (df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
               .where(F.col("_n") > 1)
               .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("violations"))
               .select(F.lit("unique").alias("check"), F.lit(",".join(key)).alias("column"),
                       "violations"))
        parts.append(dup)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def with_violations(df: DataFrame, not_null: Sequence[str] = (), domains: Mapping[str, Sequence[str]] | None = None,
                    unique: Sequence[str] | None = None, casts: Mapping[str, str] | None = None,
                    checks: Mapping[str, Column] | None = None, out: str = "violations") -> DataFrame:
    """Adds ``out``, the names of the rules that a row breaks, in the rules' order; none: an empty array.

    ``not_null:<column>``; ``domain:<column>`` (a value outside the list; null is none);
    ``cast:<column>`` (a value that is not of the type); ``check:<name>`` (a condition that is
    false; null passes, as in SQL); ``unique:<columns>`` (another row has the same key,
    nulls equal; both rows break it).  Only uniqueness needs a shuffle: keys are counted
    with a partial aggregate, and the rows are joined with the repeated keys alone."""
    rules = [(f"not_null:{c}", F.col(c).isNull()) for c in not_null]
    rules += [(f"domain:{c}", F.col(c).isNotNull() & ~F.col(c).isin(list(allowed))) for c, allowed in (domains or {}).items()]
    rules += [(f"cast:{c}", F.col(c).isNotNull() & F.col(c).try_cast(kind).isNull()) for c, kind in (casts or {}).items()]
    rules += [(f"check:{name}", ~F.coalesce(test, F.lit(True))) for name, test in (checks or {}).items()]
    if unique:
        key = F.struct(*unique)
        repeated = df.groupBy(key.alias("_key")).agg(F.count("*").alias("_n")).where("_n > 1").select("_key", F.lit(True).alias("_again"))
        df = df.withColumn("_key", key).join(repeated, "_key", "left").drop("_key")
        rules.append((f"unique:{','.join(unique)}", F.col("_again").isNotNull()))
    names = [F.when(broken, F.lit(name)) for name, broken in rules]
    found = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return df.withColumn(out, found).drop("_again")


def set_apart(df: DataFrame, path: str, violations: str = "violations", mode: str = "append") -> tuple[DataFrame, DataFrame]:
    """Writes rows without violations and those with some in one pass, into two folders of
    ``path``; returns both as stored: (accepted, without ``violations``; rejected, with the reasons).

    One bad row does not fail a load, and is kept with its reasons until someone looks."""
    df.withColumn("_accepted", F.size(violations) == 0).write.mode(mode).partitionBy("_accepted").parquet(path)
    stored = df.sparkSession.read.schema(df.schema.add("_accepted", "boolean")).parquet(path)
    side = lambda accepted: stored.where(F.col("_accepted") == F.lit(accepted)).drop("_accepted")
    return side(True).drop(violations), side(False)


def violation_counts(accepted: DataFrame, rejected: DataFrame, violations: str = "violations") -> DataFrame:
    """(rule, rows): rows that break each rule, all ``rejected`` rows and all ``accepted`` ones."""
    by_rule = rejected.select(F.explode(violations).alias("rule")).groupBy("rule").agg(F.count("*").alias("rows"))
    total = lambda df, name: df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("rule"), "rows")
    return by_rule.unionByName(total(rejected, "rejected")).unionByName(total(accepted, "accepted"))


def not_null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows breaking a declared NOT NULL constraint."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return df.where(cond)


def observe_quality(df: DataFrame, not_null: Sequence[str] = (),
                    domains: Mapping[str, Sequence[str]] | None = None, name: str | None = None):
    """Attach quality counters to ``df`` as Spark ``Observation`` metrics
    (X4): they are computed by whatever action runs next - typically the
    write of the table - with no extra pass over the data.

    Returns ``(observed_df, observation)``; after the action,
    ``observation.get`` is a dict: ``rows``, ``null_<col>`` per NOT NULL
    column and ``bad_<col>`` per domain-checked column.  Attach it above any
    ``repartitionByRange`` (e.g. after ``sources.writers.cluster``): the range
    sampling pass re-runs the plan below the exchange and would count twice.
    """
    from pyspark.sql import Observation
    import uuid
    domains = dict(domains or {})
    obs = Observation(name or f"quality_{uuid.uuid4().hex[:8]}")
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.sum(F.when(F.col(c).isNull(), 1).otherwise(0)).alias(f"null_{c}") for c in not_null]
    metrics += [F.sum(F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(v)), 1).otherwise(0))
                .alias(f"bad_{c}") for c, v in domains.items()]
    return df.observe(obs, *metrics), obs
