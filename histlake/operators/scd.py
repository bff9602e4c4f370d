"""Slowly changing dimensions over a sequence column (SC1-SC4, X2, X3).

Both operators are deterministic functions of their input: ties on
(keys, sequence) are resolved by ``tie_break`` (largest wins), rows with a
NULL sequence are rejected (see ``null_sequence_rows``), and the order of
arrival never matters - only the sequence column does (ST5).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, MapType, TimestampNTZType, TimestampType

from histlake.operators.joins import broadcast_if_small

START_AT = "__START_AT"
END_AT = "__END_AT"

# A key with more rows than this is "hot": its history is split into
# sequence-range chunks of about ``DEFAULT_CHUNK_ROWS`` rows that are
# processed in parallel and stitched together exactly.
DEFAULT_HOT_KEY_ROWS = 2_000_000
DEFAULT_CHUNK_ROWS = 1_000_000
MAX_CHUNKS_PER_KEY = 4096
# at most this many quantile cut points in total (hot keys x cuts) are
# broadcast; beyond it hot keys get equal-width chunks instead
MAX_CUT_VALUES = 5_000_000


def _orderable(df: DataFrame, cols: Sequence[str]) -> list[str]:
    types = {f.name: f.dataType for f in df.schema.fields}
    return [c for c in cols if not isinstance(types[c], (ArrayType, MapType))]


def _tie_cols(df: DataFrame, keys: Sequence[str], seq: str,
              tie_break: Sequence[str] | None) -> list[str]:
    if tie_break is not None:
        return list(tie_break)
    return _orderable(df, [c for c in df.columns if c not in keys and c != seq])


def null_sequence_rows(df: DataFrame, sequence_by: str) -> DataFrame:
    """Rows an SCD operator rejects (NULL sequence) - count them for audit."""
    return df.where(F.col(sequence_by).isNull())


def scd1(df: DataFrame, keys: Sequence[str], sequence_by: str,
         tie_break: Sequence[str] | None = None) -> DataFrame:
    """SCD type 1: the latest row per key by ``sequence_by``.

    One grouped ``max_by`` over a struct: the aggregate is partial before the
    shuffle (one row per key per map task), so a hot key costs no more than
    any other key.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(sequence_by), *[F.col(c) for c in _tie_cols(df, keys, sequence_by, tie_break)])
    latest = (df.where(F.col(sequence_by).isNotNull())
              .groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in others]), order).alias("_latest")))
    return latest.select(*[F.col(k) for k in keys],
                         *[F.col(f"_latest.{c}").alias(c) for c in others]).select(*df.columns)


def scd2(df: DataFrame, keys: Sequence[str], sequence_by: str,
         track: Sequence[str] | None = None, tie_break: Sequence[str] | None = None,
         start_col: str = START_AT, end_col: str = END_AT,
         hot_key_rows: int | None = DEFAULT_HOT_KEY_ROWS,
         chunk_rows: int = DEFAULT_CHUNK_ROWS,
         change_type_col: str | None = None,
         partitioned_by_keys: bool = False) -> DataFrame:
    """SCD type 2 with a tracked column list.

    A new version starts at the first row of a key and whenever a tracked
    column differs (NULL-safe) from the previous row in sequence order.
    Versions are half-open ``[start, end)``; the current one has ``end``
    NULL.  Untracked columns (and the sequence column itself) take the value
    of the latest row inside the version.  There is no delete rule: a key
    that disappears stays open.

    ``change_type_col`` adds X3's label from the version number
    (``INSERT`` for a key's first version, ``UPDATE`` after) at no cost.

    Plan.  A first aggregate counts rows per key (``hot_key_rows``; ``None``
    skips the check).  Ordinary keys: one hash exchange on ``keys`` and one
    sort by (keys, sequence, tie-break), which the dedup, the change flags and
    the version bounds all reuse; a version is its last row, so nothing is
    aggregated.  ``partitioned_by_keys=True`` states that the input already
    arrives hash-partitioned by exactly ``keys`` (e.g. a table written with
    ``sources.writers.write_bucketed``): then there is no exchange at all.
    Rows of hot keys are taken out and go through ``_scd2_chunked``, where no
    key is ever processed by a single task; both results are put together.
    """
    keys = list(keys)
    seq = sequence_by
    non_key = [c for c in df.columns if c not in keys and c != seq]
    track = list(track) if track is not None else non_key
    untracked = [c for c in non_key if c not in track]
    tie = _tie_cols(df, keys, seq, tie_break)

    hot = _hot_keys(df, keys, seq, hot_key_rows, chunk_rows) if hot_key_rows is not None else None
    if hot is None:
        return _scd2_plain(df, keys, seq, track, tie, start_col, end_col, change_type_col, partitioned_by_keys)
    rest = df.withColumn("_k", _key_struct(keys)).join(hot.select("_k"), "_k", "left_anti").drop("_k")
    return _scd2_plain(rest, keys, seq, track, tie, start_col, end_col, change_type_col, partitioned_by_keys) \
        .unionByName(_scd2_chunked(df, keys, seq, track, untracked, tie, hot, start_col, end_col, change_type_col))


def _scd2_plain(df: DataFrame, keys: list[str], seq: str, track: list[str], tie: list[str], start_col: str,
                end_col: str, change_type_col: str | None, partitioned_by_keys: bool) -> DataFrame:
    base = df.where(F.col(seq).isNotNull())
    if not partitioned_by_keys:
        base = base.repartition(*[F.col(k) for k in keys])
    w = Window.partitionBy(*keys).orderBy(F.col(seq), *[F.col(c).desc() for c in tie])
    # one row per (keys, sequence): the largest tie-break comes first
    rows = base.withColumn("_before", F.lag(seq).over(w)) \
        .where(F.col("_before").isNull() | (F.col("_before") != F.col(seq))).drop("_before")
    tracked = F.struct(*[F.col(c) for c in track]) if track else F.lit(0)
    rows = rows.withColumn("_t", tracked)
    rows = rows.withColumns({"_n": F.row_number().over(w), "_p": F.lag("_t").over(w)}) \
        .withColumn("_chg", (F.col("_n") == 1) | ~F.col("_t").eqNullSafe(F.col("_p"))).drop("_t", "_p")
    so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumns({
        start_col: F.last(F.when(F.col("_chg"), F.col(seq)), ignorenulls=True).over(so_far),
        end_col: F.lead(seq).over(w), "_next": F.lead("_chg").over(w),
        "_ver": F.sum(F.col("_chg").cast("int")).over(so_far)})
    # the last row of each version: its successor starts another, or there is none
    return _finish(rows.where(F.coalesce(F.col("_next"), F.lit(True))), df.columns, start_col, end_col, change_type_col)


def _finish(out: DataFrame, columns: list[str], start_col: str, end_col: str,
            change_type_col: str | None) -> DataFrame:
    cols = [F.col(c) for c in columns] + [F.col(start_col), F.col(end_col)]
    if change_type_col:
        cols.append(F.when(F.col("_ver") == 1, F.lit("INSERT")).otherwise(F.lit("UPDATE"))
                    .alias(change_type_col))
    return out.select(*cols)


def _seq_number(df: DataFrame, seq: str) -> Column:
    """Order-preserving numeric image of the sequence column."""
    dtype = df.schema[seq].dataType
    c = F.col(seq)
    if isinstance(dtype, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(dtype, TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c) \
            .cast("double")
    if isinstance(dtype, TimestampType):
        return F.unix_micros(c).cast("double")
    return c.cast("double")


def _key_struct(keys: Sequence[str]) -> Column:
    # one non-NULL struct column: NULL key parts compare equal inside it, so
    # it can be a plain equi-join / partitioning key
    return F.struct(*[F.col(k) for k in keys])


def _hot_keys(df: DataFrame, keys: Sequence[str], seq: str, hot_key_rows: int,
              chunk_rows: int) -> DataFrame | None:
    """Hot keys (more than ``hot_key_rows`` rows) and their chunking plan, or
    ``None`` when there is none (the common case: one aggregate job over the
    key and sequence columns only).

    Per hot key: its sequence range, chunk count ``_m`` (about
    ``chunk_rows`` rows each), the equal-width chunk width ``_w`` and
    ``_cuts``, the sequence quantiles that split the key into chunks of equal
    row count (``percentile_approx`` over the hot keys' rows, so chunks stay
    balanced when a key's rows bunch in time).  ``_cuts`` is NULL - and
    equal-width chunks are used - when all cut points together would exceed
    ``MAX_CUT_VALUES``.  Materialised once and bounded: at most
    rows / hot_key_rows keys.
    """
    x = _seq_number(df, seq)
    from histlake.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    # plain key columns: a bucketed table's own partitioning serves the aggregate
    stats = (df.where(F.col(seq).isNotNull())
             .groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("_cnt"), F.min(x).alias("_lo"), F.max(x).alias("_hi"))
             .where(F.col("_cnt") > F.lit(hot_key_rows))
             .select(_key_struct(keys).alias("_k"), "_cnt", "_lo", "_hi")).checkpoint()
    if stats.isEmpty():
        return None
    m = F.least(F.ceil(F.col("_cnt") / F.lit(float(chunk_rows))), F.lit(MAX_CHUNKS_PER_KEY)).cast("int")
    hot = stats.select("_k", "_lo", m.alias("_m"),
                       ((F.col("_hi") - F.col("_lo")) / m).alias("_w")).checkpoint(eager=True)
    size = hot.agg(F.count(F.lit(1)).alias("n"), F.max("_m").alias("m")).first()
    n_hot, m_max = size["n"], size["m"]
    if m_max > 1 and n_hot * (m_max - 1) <= MAX_CUT_VALUES:
        # one fraction list for all hot keys (percentages must be constant);
        # keys needing fewer chunks just get finer ones
        fractions = [i / m_max for i in range(1, m_max)]
        cuts = (df.where(F.col(seq).isNotNull())
                .withColumn("_k", _key_struct(keys))
                .join(F.broadcast(hot.select("_k")), "_k", "inner")
                .groupBy("_k").agg(F.percentile_approx(x, fractions, 10_000).alias("_cuts")))
        hot = hot.join(cuts, "_k", "left").checkpoint(eager=True)
    else:
        hot = hot.withColumn("_cuts", F.lit(None).cast("array<double>"))
    return broadcast_if_small(hot, known_rows=n_hot)


def _quantile_chunk(x: Column, cuts: Column, max_cuts: int = MAX_CHUNKS_PER_KEY) -> Column:
    """Number of cut points <= x (cuts ascending): a binary search by
    powers of two, so each hot row costs O(log chunks), JVM-side."""
    steps = []
    step = 1
    while step * 2 <= max_cuts:
        step *= 2
    while step >= 1:
        steps.append(step)
        step //= 2
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]), F.lit(0),
        lambda pos, st: F.when(F.try_element_at(cuts, pos + st) <= x, pos + st).otherwise(pos))


def _scd2_chunked(df: DataFrame, keys: list[str], seq: str, track: list[str],
                  untracked: list[str], tie: list[str], hot: DataFrame,
                  start_col: str, end_col: str, change_type_col: str | None = None) -> DataFrame:
    """SCD2 with hot keys split into sequence-range chunks.

    1. the hot keys' rows get ``_chunk``, the quantile range of their sequence
       - about ``chunk_rows`` rows each - or an equal-width range when the cut
       points are too many to ship, by a broadcast join with the hot-key plan;
    2. (keys, sequence) dedup as a grouped ``max_by`` - map-side combined, so
       even a hot (key, sequence) pair is reduced before the shuffle;
    3. change flags, local version numbers and next-row values by windows
       per (key, chunk) - bounded groups;
    4. for hot keys only, a per-chunk summary (first/last tracked value,
       local version count, first sequence) is stitched across chunks by a
       window over at most ``MAX_CHUNKS_PER_KEY`` rows per key and
       broadcast back: it fixes the first row's change flag, offsets the
       local version numbers and supplies the end of a chunk's last version;
    5. one row per global version by a partial + final aggregate.
    The result equals the single-exchange plan row for row.
    """
    payload = track + untracked
    x = _seq_number(df, seq)
    rows = (df.where(F.col(seq).isNotNull())
            .withColumn("_k", _key_struct(keys))
            .join(hot, "_k"))
    equal_width = F.when(F.col("_w") <= 0, F.lit(0)) \
                   .otherwise(F.least(F.floor((x - F.col("_lo")) / F.col("_w")), F.col("_m") - 1))
    chunk = F.when(F.col("_cuts").isNotNull(), _quantile_chunk(x, F.col("_cuts"))) \
             .otherwise(equal_width).cast("int")
    rows = rows.select("_k", seq, *payload, chunk.alias("_chunk"))
    order = F.struct(*[F.col(c) for c in tie]) if tie else F.lit(0)
    dedup = (rows.groupBy("_k", "_chunk", seq)
             .agg(F.max_by(F.struct(*[F.col(c) for c in payload]), order).alias("_r"))
             .select("_k", "_chunk", seq, *[F.col(f"_r.{c}").alias(c) for c in payload]))

    wc = Window.partitionBy("_k", "_chunk").orderBy(seq)
    tracked = F.struct(*[F.col(c) for c in track]) if track else F.lit(0)
    local = (dedup.repartition("_k", "_chunk")
             .withColumn("_t", tracked)
             .withColumn("_lchg", F.when(F.row_number().over(wc) == 1, 1)
                         .when(~F.col("_t").eqNullSafe(F.lag("_t").over(wc)), 1).otherwise(0))
             .withColumn("_lver", F.sum("_lchg").over(wc.rowsBetween(Window.unboundedPreceding,
                                                                      Window.currentRow)))
             .withColumn("_nseq", F.lead(seq).over(wc))
             .withColumn("_nchg", F.lead("_lchg").over(wc)))

    # per-chunk summary
    ws = Window.partitionBy("_k").orderBy("_chunk")
    summary = (local.groupBy("_k", "_chunk")
               .agg(F.min(seq).alias("_fseq"), F.min_by("_t", F.col(seq)).alias("_ft"),
                    F.max_by("_t", F.col(seq)).alias("_lt"), F.max("_lver").alias("_n"))
               .withColumn("_fchg", F.when(F.row_number().over(ws) == 1, 1)
                           .when(~F.col("_ft").eqNullSafe(F.lag("_lt").over(ws)), 1).otherwise(0)))
    summary = (summary
               .withColumn("_off", F.coalesce(
                   F.sum(F.col("_n") - 1 + F.col("_fchg")).over(ws.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
               .withColumn("_nfseq", F.lead("_fseq").over(ws))
               .withColumn("_nfchg", F.lead("_fchg").over(ws))
               .select("_k", "_chunk", "_fchg", "_off", "_nfseq", "_nfchg"))
    summary = broadcast_if_small(summary)   # bounded: hot keys x chunks

    j = local.join(summary, ["_k", "_chunk"], "left")
    fchg = F.coalesce(F.col("_fchg"), F.lit(1))
    gver = F.coalesce(F.col("_off"), F.lit(0)) + F.col("_lver") - 1 + fchg
    cend = F.when(F.col("_nseq").isNotNull(), F.when(F.col("_nchg") == 1, F.col("_nseq"))) \
            .otherwise(F.when(F.col("_nfchg") == 1, F.col("_nfseq")))
    versions = (j.groupBy("_k", gver.alias("_gver"))
                .agg(F.min(seq).alias(start_col),
                     F.max_by(F.struct(*[F.col(c) for c in [seq] + payload], cend.alias("_cend")),
                              F.col(seq)).alias("_v")))
    out = versions.select(*[F.col("_k")[k].alias(k) for k in keys],
                          *[F.col(f"_v.{c}").alias(c) for c in [seq] + payload],
                          start_col, F.col("_v._cend").alias(end_col), F.col("_gver").alias("_ver"))
    return _finish(out, df.columns, start_col, end_col, change_type_col)


def current(history: DataFrame, end_col: str = END_AT) -> DataFrame:
    """Current versions only (SC3): ``end IS NULL``."""
    return history.where(F.col(end_col).isNull())


def as_of(history: DataFrame, ts, start_col: str = START_AT, end_col: str = END_AT) -> DataFrame:
    """Versions valid at ``ts`` (X2): ``start <= ts AND (end > ts OR end IS NULL)``."""
    t = ts if isinstance(ts, Column) else F.lit(ts)
    return history.where((F.col(start_col) <= t) &
                         (F.col(end_col).isNull() | (F.col(end_col) > t)))


def with_change_type(history: DataFrame, keys: Sequence[str], start_col: str = START_AT,
                     name: str = "change_type") -> DataFrame:
    """X3 on a stored history: ``INSERT`` for a key's first version,
    ``UPDATE`` for later ones.  Each key's first start comes from a partial
    + final aggregate joined back on the key (AQE splits a skewed key on the
    history side), not from a per-key window.  When building the history,
    prefer ``scd2(..., change_type_col=...)``, which needs no extra pass."""
    firsts = history.groupBy(_key_struct(keys).alias("_k")).agg(F.min(start_col).alias("_first"))
    h = history.withColumn("_k", _key_struct(keys))
    return (h.join(firsts, "_k", "left")
            .withColumn(name, F.when(F.col(start_col) == F.col("_first"), F.lit("INSERT"))
                        .otherwise(F.lit("UPDATE")))
            .select(*history.columns, name))


def key_history(history: DataFrame, predicate: Column | None, now,
                columns: Sequence[str], start_col: str = START_AT, end_col: str = END_AT,
                change_type: str | None = None, keys: Sequence[str] | None = None) -> DataFrame:
    """History of selected keys with ``valid_from`` / ``valid_to`` (SC4);
    an open interval ends at ``now`` (``COALESCE(end, now)``)."""
    h = history if predicate is None else history.where(predicate)
    now_col = now if isinstance(now, Column) else F.lit(now)
    cols = [F.col(c) for c in columns] + [
        F.col(start_col).alias("valid_from"),
        F.coalesce(F.col(end_col), now_col).alias("valid_to")]
    if change_type and keys:
        h = with_change_type(h, keys, start_col, change_type)
        cols.append(F.col(change_type))
    return h.select(*cols)
