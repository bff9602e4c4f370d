"""Chat formatting with collapse of cumulative snapshots.

A conversation that is logged after every turn appears many times, each a
prefix of the next.  Every turn gets a rolling hash of its conversation so far
(two 64-bit lanes, xor of hashes tagged with the turn's place).  A conversation
whose whole hash is another's proper prefix hash is dropped by an anti join; of
equal conversations the smallest id stays.  What is left is rendered.

Long conversations are dealt in blocks of ``BLOCK`` turn numbers for the
running hashes and in parts of ``PART`` turns for rendering, so that one huge
conversation occupies many tasks; the parts' texts concatenate to the whole.

Turns are ordered by turn (null last), role, and a hash of the text; rows equal
in all four columns are one turn.  A null role is ``unknown``, a null text empty.  Rows
without a conversation id are left out.  Extra columns are ignored.
DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from histlake.llm.common import cut

BLOCK, PART = 256, 512

START, END = "<|im_start|>", "<|im_end|>"


def plain(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, t1, t2): t1 and t2 are hashes of the text."""
    return turns.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("unknown")).alias("role"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text")).filter("conv is not null") \
        .withColumns({"t1": F.xxhash64("text"), "t2": F.xxhash64(F.lit("|"), "text")})


def placed_turns(rows: DataFrame) -> DataFrame:
    """(conv, turn, role, t1, t2, place, n_turns, h1, h2) of ``plain`` turns: their
    place from 0 and the rolling hash of the conversation up to and with them.
    The texts stay where they are; their hashes stand for them."""
    rows = rows.select("conv", "turn", "role", "t1", "t2",
                       F.coalesce(F.floor(F.col("turn") / BLOCK).cast("long"), F.lit((1 << 63) - 1)).alias("block"))  # null turns come last
    w = Window.partitionBy("conv", "block").orderBy("turn", "role", "t1", "t2")
    same = F.struct("turn", "role", "t1", "t2")
    rows = rows.withColumn("again", F.coalesce(F.lag(same).over(w).eqNullSafe(same), F.lit(False))).filter("not again").drop("again")
    rows = cut(rows.withColumn("nth", F.row_number().over(w) - 1))
    over = Window.partitionBy("conv").orderBy("block")
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("conv", "block").agg(F.count("*").alias("n"))
    sizes = sizes.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))) \
        .withColumn("n_turns", F.sum("n").over(Window.partitionBy("conv"))).drop("n")
    rows = rows.join(sizes, ["conv", "block"]).withColumn("place", F.col("first") + F.col("nth"))
    rows = rows.withColumns({"a": F.xxhash64("place", "role", "t1", "t2"), "b": F.xxhash64("t2", F.lit("|"), "role", "t1", "place")})
    w = Window.partitionBy("conv", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = cut(rows.withColumns({"a": F.bit_xor("a").over(w), "b": F.bit_xor("b").over(w)}))
    ends = rows.groupBy("conv", "block").agg(F.max_by("a", "place").alias("ea"), F.max_by("b", "place").alias("eb"))
    ends = ends.select("conv", "block", F.coalesce(F.bit_xor("ea").over(before), F.lit(0)).alias("pa"),
                       F.coalesce(F.bit_xor("eb").over(before), F.lit(0)).alias("pb"))
    return rows.join(ends, ["conv", "block"]).select(
        "conv", "turn", "role", "t1", "t2", "place", "n_turns", F.col("a").bitwiseXOR(F.col("pa")).alias("h1"),
        F.col("b").bitwiseXOR(F.col("pb")).alias("h2"))


def maximal(placed: DataFrame) -> DataFrame:
    """(conv, n_copies): conversations that prefix no longer one; one of equals."""
    key = [(F.col("place") + 1).alias("length"), "h1", "h2"]
    whole = placed.filter(F.col("place") + 1 == F.col("n_turns")).select("conv", *key) \
        .groupBy("length", "h1", "h2").agg(F.min("conv").alias("conv"), F.count("*").alias("n_copies"))
    prefixes = placed.filter(F.col("place") + 1 < F.col("n_turns")).select(*key).distinct()
    return whole.join(prefixes, ["length", "h1", "h2"], "left_anti").select("conv", "n_copies")


def rendered(role: Column, text: Column) -> Column:
    """One turn; marks inside a text are broken up, so that they mark nothing."""
    clean = F.replace(text, F.lit("<|im_"), F.lit("<| im_"))
    return F.concat(F.lit(START), role, F.lit("\n"), clean, F.lit(END + "\n"))


def format_chats(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """(id, part, n_parts, n_turns, n_copies, text) of the maximal conversations."""
    rows = plain(turns, id_col, turn_col, role_col, text_col)
    placed = cut(placed_turns(rows))
    names = ["conv", "role", "t1", "t2", "turn"]
    kept = placed.drop("h1", "h2").join(maximal(placed), "conv").withColumnsRenamed({c: f"k_{c}" for c in names})
    # the texts meet their places turn by turn, so no conversation is a hot key here
    same = reduce(Column.__and__, [F.col(c) == F.col(f"k_{c}") for c in names[:4]] + [F.col("turn").eqNullSafe(F.col("k_turn"))])
    texts = rows.join(kept, same).select("conv", "place", "n_turns", "n_copies", rendered(F.col("role"), F.col("text")).alias("t"))
    parts = texts.groupBy("conv", F.floor(F.col("place") / PART).cast("long").alias("part")).agg(
        F.first("n_turns").alias("n_turns"), F.first("n_copies").alias("n_copies"),
        F.collect_set(F.struct("place", "t")).alias("turns"))  # repeated rows are one turn
    return parts.select(F.col("conv").alias(id_col), "part", F.ceil(F.col("n_turns") / PART).cast("long").alias("n_parts"), "n_turns", "n_copies",
                        F.array_join(F.transform(F.array_sort("turns"), lambda x: x["t"]), "").alias("text"))


#: The same in SQL, for conversations whose turns are numbered without ties.
ORACLE = """
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS place FROM t),
r AS (
  SELECT *, md5(string_agg(role || chr(31) || text, chr(30)) OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)) AS h,
         count(*) OVER (PARTITION BY conv_id) AS n_turns FROM n),
w AS (SELECT h, n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM r WHERE place = n_turns GROUP BY h, n_turns),
k AS (SELECT * FROM w WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.h = w.h AND r.place < r.n_turns))
SELECT k.conv_id, CAST(floor((n.place - 1) / 512) AS BIGINT) AS part, CAST(max(ceil(k.n_turns / 512)) AS BIGINT) AS n_parts, max(k.n_turns) AS n_turns,
       max(k.n_copies) AS n_copies,
       string_agg('<|im_start|>' || n.role || chr(10) || replace(n.text, '<|im_', '<| im_') || '<|im_end|>' || chr(10), '' ORDER BY n.place) AS text
FROM k JOIN n ON n.conv_id = k.conv_id GROUP BY k.conv_id, CAST(floor((n.place - 1) / 512) AS BIGINT)
"""
