"""Registered queries of this subpackage: each applies one operator, with its
production parameters, to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from histlake.llm import chat, decontaminate, hard_negatives, jaccard_join, lang_id, license_scan, mixing, order_minhash, quality, token_counts, token_files, vector_codes, warc
from histlake.llm.common import cut, held_out, joined, table
from histlake.session import scratch_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents are inserted; then toxic ones are deleted and those of low
    quality revised to single blanks; the first batch, sent again, changes nothing.

    The ledger's id is the row's: doc_id and a 128-bit hash of the rest, so that rows without
    an id and rows that share one are counted each; an equal row again is the same document."""
    content = ["text", "source", "lang"]
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex(F.xxhash64(*content)), F.hex(F.xxhash64(F.lit(1), *content)))
    docs = table(spark, sf_dir, "documents").select("doc_id", row.alias("id"), *content)
    labels = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("quality").alias("quality"))
    ledger = token_counts.Ledger(spark, scratch_dir(spark, "token-ledger"))
    inserts = docs.select("id", *content, F.lit(0).alias("seq"), F.lit("insert").alias("op"))
    ledger.commit("0001-load", inserts)
    toxic, poor = cut(labels.filter("toxic = 1").select("doc_id")), cut(labels.filter("quality = 0 and toxic = 0").select("doc_id"))
    none = [F.lit(None).cast("string").alias(c) for c in content]
    deletes = joined(docs.select("doc_id", "id"), toxic, "doc_id", "inner", toxic.count(), 32).select("id", *none, F.lit("delete").alias("op"))
    revisions = joined(docs, poor, "doc_id", "inner", poor.count(), 32).select(
        "id", F.regexp_replace("text", r"\s+", " ").alias("text"), "source", "lang", F.lit("revise").alias("op"))
    ledger.commit("0002-corrections", deletes.unionByName(revisions).withColumn("seq", F.lit(1)))
    ledger.commit("0001-load", inserts)
    return ledger.totals()


@query
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "start", "n_words", "similarity", "distance")


@query
def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_join(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id").drop("key", "class_key")


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.digest(license_scan.license_scan(table(spark, sf_dir, "documents")))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = cut(quality.with_counts(table(spark, sf_dir, "documents")))
    model = quality.fit(counts.filter(~held_out("id")), quality.corpus_sums(counts), table(spark, sf_dir, "labels"))
    return quality.score(counts, model).select(
        F.col("id").alias("doc_id"), held_out("id").alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(table(spark, sf_dir, "pages"))).withColumnRenamed("key", "page_id")


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", F.col("mix_size").alias("size"), F.col("mix_source_size").alias("source_size"),
                        F.col("mix_target").alias("target"), (F.col("mix_size") * F.col("mix_copies")).alias("taken"))


@query
def op9_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = lang_id.fit(docs.filter(~held_out()))
    return lang_id.predict(docs, model).select("doc_id", held_out().alias("held_out"), "lang_id.*")


@query
def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = order_minhash.with_fingerprint(docs, "text", "fingerprint")
    docs = order_minhash.with_next(docs, "doc_id", {"text": "next_text", "fingerprint": "next_fingerprint"},
                                   4 * int(spark.conf.get("spark.sql.shuffle.partitions")))  # ranges a task: some
    n = F.length("text")
    cut_off = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut_off), F.substring("next_text", F.lit(1), cut_off))
    docs = order_minhash.with_fingerprint(docs.withColumn("edited", edited), "edited", "edited_fingerprint")
    return docs.select(
        "doc_id", n.cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", order_minhash.likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        order_minhash.likeness("fingerprint", "next_fingerprint").alias("near_next"))


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.select("vec_id", label.alias("label"), "embedding"), "vec_id", "embedding", "label", F.col("id") % 100 == 0)


@query
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), path)
    return token_files.documents(token_files.read(spark, path)).withColumnRenamed("id", "doc_id")


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vector_codes.integers(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"), "embedding", 1024).drop("embedding")
    books = vector_codes.fit(rows, "vec_id")
    coded = cut(vector_codes.encode(rows, books))
    return vector_codes.with_group_error(coded, "label").select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


ORACLES["op2_chat_format"] = chat.ORACLE
ORACLES["op8_mixing"] = mixing.ORACLE
ORACLES["op11_hard_negatives"] = hard_negatives.ORACLE
ORACLES["op13_vector_codes"] = vector_codes.ORACLE
