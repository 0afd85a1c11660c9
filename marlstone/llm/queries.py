"""The registered queries of this package; their SQL is in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import staged, table
from marlstone.llm.decontamination import decontaminate
from marlstone.llm.exact_dedup import exact_dedup
from marlstone.llm.jaccard_join import jaccard_join
from marlstone.llm.language_id import identify
from marlstone.llm.language_model import language_model
from marlstone.llm.line_dedup import line_dedup
from marlstone.llm.oracle import ORACLE_SQL  # noqa: F401  (part of the registry)
from marlstone.llm.packing import pack_documents
from marlstone.llm.periodic_runs import periodic_runs, run_digest
from marlstone.llm.pii import pseudonymise
from marlstone.llm.prefix_trie import numbered_turns, prefix_trie, rebuilt_turns
from marlstone.llm.sharding import shard_documents
from marlstone.llm.suffix_dedup import suffix_dedup
from marlstone.llm.toxicity import toxicity

Query = Callable[[SparkSession, str], DataFrame]


def _remainder(modulus: int) -> F.Column:
    """crc32 of doc_id as text; that of NULL counts as 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus, F.lit(0))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents")).drop("text_key")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a deployment passes its own key
    done = pseudonymise(table(spark, sf_dir, "documents"), key="marlstone")
    return done.select("doc_id", "text", "n_values", "kinds")


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model(table(spark, sf_dir, "documents"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = line_dedup(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_lines", "n_removed",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", (_remainder(5) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         F.size("spans").cast("long").alias("n_spans"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = staged(numbered_turns(table(spark, sf_dir, "conversations")), "numbered")
    return prefix_trie(rebuilt_turns(own), own.select("conv").distinct())


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` in which the words of a tenth of the texts repeat from word a on with
    period p, as the contract of op12 has it (a, p from crc32 of doc_id)."""
    code = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(0).cast("long"))
    split = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    worded = docs.select("doc_id", "text", code.alias("h"), F.when(code % 10 == 0, split).alias("w"))
    g = F.expr("h div 10")
    sized = worded.withColumn("n", F.coalesce(F.size("w"), F.lit(0))).where("h % 10 = 0 AND n > 0")
    sized = sized.withColumn("a", (g % F.col("n")).cast("int"))
    sized = sized.withColumn("p", F.expr("cast(1 + (n - a) div (3 + (h div 10) % 8) as int)"))
    tail = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.expr("cast((n - a + p - 1) div p as int)")))
    planted = F.concat(F.slice("w", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), F.col("n") - F.col("a")))
    others = docs.where((code % 10 != 0) | F.col("text").isNull() | ~F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return others.select("doc_id", "text").unionByName(sized.select("doc_id", F.array_join(planted, " ").alias("text")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digest(periodic_runs(with_repeats(table(spark, sf_dir, "documents"))))


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), shards=24)


QUERIES: dict[str, Query] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_decontamination": op2_decontamination,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_pii": op4_pii,
    "op5_language_model": op5_language_model,
    "op6_language_id": op6_language_id,
    "op7_line_dedup": op7_line_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_packing": op10_packing,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_sharding": op13_sharding,
}
