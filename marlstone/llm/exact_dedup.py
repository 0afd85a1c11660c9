"""Exact deduplication by composable polynomial fingerprints.

A text is cut into chunks of ``chunk`` bytes. The fingerprint of bytes b_0 b_1
... is the sum of (b_j + 1) * r^j modulo a prime, for two primes. A chunk that
starts at byte s contributes its own value times r^s, so the chunks of one text
are hashed in parallel and combined by a plain sum. Texts of equal length and
fingerprints are then compared chunk by chunk, bytes against bytes, by a
grouped minimum and maximum of each chunk position, which combines before the
shuffle and so never gathers a group in one task. Groups whose chunks differ
are told apart by SHA-256.

Defined cases: NULL text counts as empty, and all empty texts are equal; a row
given twice (same doc_id and text) is one document with two rows, of which one
is kept; a NULL doc_id is a value of its own and smaller than any other; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import flat, staged

#: Two primes below 2^31 and a base for each. Fixed values.
PRIMES = (2147483647, 2147483629)
BASES = (911382323, 972663749)

FIELDS = "doc_id long, sha string, n_bytes long, c1 long, c2 long"


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo prime, by doubling."""
    out = np.ones(max(n, 1), np.int64)
    have = 1
    while have < n:
        step = min(have, n - have)
        out[have:have + step] = out[:step] * pow(base, have, prime) % prime
        have += step
    return out


def _hash_chunks(chunk: int, primes: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [powers(b, p, chunk) for b, p in zip(BASES, primes)]
        for batch in batches:
            data, at = flat(batch.column("piece"))
            first = batch.column("first").to_numpy()
            sums = np.zeros((2, len(first)), np.int64)
            for i in range(len(first)):
                piece = data[at[i]:at[i + 1]].astype(np.int64) + 1
                for k in range(2):
                    own = int(piece @ table[k][:len(piece)]) % primes[k]
                    shift = pow(BASES[k], int(first[i]), primes[k])
                    sums[k, i] = own * shift % primes[k]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("sha"), batch.column("n_bytes"),
                 pa.array(sums[0]), pa.array(sums[1])],
                ["doc_id", "sha", "n_bytes", "c1", "c2"])
    return run


def _pieces(texts: DataFrame, size: int) -> DataFrame:
    """One row for each ``size`` bytes of a text, one row for an empty text."""
    last = F.expr(f"greatest(cast((n_bytes - 1) div {size} as long), 0L)")
    return (texts.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), last)))
            .withColumn("first", F.col("c") * size)
            .withColumn("piece", F.expr(f"substring(bytes, cast(first + 1 as int), {size})"))
            .drop("bytes"))


def fingerprints(docs: DataFrame, chunk: int = 1 << 20,
                 primes: tuple[int, int] = PRIMES) -> DataFrame:
    """doc_id, sha, n_bytes, copies, fp1, fp2: one row for each doc_id and text."""
    texts = docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("bytes"))
    texts = texts.select("doc_id", F.sha2("bytes", 256).alias("sha"),
                         F.octet_length("bytes").cast("long").alias("n_bytes"), "bytes")
    short = (texts.where(F.col("n_bytes") <= chunk)
             .select("doc_id", "sha", "n_bytes", F.lit(0).cast("long").alias("first"),
                     F.col("bytes").alias("piece")))
    # the chunks of a long text are dealt over all tasks
    long = (_pieces(texts.where(F.col("n_bytes") > chunk), chunk)
            .select("doc_id", "sha", "n_bytes", "first", "piece")
            .repartition("doc_id", "first"))
    hashed = short.unionByName(long).mapInArrow(_hash_chunks(chunk, primes), FIELDS)
    n_chunks = F.expr(f"greatest((n_bytes + {chunk - 1}) div {chunk}, 1L)")
    return (hashed.groupBy("doc_id", "sha", "n_bytes")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("c1").alias("c1"), F.sum("c2").alias("c2"))
            .withColumn("copies", F.expr("rows div 1L") / n_chunks)
            .select("doc_id", "sha", "n_bytes", F.col("copies").cast("long").alias("copies"),
                    *[F.expr(f"(c{k} div cast(copies as long)) % {primes[k - 1]}L").alias(f"fp{k}")
                      for k in (1, 2)]))


def differing_groups(docs: DataFrame, prints: DataFrame, compare: int = 1 << 16) -> DataFrame:
    """fp1, fp2, n_bytes of the fingerprints that texts of different bytes share."""
    key = ["fp1", "fp2", "n_bytes"]
    shared = (prints.groupBy(key).agg(F.count(F.lit(1)).alias("members"))
              .where(F.col("members") > 1).drop("members"))
    members = prints.join(shared, key).select(
        "fp1", "fp2", F.col("doc_id").alias("d"), F.col("sha").alias("s"))
    texts = docs.select("doc_id", F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("bytes"))
    texts = texts.withColumn("n_bytes", F.octet_length("bytes").cast("long"))
    found = texts.join(
        members, F.col("doc_id").eqNullSafe(F.col("d")) & (F.sha2("bytes", 256) == F.col("s")))
    return (_pieces(found.drop("doc_id", "d", "s"), compare)
            .groupBy(*key, "c").agg(F.min("piece").alias("least"), F.max("piece").alias("most"))
            .where(F.col("least") != F.col("most")).select(key).distinct())


def exact_dedup(docs: DataFrame, chunk: int = 1 << 20,
                primes: tuple[int, int] = PRIMES) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256. Of equal texts the row with the largest doc_id stays."""
    prints = staged(fingerprints(docs, chunk, primes), "fingerprints")
    differing = staged(differing_groups(docs, prints).withColumn("differs", F.lit(True)), "differing")
    key = ["fp1", "fp2", "n_bytes"]
    classed = (prints.join(differing, key, "left")
               .withColumn("tie", F.when(F.col("differs"), F.col("sha")).otherwise(F.lit(""))))
    groups = (classed.groupBy(*key, "tie")
              .agg(F.max("doc_id").alias("keep_id"), F.sum("copies").alias("group_size")))
    rows = (classed.join(groups, [*key, "tie"])
            .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))))
    return rows.select(
        "doc_id", "keep_id", "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.col("sha").alias("text_sha256"))
