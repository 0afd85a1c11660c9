"""Helpers shared by the operators: reading a table, staging an intermediate
table in the shared folder, and views of Arrow text columns as NumPy bytes."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Word characters of the n-gram operators: digits, letters and everything
#: beyond ASCII, after A-Z are lower-cased. Fixed values.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NON_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, named by
    ``spark.checkpoint.dir``. Where that is unset, a local session (tests) gets
    a fresh temporary folder; any other session raises."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="marlstone-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: its
    lineage ends there, so a lost executor costs no more than the step at
    hand, and later steps see one fixed set of rows."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/marlstone-{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_column(text) -> Column:
    """Array of lower-cased words of a text column; NULL and empty texts have
    none."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(low, NON_WORD), lambda w: w != "")


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column end to end, and the n + 1 offsets of its
    rows. NULL counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)
    at = at[column.offset:column.offset + len(column) + 1].astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), at * 0
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]]
    return data, at - at[0]


def row_slices(offsets: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``limit`` bytes together, one row at least."""
    n, lo = len(offsets) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The groups of sorted rows with equal ``key``, one by one."""
    rest: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([rest, now]).combine_chunks() if rest is not None else now
        key = now["key"].to_numpy()
        cut = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()]
        for lo, hi in zip(cut, cut[1:]):
            yield now.slice(lo, hi - lo)
        rest = now.slice(cut[-1]) if len(key) else rest
    if rest is not None and len(rest):
        yield rest


def key_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, list[int]]]:
    """Sorted rows in tables of whole groups with equal ``key``, and the offsets
    of the groups in each: many small groups cost one conversion."""
    rest: pa.Table | None = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([rest, now]) if rest is not None else now
        key = now["key"].to_numpy()
        cut = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()]
        if len(cut) > 1:
            yield now.slice(0, cut[-1]).combine_chunks(), cut
        rest = now.slice(cut[-1]) if len(key) else rest
    if rest is not None and len(rest):
        yield rest.combine_chunks(), [0, len(rest)]


def package_path(path: str) -> str:
    """Place of a vocabulary file of the public tokenizers by its name; a path
    stays as it is."""
    if os.path.sep in path:
        return path
    import public_tokenizers
    return public_tokenizers.path(path)


#: Bits of the filters below: 8 MB, whatever they are built from.
FILTER_BITS = 1 << 26


def _bit(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FILTER_BITS))


def bit_filter(df: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of the hashed keys of ``df``: bucket, bits; 2,048 rows of 4 KB
    at most."""
    at = df.select(_bit(keys).alias("at"))
    return (at.groupBy(F.bitmap_bucket_number("at").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")))


def maybe_in(df: DataFrame, keys: list[str], bits: DataFrame, other: bool = False):
    """Rows of ``df`` whose keys may be in the filter: all that are, and few
    others; with ``other`` also the rest. It spares a shuffle of rows that a
    join with the keys would drop; the broadcast has the fixed size of the
    filter."""
    at = _bit(keys)
    marked = df.withColumn("_bit", F.bitmap_bit_position(at)).withColumn("_bucket", F.bitmap_bucket_number(at))
    joined = marked.join(F.broadcast(bits.withColumnRenamed("bucket", "_bucket")), "_bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(bits, cast(_bit div 8 + 1 as int), 1)")), 16, 10).cast("int")
    hit = F.coalesce(F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1") == 1, F.lit(False))
    tested = joined.withColumn("_byte", byte).withColumn("_hit", hit)
    inner = ["_bit", "_bucket", "bits", "_byte", "_hit"]
    maybe = tested.where("_hit").drop(*inner)
    return (maybe, tested.where(~F.col("_hit")).drop(*inner)) if other else maybe


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id and text_key (a 64-bit hash of the text)
    are not in ``gone``; only rows that may be are shuffled."""
    key = ["doc_id", "text_key"]
    maybe, rest = maybe_in(docs, key, bit_filter(gone, key), other=True)
    named = gone.select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k")).distinct()
    return rest.unionByName(maybe.join(
        named, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k")), "left_anti"))
