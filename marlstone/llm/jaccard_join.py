"""Jaccard self-join of documents on word shingles by chosen paths.

A document's set is that of its five-word shingles (fewer words: one shingle of
all), as 64-bit hashes. Documents with the same set are one record. A record is
embedded as ``COORDINATES`` smallest hashes; the tokens of that embedding are
(coordinate, value), and two records share each token with a probability of
their similarity. From the root of each run a record takes the paths of the
tokens that a hash of (path, token) selects, 1 / ``RATE`` of them on average;
records on one path form a bucket. Buckets of up to ``limit`` records are
compared pair by pair. Larger ones are split again by further tokens, until
they are small, stop shrinking or are ``depth`` tokens deep. A bucket one of whose
parts is still large and nearly as large as itself holds records that are alike: it
is compared as it is, once, in place of its parts, which hold no other pairs. What
is large is compared in pairs of blocks, so no task holds it whole. Runs are repeated so that a pair of the least
similarity shares a bucket with the target probability even at full depth.

A pair that passes the embedding's estimate is verified by the exact sets in
the first bucket that both records have in common, and only there, so each
link counts once although no list of pairs is ever written: a bucket returns
its records' numbers of links and a spanning forest.

Defined cases: a NULL text or one without words has no shingle, no link and is
a class of its own; rows given twice are copies of each other; class_id is the
least doc_id of the class (NULL if all are); other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import bit_filter, by_key, flat, maybe_in, row_slices, staged, without
from marlstone.llm.components import components

SHINGLE, COORDINATES, RATE = 5, 64, 0.6
#: A pair is verified if so large a part of the coordinates agrees; at a
#: similarity of 0.8 that is four standard deviations below.
ESTIMATE = 0.6

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_BASE = 0x2545F4914F6CDD1D
_INVERSE = pow(_BASE, -1, 1 << 64)
_WORD = np.zeros(256, bool)
_WORD[ord("0"):ord("9") + 1] = _WORD[ord("a"):ord("z") + 1] = _WORD[128:] = True


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Shingle hashes of the texts of a batch, by vector operations. A word's
    hash is a polynomial of its bytes modulo 2^64, mixed."""

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            for name, base in (("power", _BASE), ("inverse", _INVERSE)):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def __call__(self, data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
        """Sorted distinct hashes of each text."""
        self._grow(len(data) + 1)
        low = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
        inside = _WORD[low]
        if len(low):
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            borders = at[(at > 0) & (at < len(low))]
            first[borders] = inside[borders]  # words end with their text
            last = inside.copy()
            last[:-1] &= ~inside[1:]
            last[borders - 1] = inside[borders - 1]
            starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        else:
            starts = ends = np.zeros(0, np.int64)
        sums = np.zeros(len(low) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * self.power[:len(low)], out=sums[1:])
        words = mixed((sums[ends] - sums[starts]) * self.inverse[starts])
        of = np.searchsorted(starts, at)  # words before each text
        grams = np.zeros(max(len(words) - SHINGLE + 1, 0), np.uint64)
        for k in range(SHINGLE):
            grams = mixed(grams + words[k:len(words) - SHINGLE + 1 + k] * _M1 + np.uint64(k))
        out = []
        for lo, hi in zip(of[:-1].tolist(), of[1:].tolist()):
            if hi - lo >= SHINGLE:
                out.append(np.unique(grams[lo:hi - SHINGLE + 1]))
            else:
                one = np.full(min(hi - lo, 1), hi - lo, np.uint64)
                for k in range(lo, hi):
                    one = mixed(one + words[k:k + 1] * _M1)
                out.append(one)
        return out


def embedding(sets: list[np.ndarray]) -> np.ndarray:
    """Smallest hashes of each non-empty set, one row each."""
    rng = np.random.default_rng(11)
    odd = rng.integers(0, 1 << 32, COORDINATES, np.uint32) | np.uint32(1)
    turn = rng.integers(0, 1 << 32, COORDINATES, np.uint32)
    flat_ = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    ends = np.cumsum([len(s) for s in sets])
    starts = ends - [len(s) for s in sets]
    out = np.empty((len(sets), COORDINATES), np.uint32)
    for k in range(COORDINATES):
        out[:, k] = np.minimum.reduceat((flat_ ^ turn[k]) * odd[k], starts)
    return out


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        data, at = flat(batch.column("text"))
        size, record, sig = [], [], []
        for lo, hi in row_slices(at, 1 << 19):
            sets = shingler(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])
            size += [len(s) for s in sets]
            record += [int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)
                       for s in sets]
            some = [s for s in sets if len(s)]
            rows = iter(embedding(some) if some else ())
            sig += [next(rows).tobytes() if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(size, pa.int64()),
             pa.array(record, pa.int64()), pa.array(sig, pa.binary())],
            ["doc_id", "text_key", "size", "record", "sig"])


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    shingler = Shingler()
    for batch in batches:
        data, at = flat(batch.column("text"))
        out = []
        for lo, hi in row_slices(at, 1 << 19):
            out += [s.tobytes() for s in shingler(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo])]
        yield pa.RecordBatch.from_arrays([batch.column("record"), pa.array(out, pa.binary())],
                                         ["record", "shingles"])


def _signatures(column: pa.Array) -> np.ndarray:
    data, _ = flat(column)
    return data.view(np.uint32).reshape(-1, COORDINATES)


def _split(runs: int):
    """Next paths of records: each token that the hash of its path selects."""
    limit = np.uint64(int(2.0 ** 64 / (RATE * COORDINATES)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.arange(COORDINATES, dtype=np.uint64) << np.uint64(32)
        for batch in batches:
            ids = batch.column("record").to_numpy()
            token = mixed(_signatures(batch.column("sig")).astype(np.uint64) | place)
            parent = batch.column("n").to_numpy()
            paths = ([batch.column("path").to_numpy().view(np.uint64)] if not runs else
                     [np.full(len(ids), r + 1, np.uint64) for r in range(runs)])
            for path in paths:
                h = mixed(mixed(path * _M1)[:, None] ^ token)
                row, col = np.nonzero(h < limit)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mixed(h[row, col] + _M1).view(np.int64)), pa.array(ids[row]),
                     pa.array(parent[row]), pa.array(path[row].view(np.int64))],
                    ["path", "record", "parent", "above"])
    return run


def survival(similarity: float, depth: int) -> float:
    """Least probability that a pair of that similarity stays together on some
    path down to ``depth`` tokens."""
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-similarity / RATE * p)
    return p


def _close(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows, i < j, that the embedding takes for alike."""
    sig = _signatures(group["sig"].combine_chunks())
    part, low, high = (group[c].to_numpy() for c in ("part", "low", "high"))
    out_i, out_j = [], []
    for lo in range(0, len(sig), 64):
        agree = (sig[lo:lo + 64, None, :] == sig[None, :, :]).sum(axis=2)
        near = agree >= ESTIMATE * COORDINATES
        i, j = np.nonzero(near)
        i = i + lo
        on = (i < j) & ((low[i] == high[i]) | (part[i] != part[j]))
        out_i.append(i[on])
        out_j.append(j[on])
    return np.concatenate(out_i), np.concatenate(out_j)


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """path, record of the records with an apparent partner."""
    paths, records = [], []
    for group in by_key(batches):
        i, j = _close(group)
        on = np.unique(np.concatenate([i, j]))
        paths.append(group["path"].to_numpy()[on])
        records.append(group["record"].to_numpy()[on])
        if len(paths) >= 4096:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(paths)), pa.array(np.concatenate(records))],
                                             ["path", "record"])
            paths, records = [], []
    if paths:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(paths)), pa.array(np.concatenate(records))],
                                         ["path", "record"])


def _links(similarity: float):
    """record, links, root: of each key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_key(batches):
            pairs = list(zip(*(x.tolist() for x in _close(group))))
            if not pairs:
                continue
            record, copies = group["record"].to_numpy(), group["copies"].to_numpy()
            own = int(group["path"][0].as_py())
            shingles = group["shingles"].combine_chunks()
            used = {x for p in pairs for x in p}
            sets = {x: np.frombuffer(shingles[x].as_py(), np.uint64) for x in used}
            buckets = {x: set(group["paths"][x].as_py()) for x in used}
            links, root = np.zeros(len(record), np.int64), list(range(len(record)))

            def top(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x
            for i, j in pairs:
                if min(buckets[i] & buckets[j]) != own:
                    continue
                a, b = sets[i], sets[j]
                if min(len(a), len(b)) < similarity * max(len(a), len(b)):
                    continue
                both = len(np.intersect1d(a, b, assume_unique=True))
                if both >= similarity * (len(a) + len(b) - both):
                    links[i] += copies[j]
                    links[j] += copies[i]
                    root[top(i)] = top(j)
            on = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(record[on]), pa.array(links[on]), pa.array(record[[top(x) for x in on.tolist()]]
                                                                     if len(on) else on)],
                ["record", "links", "root"])
    return run


def _dealt(buckets: DataFrame, block: int) -> DataFrame:
    """Rows by key: a small bucket is one key, a large one a key for each pair
    of its blocks. part, low, high: a row's block and the blocks of the key."""
    parts = F.greatest(F.expr(f"cast((n + {block - 1}) div {block} as int)"), F.lit(1))
    return (buckets.withColumn("parts", parts)
            .withColumn("part", F.pmod(F.xxhash64("record"), F.col("parts")).cast("int"))
            .withColumn("o", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .withColumn("low", F.least("part", "o")).withColumn("high", F.greatest("part", "o"))
            .withColumn("key", F.xxhash64("path", "low", "high")).drop("parts", "o", "n"))


def buckets_of(records: DataFrame, runs: int, depth: int, limit: int) -> DataFrame:
    """path, record, n: buckets of two records at least, each set of records
    once. ``records`` has record and sig."""
    shape = "path long, record long, parent long, above long"
    total = records.count()
    rows = records.withColumn("n", F.lit(total).cast("long")).mapInArrow(_split(runs), shape)
    done, large = [], None
    stuck = (F.col("n") > limit) & (F.col("n") > 0.8 * F.col("parent"))
    for level in range(1, depth + 1):
        rows = staged(rows, f"paths{level}")
        counts = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
        met = staged(rows.join(counts, "path"), f"buckets{level}")
        if large is not None:  # stuck parts give way to the bucket that they are parts of
            whole = staged(met.where(stuck).select("above").distinct(), f"whole{level}")
            done.append(large.join(whole.withColumnRenamed("above", "path"), "path", "left_semi"))
            met = met.join(whole, "above", "left_anti")
        more = (F.col("n") > limit) & ~stuck if level < depth else F.lit(False)
        done.append(met.where(~more).select("path", "record", "n"))
        large = met.where(more).select("path", "record", "n")
        if level == depth or large.isEmpty():
            break
        rows = large.join(records, "record").mapInArrow(_split(0), shape)
    all_ = done[0]
    for d in done[1:]:
        all_ = all_.unionByName(d)
    same = all_.groupBy("path").agg(F.max("n").alias("n"), F.bit_xor(F.xxhash64("record")).alias("x"),
                                    F.bit_xor(F.xxhash64("record", F.lit(1))).alias("y"))
    once = same.groupBy("n", "x", "y").agg(F.min("path").alias("path")).select("path")
    return all_.join(once, "path")


def jaccard_join(docs: DataFrame, similarity: float = 0.8, recall: float = 0.99, depth: int = 3,
                 limit: int = 128, block: int = 1024) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_shingles, class_id,
    n_links (rows of a similarity of ``similarity`` or more). A greater ``depth``
    splits buckets of unlike records further and needs more runs for the same
    recall; alike records share every run's buckets either way."""
    runs = math.ceil(math.log(1 - recall) / math.log(1 - survival(similarity, depth)))
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = keyed.withColumn("text_key", F.xxhash64("text"))
    kind = dict(docs.dtypes)["doc_id"]
    rows = staged(keyed.mapInArrow(
        _sketches, f"doc_id {kind}, text_key long, size long, record long, sig binary"), "sketches")
    records = staged(rows.where("size > 0").groupBy("record")
                     .agg(F.count(F.lit(1)).alias("copies"), F.first("sig").alias("sig"),
                          F.max("text_key").alias("text_key")), "records")
    met = staged(buckets_of(records.select("record", "sig"), runs, depth, limit), "met")
    dealt = _dealt(met, block).join(records.select("record", "sig"), "record")
    sorted_ = dealt.repartition("key").sortWithinPartitions("key")
    near = staged(sorted_.mapInArrow(_candidates, "path long, record long").distinct(), "near")
    # the sets of the records that are left, from one text of each
    wanted = staged(near.groupBy("record").agg(F.collect_set("path").alias("paths"))
                    .join(records, "record"), "wanted")
    key = ["text_key"]
    texts = (maybe_in(keyed.select("text_key", "text"), key, bit_filter(wanted.select(key), key))
             .join(wanted.select("record", "text_key"), "text_key").dropDuplicates(["record"])
             .select("record", "text"))
    sets = staged(texts.mapInArrow(_shingle_sets, "record long, shingles binary"), "sets")
    rest = near.join(near.groupBy("path").agg(F.count(F.lit(1)).alias("n")), "path")
    full = (_dealt(rest, block).join(wanted.select("record", "copies", "sig", "paths"), "record")
            .join(sets, "record").repartition("key").sortWithinPartitions("key"))
    found = staged(full.mapInArrow(_links(similarity), "record long, links long, root long"), "links")
    linked = components(found.select(F.col("record").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("record").agg(F.sum("links").alias("links"))
    classed = (records.select("record", "copies").join(links, "record", "left")
               .join(linked.withColumnRenamed("node", "record"), "record", "left")
               .select("record", F.coalesce("component", "record").alias("class"),
                       (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    named = rows.drop("sig").join(classed, "record", "left")
    named = staged(named, "classed")
    of = named.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("class_id"))
    return (named.join(of, "class", "left")
            .select("doc_id", "text_key", F.col("size").alias("n_shingles"),
                    F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def jaccard_dedup(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each class: that with the least doc_id,
    of its texts the one with the least hash. A document without words stays. A row
    given twice stays once if its class has words."""
    result = staged(jaccard_join(docs, **options).where("n_shingles > 0"), "joined")
    heads = (result.where(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("class_id")
             .agg(F.min("text_key").alias("head")))
    marked = (result.groupBy("doc_id", "text_key", "class_id").agg(F.count(F.lit(1)).alias("n"))
              .join(heads.withColumnRenamed("class_id", "c"), F.col("class_id").eqNullSafe(F.col("c"))))
    head = F.col("doc_id").eqNullSafe(F.col("class_id")) & (F.col("text_key") == F.col("head"))
    marked = staged(marked.select("doc_id", "text_key", (head & (F.col("n") > 1)).alias("again"), head.alias("head"))
                    .where(~F.col("head") | F.col("again")), "marked")
    nested = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id",
                         F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    kept = without(nested, marked)
    again = marked.where("again").select(F.col("doc_id").alias("_d"), F.col("text_key").alias("_k"))
    once = (maybe_in(nested, ["doc_id", "text_key"], bit_filter(marked.where("again"), ["doc_id", "text_key"]))
            .join(again, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_key") == F.col("_k")), "left_semi")
            .dropDuplicates(["doc_id", "text_key"]))
    return kept.unionByName(once).select("_row.*")
