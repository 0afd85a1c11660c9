"""Periodic runs of words by recursive frequency splitting and a lag scan.

A run is a stretch of consecutive words in which words q apart are identical, q
its smallest period, of max(``least``, ``repeats`` * q) words or more, and as long as it can be.
Every word of a run therefore occurs ``repeats`` times or more in it. A word
that occurs less often in its segment (at first the whole text) joins no run
and splits the segment; the parts are counted anew, until no segment is split.
The segments that survive are scanned lag by lag.

The scan of a segment for lag q cuts it into blocks of q words, compares
neighbouring blocks by hashes (a run holds three whole blocks) and then, where two
neighbours in a row agree, the words themselves from a block before to a block
after. All lags of n words take n log n comparisons. A stretch inside a run of a smaller
period is that run again and left out. Hashes only select: equal blocks always have
equal hashes, and words decide.

Words are ``[^\\x20\\x09-\\x0D]+``. A text is scanned whole in one task, texts are dealt
by Spark; memory follows the longest text. Splitting ends after ``ROUNDS`` rounds at the
latest, since it only spares the scan work: the segments at hand are then scanned.

Defined cases: NULL and empty texts have no words and no runs; rows given twice
give a row each; NULL doc_ids stay; two runs that overlap are both found, and a word
goes if any of them drops it; further columns stay as they are, the operator's own
names are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marlstone.llm.common import flat, row_slices

ROUNDS = 64
#: An odd multiplier of the block hashes. Fixed value.
BASE = np.uint64(0x9E3779B97F4A7C15)
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _powers(n: int) -> np.ndarray:
    """BASE^0 ... BASE^n modulo 2^64."""
    out = np.full(n + 1, BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def stretches(on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the stretches of True."""
    edge = np.diff(np.concatenate([[False], on, [False]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def split_segments(codes: np.ndarray, segment: np.ndarray, repeats: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the segments in which every word occurs ``repeats``
    times; ``segment`` numbers the segments at the start, in order."""
    place, done = np.arange(len(codes)), []
    n_codes = np.int64(codes.max(initial=0)) + 1
    for turn in range(ROUNDS + 1):
        if not len(place):
            break
        _, of, count = np.unique(segment * n_codes + codes[place], return_inverse=True, return_counts=True)
        stays = count[of] >= repeats
        # segments that lose no word are final, the parts of the others are counted anew
        split = np.zeros(int(segment[-1]) + 1, bool)
        split[segment[~stays]] = True
        final = ~split[segment] if turn < ROUNDS else np.ones(len(place), bool)
        first = np.flatnonzero(final & (np.diff(segment, prepend=-1) != 0))
        last = np.flatnonzero(final & (np.diff(segment, append=-1) != 0))
        done.append(np.stack([place[first], place[last] + 1]))
        stays &= ~final
        place, segment = place[stays], segment[stays]
        new = (np.diff(place, prepend=-2) != 1) | (np.diff(segment, prepend=-1) != 0)
        segment = np.cumsum(new) - 1
        large = np.bincount(segment, minlength=1)[segment] >= least
        place, segment = place[large], segment[large]
        segment = np.cumsum(np.diff(segment, prepend=-1) != 0) - 1
    found = np.concatenate(done, axis=1) if done else np.zeros((2, 0), np.int64)
    found = found[:, found[1] - found[0] >= least]
    return found[0], found[1]


def scan_segment(words: np.ndarray, power: np.ndarray, repeats: int, least: int) -> list[tuple[int, int, int]]:
    """start, length, period of the runs of one segment (numbers for words)."""
    n = len(words)
    if (words == words[0]).all():
        return [(0, n, 1)]
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(31)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed * power[:n], dtype=np.uint64)])
    runs: list[tuple[int, int, int]] = []
    starts, ends, known = np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def inside(lo: int, hi: int) -> bool:
        nonlocal starts, ends, known
        if known < len(runs):
            order = sorted((s, s + size) for s, size, _ in runs)
            starts = np.array([s for s, _ in order])
            ends, known = np.maximum.accumulate([e for _, e in order]), len(runs)
        at = int(np.searchsorted(starts, lo, "right")) - 1
        return at >= 0 and ends[at] >= hi

    for q in range(1, n // repeats + 1):
        block = np.diff(sums[::q])
        same = block[1:] == block[:-1] * power[q]
        if not (same[1:] & same[:-1]).any():
            continue
        found = []
        for k0, k1 in zip(*stretches(same)):
            if k1 - k0 < 2 or inside(k0 * q, (k1 + 1) * q):
                continue
            lo, hi = max(0, (k0 - 1) * q), min(n, (k1 + 2) * q)
            for s, e in zip(*stretches(words[lo:hi - q] == words[lo + q:hi])):
                size = int(e - s) + q
                if size >= max(least, repeats * q) and not inside(lo + s, lo + s + size):
                    found.append((int(lo + s), size, q))
        runs += dict.fromkeys(found)
    return runs


def runs_of(codes: np.ndarray, at: np.ndarray, repeats: int, least: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each text, by start, then period; ``at`` has the offsets of the
    texts' words in ``codes``."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(at) - 1)]
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    lows, highs = split_segments(codes, text, repeats, least)
    power = _powers(int((highs - lows).max(initial=0)))
    for lo, hi in zip(lows.tolist(), highs.tolist()):
        first = int(at[text[lo]])
        out[text[lo]] += [(s + lo - first, size, q) for s, size, q in
                          scan_segment(codes[lo:hi], power, repeats, least)]
    return [sorted(x, key=lambda r: (r[0], r[2])) for x in out]


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words), bool)
    for start, size, q in runs:
        gone[start + q:start + size] = True
    return b" ".join([words[i] for i in np.flatnonzero(~gone).tolist()])


def _scan(repeats: int, least: int, slice_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat(batch.column("text"))
            rows = batch.column("row")
            for lo, hi in row_slices(at, slice_bytes):
                # bytes.split() parts at exactly 0x20 and 0x09-0x0D
                words = [data[at[i]:at[i + 1]].tobytes().split() for i in range(lo, hi)]
                ends = np.cumsum([0, *map(len, words)])
                codes = pa.array([w for x in words for w in x], pa.large_binary()).dictionary_encode().indices
                runs = runs_of(codes.to_numpy().astype(np.int64), ends, repeats, least)
                kept = [_collapsed(w, r) for w, r in zip(words, runs)]
                named = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(lo, hi - lo), pa.array(np.diff(ends)), pa.array(named, pa.list_(RUN)),
                     pa.array(kept, pa.binary()).cast(pa.string())], ["row", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, repeats: int = 4, least: int = 6, slice_bytes: int = 1 << 22) -> DataFrame:
    """The columns of ``docs`` but ``text``, and n_words, runs (start, length,
    period; by start, then period) and collapsed: the words that stay, joined by one
    space. A word stays unless a run holds it after that run's first ``period`` words."""
    if repeats < 4:
        raise ValueError("the scan needs three whole blocks in a run: repeats must be 4 or more")
    own = ("text", "n_words", "runs", "collapsed")
    others = [c for c in docs.columns if c not in own]
    nested = docs.select(F.struct(*others).alias("row"), F.col("text").cast("string").alias("text"))
    fields = (T.StructType([nested.schema["row"]]).add("n_words", "long").add("runs", T.DataType.fromDDL(RUNS))
              .add("collapsed", "string"))
    done = nested.mapInArrow(_scan(repeats, least, slice_bytes), fields)
    return done.select(*[F.col("row").getField(c).alias(c) for c in others], "n_words", "runs", "collapsed")


def run_digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (ties: smallest start, then period), and
    SHA-256 of the list of runs and of the collapsed text."""
    longest = F.aggregate(
        "runs", F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>"),
        lambda best, r: F.when(best.isNull() | (r["length"] > best["length"]), r).otherwise(best))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat_ws("", F.transform(lines, lambda s: F.concat(s, F.lit("\n"))))
    best = found.withColumn("best", longest)
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"),
        F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
