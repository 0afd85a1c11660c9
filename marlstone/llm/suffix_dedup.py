"""Removal of repeated byte strings by bucket refinement.

A string of ``length`` bytes is removed wherever it stands if it starts at two
places or more. Strings are told apart as in bucket-pointer refinement: an
initial bucket for each q-gram (q = length / 16), then four refinements, each
from a position's own bucket and the bucket of the position as far behind as the
buckets reach, so that every round doubles the depth and reuses the last one's
result. Buckets are named by a hash of the pair instead of a rank, so a text
refines its positions by itself and only names are shuffled and grouped.

Not every position takes part. Of the length / 2 + 1 strings of half the
length inside a string, the one with the least name is its anchor. Equal strings
have equal anchors at the same offset, so only anchors, about one in a hundred
positions, are shuffled, and anchors met once are dropped. An anchor stands for
the range of starts whose strings have it; what follows are refinements of
these ranges:

1. Anchors with the same offsets and the same bytes over their whole range:
   all their starts are repeated. This settles the inside of long repeats.
2. Where an anchor is shared by ranges that differ, one anchor of each kind is
   cut into blocks of ``BLOCK`` offsets; blocks of equal bytes are repeated,
   those whose common part is met once are dropped.
3. What is left, blocks on the edge of a repeat, is compared start by start.

All groups are counted before they are shuffled, and joined back by tables of one
row for each group, so a string that a third of the texts share is no single
task's work. The results are exact but for collisions of the names (128 bits
decide in each step).

Defined cases: NULL text counts as empty; texts shorter than ``length`` stay as
they are; rows given twice (same doc_id and text) repeat each other; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import bit_filter, flat, maybe_in, staged

BLOCK = 16
#: Bytes of text that are refined at once; positions must fit in 24 bits.
SLICE = 1 << 20
#: Odd multipliers of the two families of names. Fixed values.
SEEDS = (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25)
_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def first_buckets(data: np.ndarray, q: int, seed: int) -> np.ndarray:
    """Names of the q-grams from each position on."""
    x = np.zeros(max(len(data) - q + 1, 0), np.uint64)
    for k in range(q):
        x *= np.uint64(seed)
        x += data[k:len(data) - q + 1 + k]
    return mixed(x)


def refined(buckets: np.ndarray, step: int) -> np.ndarray:
    """Names of strings twice as deep."""
    n = max(len(buckets) - step, 0)
    return mixed(buckets[:n] * _M1 + buckets[step:step + n])


def names(data: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Names of the strings of half the length and of the length."""
    step = length // 16
    half = first_buckets(data, step, seed)
    while step < length // 2:
        half = refined(half, step)
        step *= 2
    return half, refined(half, step)


def pair(a: np.ndarray, b: np.ndarray, *more: np.ndarray) -> np.ndarray:
    out = mixed(a * _M1 + b)
    for c in more:
        out = mixed(out * _M1 + c.astype(np.uint64))
    return out.view(np.int64)


def text_slices(at: np.ndarray, overlap: int) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Rows, and byte ranges of them, of about SLICE bytes together. A long
    text comes in several ranges, each longer by ``overlap`` than what is new."""
    rows, lows, highs, total = [], [], [], 0
    for i in range(len(at) - 1):
        n = int(at[i + 1] - at[i])
        for lo in range(0, max(n, 1), SLICE):
            hi = min(lo + SLICE + overlap, n)
            rows.append(i)
            lows.append(lo)
            highs.append(hi)
            total += hi - lo
            if total >= SLICE:
                yield rows, np.array(lows), np.array(highs)
                rows, lows, highs, total = [], [], [], 0
    if rows:
        yield rows, np.array(lows), np.array(highs)


def anchors(data: np.ndarray, lens: np.ndarray, length: int):
    """For texts end to end: text number, anchor, first and last start (within
    the text), name of the anchor, name of the whole range."""
    half, full = names(data, length, SEEDS[0])
    width = length // 2 + 1
    low = np.uint64(24)
    least = ((half >> low) << low) | np.arange(len(half), dtype=np.uint64)
    k = 1
    while 2 * k <= width:
        least = np.minimum(least[:-k], least[k:])
        k *= 2
    if width > k:
        least = np.minimum(least[:len(least) - (width - k)], least[width - k:])
    begin = np.cumsum(lens) - lens
    inside = np.zeros(len(data) + 1, np.int64)
    has = lens >= length
    np.add.at(inside, begin[has], 1)
    np.add.at(inside, (begin + lens - length + 1)[has], -1)
    start = np.flatnonzero(np.cumsum(inside)[:len(least)] > 0)
    at = (least[start] & np.uint64((1 << 24) - 1)).astype(np.int64)
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    old = np.r_[new[1:] - 1, len(at) - 1]
    at, first, last = at[new], start[new], start[old]
    text = np.searchsorted(begin + lens, at, "right")
    whole = pair(full[first], full[last], at - first, at - last)
    return text, at - begin[text], first - begin[text], last - begin[text], half[at].view(np.int64), whole


def _anchor_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, at = flat(batch.column("text"))
            uid = batch.column("uid").to_numpy()
            for rows, lo, hi in text_slices(at, length - 1):
                parts = [data[at[r] + x:at[r] + y] for r, x, y in zip(rows, lo, hi)]
                lens = np.array([len(p) for p in parts])
                if lens.max(initial=0) < length:
                    continue
                text, a, first, last, gram, whole = anchors(np.concatenate(parts), lens, length)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(uid[np.array(rows)[text]]), pa.array(a + lo[text]),
                     pa.array((a - last).astype(np.int32)), pa.array((a - first).astype(np.int32)),
                     pa.array(gram), pa.array(whole)],
                    ["uid", "a", "lo", "hi", "gram", "whole"])
    return run


def _places(batches: Iterator[pa.RecordBatch], length: int):
    """Slices of texts with names of both families: the uids, anchors as index
    of the slice and in their text, their ranges, the texts' bounds in the slice."""
    for batch in batches:
        data, at = flat(batch.column("text"))
        uid = batch.column("uid").to_numpy()
        marks = batch.column("marks").to_pylist()
        size = np.diff(at)
        for rows, lo, hi in text_slices(at, 4 * length):
            keep: list[tuple[int, dict]] = []
            for k, r in enumerate(rows):
                # an anchor belongs to the one range that holds it 2 * length from the edges
                low = lo[k] + 2 * length if lo[k] else 0
                high = lo[k] + SLICE + 2 * length
                keep += [(k, m) for m in marks[r] if low <= m["a"] < high]
            if not keep:
                continue
            parts = [data[at[r] + x:at[r] + y] for r, x, y in zip(rows, lo, hi)]
            begin = np.cumsum([0, *[len(p) for p in parts]])[:-1]
            bytes_ = np.concatenate(parts)
            k = np.array([k for k, _ in keep])
            a = np.array([m["a"] for _, m in keep])
            shift = begin[k] - lo[k]
            yield (uid[np.array(rows)[k]], a, shift, size[np.array(rows)[k]], [m for _, m in keep],
                   [names(bytes_, length, s) for s in SEEDS])


def _blocks(length: int):
    """Blocks of offsets of anchors: their common part and their whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uid, a, shift, size, marks, families in _places(batches, length):
            lo = np.array([m["lo"] for m in marks]) // BLOCK
            n = np.array([m["hi"] for m in marks]) // BLOCK - lo + 1
            of = np.repeat(np.arange(len(n)), n)
            block = lo[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            a_, size_, shift_ = a[of], size[of], shift[of]
            # offsets whose strings lie in the text
            low = np.maximum(block * BLOCK, a_ + length - size_)
            high = np.minimum(block * BLOCK + BLOCK - 1, a_)
            on = low <= high
            of, block, low, high, a_, shift_ = (x[on] for x in (of, block, low, high, a_, shift_))
            at = a_ + shift_
            (half, full), (_, other) = families
            left = at - block * BLOCK
            core = pair(half[left], half[left - (BLOCK - 1) + length // 2])
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid[of]), pa.array(a_), pa.array(block.astype(np.int32)),
                 pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)), pa.array(core),
                 pa.array(pair(full[at - high], full[at - low])),
                 pa.array(pair(other[at - high], other[at - low]))],
                ["uid", "a", "block", "lo", "hi", "core", "one", "two"])
    return run


def _starts(length: int):
    """The strings of the starts that are left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for uid, a, shift, _, marks, families in _places(batches, length):
            lo = np.array([m["lo"] for m in marks])
            n = np.array([m["hi"] for m in marks]) - lo + 1
            of = np.repeat(np.arange(len(n)), n)
            offset = lo[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            at = a[of] + shift[of] - offset
            yield pa.RecordBatch.from_arrays(
                [pa.array(uid[of]), pa.array(a[of] - offset), pa.array(offset.astype(np.int32)),
                 pa.array(families[0][1][at].view(np.int64)), pa.array(families[1][1][at].view(np.int64))],
                ["uid", "start", "lo", "one", "two"])
    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the marked ranges."""
    for batch in batches:
        data, at = flat(batch.column("text"))
        removed, spans, kept = [], [], []
        for i, marks in enumerate(batch.column("marks").to_pylist()):
            text, out, end, gone, runs = data[at[i]:at[i + 1]].tobytes(), [], 0, 0, 0
            for m in sorted(((m["start"], m["end"]) for m in marks or ())):
                if m[0] > end or not runs:
                    out.append(text[end:m[0]])
                    runs += 1
                    end = m[0]
                if m[1] > end:
                    gone += m[1] - end
                    end = m[1]
            out.append(text[end:])
            removed.append(gone)
            spans.append(runs)
            kept.append(b"".join(out))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(at)), pa.array(removed, pa.int64()),
             pa.array(spans, pa.int64()), pa.array(kept, pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def _with_marks(texts: DataFrame, places: DataFrame) -> DataFrame:
    """uid, text, marks (a, lo, hi) of the texts that have places."""
    marks = (places.groupBy("uid").agg(F.collect_list(F.struct("a", "lo", "hi")).alias("marks")))
    return texts.join(marks, "uid")


def repeated(texts: DataFrame, length: int) -> DataFrame:
    """uid, start, end: byte ranges that hold a repeated string. ``texts``: uid,
    text; a uid given twice stands for two equal texts."""
    rows = staged(texts.select("uid", "text").mapInArrow(
        _anchor_rows(length), "uid long, a long, lo int, hi int, gram long, whole long"), "anchors")
    shared = (rows.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"))
    rows = staged(maybe_in(rows, ["gram"], bit_filter(shared, ["gram"])), "shared")
    kinds = staged(rows.groupBy("gram", "whole").agg(
        F.count(F.lit(1)).alias("n"), F.min("uid").alias("uid"), F.min_by("a", "uid").alias("a"),
        F.first("lo").alias("lo"), F.first("hi").alias("hi")), "kinds")
    span = [(F.col("a") - F.col("hi")).alias("start"), (F.col("a") - F.col("lo") + length).alias("end")]
    found = [rows.join(kinds.where("n > 1").select("gram", "whole"), ["gram", "whole"]).select("uid", *span)]
    # anchors in ranges of more than one kind, one of each kind; one that two
    # slices of a long text share is put together again
    open_ = (kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("single"))
             .where("kinds > 1 and single > 0").select("gram"))
    places = staged(kinds.join(open_, "gram").select("uid", "a", "lo", "hi")
                    .groupBy("uid", "a").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")), "places")
    suspects = staged(
        maybe_in(texts.select("uid", "text"), ["uid"], bit_filter(places, ["uid"]))
        .join(places.select("uid").distinct(), "uid").dropDuplicates(["uid"]), "suspects")
    blocks = staged(_with_marks(suspects, places).mapInArrow(
        _blocks(length), "uid long, a long, block int, lo int, hi int, core long, one long, two long"), "blocks")
    core, own = ["block", "core"], ["block", "core", "lo", "hi", "one", "two"]
    alive = blocks.groupBy(core).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(core)
    blocks = staged(blocks.join(alive, core), "alive")
    kinds = staged(blocks.groupBy(own).agg(F.count(F.lit(1)).alias("n"), F.min("uid").alias("uid"),
                                           F.min_by("a", "uid").alias("a")), "block-kinds")
    found.append(blocks.join(kinds.where("n > 1").select(own), own).select("uid", *span))
    open_ = (kinds.groupBy(core).agg(F.count(F.lit(1)).alias("kinds"), F.count_if(F.col("n") == 1).alias("single"))
             .where("kinds > 1 and single > 0").select(core))
    edges = staged(kinds.join(open_, core).select("uid", "a", "lo", "hi"), "edges")
    starts = staged(_with_marks(suspects, edges).mapInArrow(
        _starts(length), "uid long, start long, lo int, one long, two long"), "starts")
    twice = (starts.groupBy("lo", "one", "two").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("lo", "one", "two"))
    found.append(starts.join(twice, ["lo", "one", "two"])
                 .select("uid", "start", (F.col("start") + length).alias("end")))
    return found[0].unionByName(found[1]).unionByName(found[2])


def suffix_dedup(docs: DataFrame, length: int = 400) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept
    (the bytes that stay). ``length`` is a multiple of 16, 32 at least."""
    if length % 16 or length < 32:
        raise ValueError("length must be a multiple of 16, 32 at least")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("uid", F.xxhash64("doc_id", "text"))
    ranges = repeated(texts, length)
    marks = staged(ranges.groupBy("uid").agg(F.collect_set(F.struct("start", "end")).alias("marks")), "ranges")
    hit, clean = maybe_in(texts, ["uid"], bit_filter(marks, ["uid"]), other=True)
    kind = dict(docs.dtypes)["doc_id"]
    cut = (hit.join(marks, "uid", "left").select("doc_id", "text", "marks")
           .mapInArrow(_cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"))
    none = F.lit(0).cast("long")
    return cut.unionByName(clean.select(
        "doc_id", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("n_removed"),
        none.alias("n_spans"), F.encode("text", "UTF-8").alias("kept")))
