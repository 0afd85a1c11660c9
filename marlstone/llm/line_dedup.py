"""Fuzzy line deduplication by MinHash.

Lines are the parts of a text between newlines, compared after they are
lower-cased and outer spaces dropped; lines without anything left are never removed. Two lines
are alike if they are equal, or, where both have ``least`` characters or more, if the Jaccard similarity of their sets of
``SHINGLE``-byte strings is ``similarity`` or more. Signatures of ``BANDS`` x
``ROWS`` smallest hashes are cut into bands; lines that agree in a band are
compared by their exact sets until those alike are connected. A large band
is compared in blocks, so no task gets all lines of a hot band: first within
blocks, then one line of each connected group with those of other blocks, and
last, pair of blocks by pair of blocks, all lines that are not connected yet. A
pair of similarity 0.8 misses all bands with a probability under 1 %, one of 0.9 under
1 in 10,000. Connected lines form a class; the first line of a class, by doc_id
and then by place, stays.

Defined cases: NULL text stays NULL and has no lines; an empty text has one
empty line; rows with the same doc_id and text are the same document and keep
the same lines; NULL doc_ids come before all others; a document all of whose
lines are removed keeps an empty text; further columns stay as they are, those
called like inner names too; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import bit_filter, flat, key_ranges, maybe_in, row_slices, staged
from marlstone.llm.components import components

SHINGLE, BANDS, ROWS = 8, 12, 5
KEY = ["doc", "text_key"]
#: Bands and lines travel packed by the first bits of the band, about so many pairs in a batch,
#: and are settled so many at a time.
PART_BITS, PACKED, SETTLED = 12, 1 << 20, 1 << 21


def shingle_hashes(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """A 32-bit hash of the ``size`` bytes from each byte on, and offsets of
    the rows in them; a row of fewer bytes has none."""
    counts = np.maximum(np.diff(at) - size + 1, 0)
    ends = np.concatenate([[0], np.cumsum(counts)])
    if not ends[-1]:
        return np.zeros(0, np.uint32), ends
    wide = np.zeros(max(len(data) - size + 1, 0), np.uint64)
    for k in range(size):
        wide *= np.uint64(0x9E3779B97F4A7C15)
        wide += data[k:len(data) - size + 1 + k]
        wide ^= wide >> np.uint64(29)
    wide *= np.uint64(0xBF58476D1CE4E5B9)
    code = (wide >> np.uint64(32)).astype(np.uint32)
    starts = np.repeat(at[:-1] - ends[:-1], counts)
    return code[starts + np.arange(ends[-1])], ends


def line_bands(data: np.ndarray, at: np.ndarray, odd: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows that have shingles, and the names of their bands, a row for each band."""
    code, ends = shingle_hashes(data, at, SHINGLE)
    on = np.flatnonzero(np.diff(ends))
    starts = ends[on]
    keys = np.zeros((BANDS, len(on)), np.uint64)
    room = np.empty_like(code)
    for k in range(BANDS * ROWS if len(on) else 0):
        np.bitwise_xor(code, turn[k], out=room)
        np.multiply(room, odd[k], out=room)
        band = keys[k // ROWS]
        band += np.minimum.reduceat(room, starts)
        band += np.uint64(k // ROWS + 1)
        band *= np.uint64(0x9E3779B97F4A7C15)
        band ^= band >> np.uint64(31)
    return on, keys


def _packed(pairs: list[np.ndarray]) -> pa.RecordBatch:
    """part, pairs: band and line by the band's part, a row for each part."""
    both = np.concatenate(pairs)
    part = (both[:, 0].view(np.uint64) >> np.uint64(64 - PART_BITS)).astype(np.uint16)
    both = both[np.argsort(part, kind="stable")]
    n = np.bincount(part, minlength=1 << PART_BITS)
    has = np.flatnonzero(n)
    ends = np.concatenate([[0], np.cumsum(16 * n[has])]).astype(np.int32)
    packed = pa.Array.from_buffers(pa.binary(), len(has), [None, pa.py_buffer(ends), pa.py_buffer(both)])
    return pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), packed], ["part", "pairs"])


def _band_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """part, pairs: each band of each line, packed."""
    rng = np.random.default_rng(7)
    odd = rng.integers(0, 1 << 32, BANDS * ROWS, np.uint32, endpoint=False) | np.uint32(1)
    turn = rng.integers(0, 1 << 32, BANDS * ROWS, np.uint32, endpoint=False)
    pairs, total = [], 0
    for batch in batches:
        ids = batch.column("line").to_numpy()
        ids, first = np.unique(ids, return_index=True)
        lines = batch.column("body").take(pa.array(first))
        data, at = flat(lines)
        for lo, hi in row_slices(at, 1 << 17):
            on, keys = line_bands(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], odd, turn)
            pairs.append(np.stack([keys.view(np.int64).ravel(), np.tile(ids[lo:hi][on], BANDS)], 1))
            total += keys.size
            if total >= PACKED:
                yield _packed(pairs)
                pairs, total = [], 0
    if total:
        yield _packed(pairs)


def shingle_sets(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """The set of each line's shingles, as sorted 64-bit numbers."""
    n = max(len(data) - SHINGLE + 1, 0)
    wide = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        wide <<= np.uint64(8)
        wide |= data[k:n + k]
    out = []
    for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
        own = np.sort(wide[lo:max(hi - SHINGLE + 1, lo)])
        new = own[1:] != own[:-1]
        out.append(own if new.all() else own[np.concatenate([[True], new])])
    return out


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    if min(len(a), len(b)) < similarity * max(len(a), len(b)) or not len(a):
        return False
    either = np.concatenate([a, b])
    either.sort(kind="stable")  # two sorted stretches
    both = np.count_nonzero(either[1:] == either[:-1])
    return both >= similarity * (len(a) + len(b) - both)


#: Groups of so many lines are compared in one product, while they have no
#: more than so many different shingles.
PRODUCT_LINES, PRODUCT_SHINGLES = 24, 1 << 17


def alike_pairs(sets: list[np.ndarray], similarity: float) -> Iterator[tuple[int, int]]:
    """i, j (j < i) of all sets that are alike, by a product of 0/1 matrices."""
    of = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    known, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, of = column[order], of[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    for lo in range(0, len(known), 4096):
        some = slice(*np.searchsorted(column, [lo, lo + 4096]))
        held = np.zeros((len(sets), min(4096, len(known) - lo)), np.float32)
        held[of[some], column[some] - lo] = 1
        both += held @ held.T
    n = np.array([len(x) for x in sets])
    either = n[:, None] + n[None, :] - both
    i, j = np.nonzero(np.tril((both >= similarity * either) & (both > 0), -1))
    return zip(i.tolist(), j.tolist())


def _connect(similarity: float):
    """band, line, root: the connected classes of each key, each by one of
    them; rows of one class (that of a line alone is the line) are connected
    already and not compared again. Keys with two parts compare only lines of
    different parts."""
    def roots(classes: np.ndarray, part: np.ndarray, across: bool, sets: list[np.ndarray]) -> list[int]:
        first: dict[int, int] = {}
        root = [first.setdefault(c, i) for i, c in enumerate(classes.tolist())]

        def top(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x
        product = len(sets) >= PRODUCT_LINES and sum(map(len, sets)) and \
            len(np.unique(np.concatenate(sets))) <= PRODUCT_SHINGLES
        pairs = alike_pairs(sets, similarity) if product else ((i, j) for i in range(len(sets)) for j in range(i))
        for i, j in pairs:
            if across and part[i] == part[j]:
                continue
            x, y = top(i), top(j)
            if x != y and (product or alike(sets[i], sets[j], similarity)):
                root[x] = y
        return [top(i) for i in range(len(sets))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups, cut in key_ranges(batches):
            data, at = flat(groups["body"])
            classes, part, low, high = (groups[c].to_numpy() for c in ("class", "part", "low", "high"))
            root = np.empty(len(classes), np.int64)
            # the shingles of so many groups at a time: 512 KB of lines, one group at least
            for some, most in row_slices(at[cut], 1 << 19):
                begin, end = cut[some], cut[most]
                sets = shingle_sets(data[at[begin]:at[end]], at[begin:end + 1] - at[begin])
                for lo, hi in zip(cut[some:most], cut[some + 1:most + 1]):
                    of = roots(classes[lo:hi], part[lo:hi], low[lo] != high[lo], sets[lo - begin:hi - begin])
                    root[lo:hi] = classes[lo:hi][of]
            yield pa.RecordBatch.from_arrays(
                [groups["band"].combine_chunks(), pa.array(classes), pa.array(root)], ["band", "line", "root"])
    return run


def shared_pairs(band: np.ndarray, line: np.ndarray, told: np.ndarray):
    """Indices of the pairs to tell now, those of bands with two different lines
    or more that were not told before, and of one pair of each band to keep,
    with whether it is told by now."""
    order = np.argsort(band)
    same = np.zeros(len(band) + 1, bool)
    same[1:-1] = band[order[1:]] == band[order[:-1]]
    often = same[1:] | same[:-1]
    alone, some = order[~often], order[often]
    some = some[np.lexsort((~told[some], line[some], band[some]))]
    new = np.ones(len(some) + 1, bool)  # of equal pairs the one that was told
    new[1:-1] = (band[some[1:]] != band[some[:-1]]) | (line[some[1:]] != line[some[:-1]])
    some = some[new[:-1]]
    head = np.ones(len(some) + 1, bool)
    head[1:-1] = band[some[1:]] != band[some[:-1]]
    single = head[:-1] & head[1:]
    # a band of which one line was told before is shared, be the other here or not
    now = some[~single & ~told[some]]
    kept = np.concatenate([alone, some[head[:-1]]])
    return now, kept, np.concatenate([told[alone], ~single[head[:-1]] | told[some[head[:-1]]]])


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """band, line of packed pairs."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            data, _ = flat(batch.column("pairs").slice(lo, 256))
            both = np.frombuffer(data.tobytes(), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in both.T], ["band", "line"])


def _shared_bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """band, line of the bands with two different lines or more. Pairs are
    settled ``SETTLED`` at a time; then one of each band is kept, so a band of
    any size takes no more memory. A pair may be told twice."""
    bands, lines, told, fresh = [], [], np.zeros(0, bool), 0

    def settle() -> pa.RecordBatch:
        nonlocal bands, lines, told, fresh
        band, line = np.concatenate(bands), np.concatenate(lines)
        now, kept, told = shared_pairs(band, line, np.concatenate([told, np.zeros(fresh, bool)]))
        bands, lines, fresh = [band[kept]], [line[kept]], 0
        return pa.RecordBatch.from_arrays([pa.array(band[now]), pa.array(line[now])], ["band", "line"])
    for batch in batches:
        bands.append(batch.column("band").to_numpy())
        lines.append(batch.column("line").to_numpy())
        fresh += len(batch)
        if fresh >= max(SETTLED, len(told)):
            yield settle()
    if fresh:
        yield settle()


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _shared_bands(_unpacked(batches))


def lines_of(docs: DataFrame) -> DataFrame:
    """doc, text_key, place, line, line2, body: the lines that are not empty.
    line and line2 are a 128-bit hash of the body."""
    body = F.lower(F.trim("part"))
    return (docs.select(*KEY, F.posexplode(F.split("text", "\n", -1)).alias("place", "part"))
            .where(F.trim("part") != "")
            .select(*KEY, "place", body.alias("body"))
            .select(*KEY, "place", F.xxhash64(F.lit(1), "body").alias("line"),
                    F.xxhash64(F.lit(2), "body").alias("line2"), "body"))


def _one_of_each(buckets: DataFrame) -> DataFrame:
    """band, line of one band for each set of lines."""
    same = buckets.groupBy("band").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("line")).alias("x"),
        F.bit_xor(F.xxhash64("line", F.lit(1))).alias("y"))
    once = same.groupBy("n", "x", "y").agg(F.min("band").alias("band")).select("band")
    return buckets.join(once, "band")


def _compared(dealt: DataFrame, bodies: DataFrame, similarity: float) -> DataFrame:
    """band, line, root of the rows dealt by key."""
    joined = (dealt.join(bodies, "line").select("key", "band", "class", "part", "low", "high", "body")
              .repartition("key").sortWithinPartitions("key"))
    return staged(joined.mapInArrow(_connect(similarity), "band long, line long, root long"), "connected")


def _edges(found: list[DataFrame]) -> DataFrame:
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _rest_dealt(hot: DataFrame, linked: DataFrame, block: int) -> DataFrame:
    """Rows of large bands (band, line) by key, a key for each pair of blocks
    with lines that may not be connected yet. The lines of a band's largest
    class have blocks of their own, which are not compared with each other."""
    classed = (hot.join(linked.withColumnsRenamed({"node": "line", "component": "class"}), "line", "left")
               .withColumn("class", F.coalesce("class", "line")))
    counts = classed.groupBy("band", "class").agg(F.count(F.lit(1)).alias("n"))
    sizes = (counts.groupBy("band").agg(F.sum("n").alias("n"), F.max(F.struct("n", "class")).alias("main"))
             .where(F.col("n") > F.col("main.n"))
             .select("band", F.col("main.class").alias("main"),
                     F.expr(f"cast((n - main.n + {block - 1}) div {block} as int)").alias("parts"),
                     F.expr(f"cast((main.n + {block - 1}) div {block} as int)").alias("more")))
    of = F.xxhash64("line")
    main = F.col("class") == F.col("main")
    part = F.when(main, F.col("parts") + F.pmod(of, F.col("more"))).otherwise(F.pmod(of, F.col("parts")))
    last = F.when(main, F.col("parts")).otherwise(F.col("parts") + F.col("more")) - 1
    return (classed.join(sizes, "band").withColumn("part", part.cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
            .withColumn("low", F.least("part", "other")).withColumn("high", F.greatest("part", "other"))
            .withColumn("key", F.xxhash64("band", "low", "high")))


def linked_lines(lines: DataFrame, similarity: float, block: int = 256) -> DataFrame:
    """a, b: pairs of line hashes that connect the alike lines of each band.
    Lines of a band of more than ``block`` meet in random blocks, then one of
    each connected group goes on as long as that makes a band much smaller; at
    the end all its lines that are not connected are compared, blocks pair by
    pair."""
    shape = "band long, line long"
    banded = lines.select("line", "body").mapInArrow(_band_keys, "part int, pairs binary")
    met = staged(banded.repartition("part").mapInArrow(_met, shape).distinct(), "met")
    open_ = staged(_one_of_each(met), "open")
    wanted = open_.select("line").distinct()
    bodies = staged(
        maybe_in(lines.select("line", "body"), ["line"], bit_filter(wanted, ["line"]))
        .dropDuplicates(["line"]).join(wanted, "line"), "bodies")
    found, turn, rows = [], 0, open_
    while True:
        sized = rows.join(rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")), "band")
        parts = F.expr(f"cast((n + {block - 1}) div {block} as int)")
        dealt = (sized.withColumn("class", F.col("line"))
                 .withColumn("part", F.pmod(F.xxhash64("line", F.lit(turn)), parts).cast("int"))
                 .withColumn("low", F.col("part")).withColumn("high", F.col("part"))
                 .withColumn("key", F.xxhash64("band", "part")))
        done = _compared(dealt, bodies, similarity)
        found.append(done.where("line <> root").select(F.col("line").alias("a"), F.col("root").alias("b")))
        large = sized.where(F.col("n") > block)
        if not turn:
            hot = staged(large.select("band", "line"), "hot")
        heads = staged(done.where("line = root").join(large.select("band").distinct(), "band")
                       .select("band", "line").distinct(), "heads")
        before, after = large.count(), heads.count()
        if after > 0.5 * before or not after:
            break
        rows, turn = heads, turn + 1
    if not hot.isEmpty():
        rest = _rest_dealt(hot, components(_edges(found)), block)
        found.append(_compared(rest, bodies, similarity).where("line <> root")
                     .select(F.col("line").alias("a"), F.col("root").alias("b")).distinct())
    return _edges(found)


def removed_lines(docs: DataFrame, least: int, similarity: float) -> DataFrame:
    """doc, text_key, places: the places of the lines that go."""
    lines = staged(lines_of(docs), "lines")
    linked = components(linked_lines(lines.where(F.length("body") >= least), similarity))
    placed = staged(lines.drop("body").distinct(), "placed")
    # classes by hash: a linked class has the component, any other its own 128-bit hash
    counts = placed.groupBy("line", "line2").agg(F.count(F.lit(1)).alias("n"))
    named = (counts.join(linked.withColumnRenamed("node", "line"), "line", "left")
             .join(linked.select(F.col("component").alias("line")).distinct()
                   .withColumn("heads", F.lit(True)), "line", "left")
             .where((F.col("n") > 1) | F.col("component").isNotNull() | F.col("heads"))
             .select("line", "line2", F.coalesce("component", "line").alias("class"),
                     F.when(F.col("component").isNull() & F.col("heads").isNull(), F.col("line2"))
                     .otherwise(F.lit(0)).alias("class2")))
    shared = staged(placed.join(named, ["line", "line2"])
                    .select(*KEY, "place", "class", "class2",
                            F.coalesce("doc", F.lit(-(1 << 63))).alias("rank")), "shared")
    of = ["class", "class2"]
    first = (shared.groupBy(*of, "rank", "text_key").agg(F.min("place").alias("place"))
             .groupBy(*of, "rank").agg(F.min_by("place", "text_key").alias("place"),
                                       F.min("text_key").alias("text_key"))
             .groupBy(*of).agg(F.min_by("place", "rank").alias("place0"),
                               F.min_by("text_key", "rank").alias("key0"), F.min("rank").alias("rank0")))
    stays = ((F.col("rank") == F.col("rank0")) & (F.col("text_key") == F.col("key0"))
             & (F.col("place") == F.col("place0")))
    return (shared.join(first, of).where(~stays)
            .groupBy(*KEY).agg(F.collect_set("place").alias("places")))


def line_dedup(docs: DataFrame, least: int = 24, similarity: float = 0.8) -> DataFrame:
    """``docs`` with the remaining lines as text, and the new columns n_lines
    and n_removed; columns of these names are replaced."""
    others = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    nested = docs.select(F.struct(*[c for c in others if c != "text"]).alias("row"), F.col("doc_id").alias("doc"), "text",
                         F.xxhash64("text").alias("text_key"))
    places = staged(removed_lines(nested, least, similarity), "removed")
    cut = maybe_in(nested, KEY, bit_filter(places, KEY), other=True)
    parts = F.split("text", "\n", -1)
    n = F.coalesce(F.size(parts), F.lit(0)).cast("long")
    whole = cut[1].select("row", "text", n.alias("n_lines"), F.lit(0).cast("long").alias("n_removed"))
    renamed = places.withColumnsRenamed({"doc": "d", "text_key": "k"})
    stay = F.array_except(F.sequence(F.lit(0), F.size("parts") - 1), F.coalesce("places", F.array().cast("array<int>")))
    cut = (cut[0].join(renamed, F.col("doc").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left")
           .select("row", parts.alias("parts"), "places")
           .select("row", F.array_join(F.transform(stay, lambda i: F.element_at("parts", i + 1)), "\n").alias("text"),
                   F.size("parts").cast("long").alias("n_lines"),
                   F.coalesce(F.array_size("places"), F.lit(0)).cast("long").alias("n_removed")))
    both = whole.unionByName(cut)
    return both.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in others],
                       "n_lines", "n_removed")


def drop_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with the remaining lines as text, n_chars (where there is one)
    brought up to date. Documents that lose all they hold go: their lines stay
    elsewhere."""
    cut = line_dedup(docs, **options).where((F.col("n_removed") == 0) | (F.trim("text") != ""))
    chars = F.length("text").cast(dict(docs.dtypes).get("n_chars", "long"))
    cut = cut.withColumn("n_chars", F.when(F.col("n_removed") > 0, chars).otherwise(F.col("n_chars"))) \
        if "n_chars" in docs.columns else cut
    return cut.select(*[c for c in docs.columns if c not in ("n_lines", "n_removed")])
