"""Context-tree weighting over bytes, and a smoothed unigram base.

Each byte is coded as eight binary decisions, most significant bit first. Every
decision, named by the bits before it, has its own tree of contexts: the last
0 to ``depth`` bytes of the text. A node holds the decision's zeros and ones and
its Krichevsky-Trofimov probability P_e; its weighted probability is
P_w = (P_e + product of the children's P_w) / 2, and P_w = P_e at full depth.
A new decision then has probability w * KT + (1 - w) * (the child's answer),
with w = P_e / (2 P_w), down the path of its context. Texts are preceded by
``depth`` zero bytes and end with byte 255, which no UTF-8 text holds, so the
score is a log probability of the whole text.

Texts are dealt into blocks of neighbours in their scan partition. A block lists its distinct
words and (depth + 1)-grams with their training counts, packed into one row for each part:
grams by their last three context bytes, words by their crc32. A part is sent to one place,
where the counts of all blocks add up and every block gets its values back in the order it
asked; a block scores its texts with them, so no model is broadcast and neither words nor
grams travel back. The tree is evaluated for some whole parts at a time; nodes of depth 2 are
added up by a grouping and joined to the parts below them, and only the nodes of depth 1 and
0, 256 contexts at most, pass the driver.

Defined cases: NULL text counts as empty, which is the end symbol alone; crc32
of a NULL doc_id counts as 0; repeated rows are learnt from and scored each for
itself; other columns are ignored; without training rows all nodes are empty
(every bit has probability 1/2, base_score is NULL).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from math import lgamma, log10
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import flat, key_ranges, row_slices, staged

END = 255
LOG_HALF = np.log(0.5)


def grams(data: np.ndarray, at: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The code of every byte with its context, and texts' offsets in them. The
    highest byte is the latest context byte, the lowest the byte itself."""
    n = len(at) - 1
    starts = at[:-1] + np.arange(n) * (depth + 1) + depth
    padded = np.zeros(len(data) + n * (depth + 1), np.uint8)
    lens = np.diff(at)
    padded[np.arange(len(data)) + np.repeat(starts - at[:-1], lens)] = data
    padded[starts + lens] = END
    wide = padded.astype(np.int64)
    code = wide[depth:].copy()
    for k in range(1, depth + 1):
        code |= wide[depth - k:len(wide) - k] << (8 * (depth - k + 1))
    real = np.ones(len(code), bool)
    for k in range(1, depth + 1):  # the padding before the later texts
        real[starts[1:] - depth - k] = False
    return code[real], np.concatenate([[0], np.cumsum(lens + 1)])


def codes(text: np.ndarray, depth: int, piece: int = 1 << 20) -> Iterator[np.ndarray]:
    """``grams`` of one text, piece by piece."""
    for start in range(0, len(text) + 1, piece):
        lead = min(start, depth)
        part = text[start - lead:start + piece]
        code, _ = grams(part, np.array([0, len(part)]), depth)
        yield code[lead:] if start + piece > len(text) else code[lead:-1]


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of a sequence."""
    return (log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0)
            - 2 * lgamma(0.5))


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after shifting the argument above 8."""
    x = np.asarray(x, float)
    shift = np.where(x < 8, 8.0, 0.0)
    y = x + shift
    out = (y - 0.5) * np.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y ** 3) \
        + 1 / (1260 * y ** 5)
    small = np.flatnonzero(x < 8)
    if len(small):
        v = x[small]
        product = v.copy()
        for k in range(1, 8):
            product *= v + k
        out[small] -= np.log(product)
    return out


def decisions(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names (1 to 255) and outcomes of the eight decisions of each byte."""
    shifts = np.arange(8)
    names = (byte[:, None] | 256) >> (8 - shifts)
    return names, (byte[:, None] >> (7 - shifts)) & 1


class Nodes:
    """Nodes of one depth: sorted keys (context << 8 | decision), log P_w, the
    weight of a node's own estimate and the counts."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray,
                 children: np.ndarray | None) -> None:
        # counts of no keys would be whole numbers
        self.keys, self.zeros, self.ones = keys, np.asarray(zeros, float), np.asarray(ones, float)
        own = log_kt(self.zeros, self.ones)
        if children is None:
            self.log_pw, self.weight = own, np.ones(len(keys))
        else:
            self.log_pw = np.logaddexp(own, children) + LOG_HALF
            self.weight = np.exp(own + LOG_HALF - self.log_pw)

    def parents(self) -> Nodes:
        up = (self.keys >> 16) << 8 | (self.keys & 255)
        return Nodes.merged(up, self.zeros, self.ones, self.log_pw)

    @staticmethod
    def merged(keys, zeros, ones, children) -> Nodes:
        found, to = np.unique(keys, return_inverse=True)
        n = len(found)
        return Nodes(found, np.bincount(to, zeros, n), np.bincount(to, ones, n),
                     None if children is None else np.bincount(to, children, n))

    def mix(self, keys: np.ndarray, bits: np.ndarray, deeper: np.ndarray | None) -> np.ndarray:
        """Probability of ``bits`` at the nodes ``keys``, given the answers one
        level deeper; a node that was never met is empty."""
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        met = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        pick = lambda x, other: np.where(met, x[at], other) if len(x) else np.full(len(keys), other)
        zeros, ones = pick(self.zeros, 0.0), pick(self.ones, 0.0)
        own = (np.where(bits == 1, ones, zeros) + 0.5) / (zeros + ones + 1)
        if deeper is None:
            return own
        weight = pick(self.weight, 0.5)
        return weight * own + (1 - weight) * deeper


def leaves(gram: np.ndarray, n: np.ndarray, step: int = 1 << 16) -> Nodes:
    """Nodes of full depth of sorted grams, ``step`` grams or one context at a time."""
    context = gram >> 8
    first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(gram) else np.zeros(0, int)
    cut = [0, *first[np.searchsorted(first, np.arange(step, len(gram), step), "right") - 1].tolist(), len(gram)]
    keys, zeros, ones = [], [], []
    for lo, hi in zip(cut, cut[1:]):
        names, bits = decisions(gram[lo:hi] & 255)
        key = (context[lo:hi, None] << 8 | names).ravel()
        times = np.repeat(n[lo:hi].astype(float), 8)
        found, to = np.unique(key, return_inverse=True)
        keys.append(found)
        ones.append(np.bincount(to, times * bits.ravel(), len(found)))
        zeros.append(np.bincount(to, times, len(found)) - ones[-1])
    return Nodes(np.concatenate(keys), np.concatenate(zeros), np.concatenate(ones), None)


def levels(gram: np.ndarray, n: np.ndarray, depth: int, down_to: int) -> list[Nodes]:
    """Nodes of depth ``depth``, ``depth`` - 1, ... ``down_to``."""
    out = [leaves(gram, n)]
    for _ in range(depth - down_to):
        out.append(out[-1].parents())
    return out


def log10_of(gram: np.ndarray, nodes: list[Nodes], depth: int, step: int = 1 << 16) -> np.ndarray:
    """log10 probability of each gram's byte after its context. nodes: from
    full depth to depth 0."""
    out = np.zeros(len(gram))
    for lo in range(0, len(gram), step):
        some = gram[lo:lo + step]
        names, bits = decisions(some & 255)
        bits, answer = bits.ravel(), None
        for up, level in enumerate(nodes):
            keys = ((some >> (8 + 8 * up))[:, None] << 8 | names).ravel()
            answer = level.mix(keys, bits, answer)
        out[lo:lo + step] = np.log10(answer).reshape(-1, 8).sum(axis=1)
    return out


def _added(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their n."""
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return keys[first], np.add.reduceat(n, first)


def _low_bits(depth: int) -> int:
    """Bits of a gram below the three (at depth 2: two) context bytes that name its part."""
    return 8 * (depth + 1 - min(depth, 3))


def _block_counts(data: np.ndarray, at: np.ndarray, learn: np.ndarray, depth: int, parts: int):
    """Distinct words of the texts by part and word, their parts and training
    counts; distinct grams, sorted, and their training counts."""
    words: Counter = Counter()
    asked: set[bytes] = set()
    found, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for lo, hi in row_slices(at, 1 << 20):
        for taught in (True, False):
            texts = [data[at[i]:at[i + 1]] for i in range(lo, hi) if learn[i] == taught]
            if not texts:
                continue
            for t in texts:
                (words if taught else asked).update(t.tobytes().lower().split())
            ends = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
            for code in (codes(texts[0], depth) if len(texts) == 1 else
                         [grams(np.concatenate(texts), ends, depth)[0]]):
                g, c = np.unique(code, return_counts=True)
                found.append(g)
                counts.append(c * taught)
    keys = [*words, *(asked - words.keys())]
    part = np.fromiter((crc32(k) % parts for k in keys), np.int64, len(keys))
    order = pc.sort_indices(pa.table({"part": part, "word": pa.array(keys, pa.binary())}),
                            sort_keys=[("part", "ascending"), ("word", "ascending")]).to_numpy()
    keys = [keys[i] for i in order]
    n_words = np.fromiter((words.get(k, 0) for k in keys), np.int64, len(keys))
    return (keys, part[order], n_words), _added(np.concatenate(found), np.concatenate(counts))


def _starts(part: np.ndarray) -> np.ndarray:
    """Where the parts of a sorted column start, and its length."""
    return np.append(np.flatnonzero(np.r_[True, part[1:] != part[:-1]][:len(part)]), len(part))


def _binary(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A binary column: the bytes of the values from each start to the next."""
    offsets = (starts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1,
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


_ASKED = "block long, part long, words array<binary>, grams binary, n binary"


def _blocks(depth: int, parts: int, block_rows: int, block_bytes: int):
    """Texts of a partition in blocks: one row with the packed texts, one for
    each part of the words and of the grams."""
    def pack(block: int, pieces: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(pieces).combine_chunks()
        data, at = flat(rows["text"])
        held_out = rows["held_out"].to_numpy()
        (words, word_part, n_words), (gram, n) = _block_counts(data, at, ~held_out, depth, parts)
        low = _low_bits(depth)
        gram_part, steps = gram >> low, np.diff(gram, prepend=0)
        at_word, at_gram = _starts(word_part), _starts(gram_part)
        steps[at_gram[:-1]] = gram[at_gram[:-1]] & ((1 << low) - 1)
        names = ["block", "part", "words", "grams", "n", "doc_id", "held_out", "lens", "texts"]
        ids = rows.schema.field("doc_id").type
        none = [pa.list_(pa.binary()), pa.binary(), pa.binary(), pa.list_(ids), pa.list_(pa.bool_()),
                pa.list_(pa.int64()), pa.binary()]

        def table(k: int, **columns) -> pa.RecordBatch:
            kinds = dict(zip(names[2:], none))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, block)),
                 *[columns.get(c, pa.nulls(k, kinds.get(c, pa.int64()))) for c in names[1:]]], names)
        whole = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        yield table(1, doc_id=whole(rows["doc_id"].combine_chunks()), held_out=whole(pa.array(held_out)),
                    lens=whole(pa.array(np.diff(at))),
                    texts=pa.array([pa.compress(data.tobytes(), "zstd", asbytes=True)], pa.binary()))
        if words:
            yield table(len(at_word) - 1, part=pa.array(word_part[at_word[:-1]]),
                        words=pa.ListArray.from_arrays(pa.array(at_word, pa.int32()), pa.array(words, pa.binary())),
                        n=_binary(n_words.astype(np.uint32), at_word))
        yield table(len(at_gram) - 1, part=pa.array(gram_part[at_gram[:-1]]),
                    grams=_binary(steps.astype(np.uint32), at_gram), n=_binary(n.astype(np.uint32), at_gram))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        pieces, size, count = [], 0, 0
        for batch in batches:
            _, at = flat(batch.column("text"))
            for lo, hi in row_slices(at, block_bytes):
                for a in range(lo, hi, block_rows):
                    z = min(a + block_rows, hi)
                    if pieces and (size + at[z] - at[a] > block_bytes or count + z - a > block_rows):
                        yield from pack(block, pieces)
                        block, pieces, size, count = block + 1, [], 0, 0
                    pieces.append(batch.slice(a, z - a))
                    size, count = size + at[z] - at[a], count + z - a
        if pieces:
            yield from pack(block, pieces)
    return run


def _word_totals(group: pa.Table) -> pa.Table:
    """Training counts of a part's words over all blocks, in each block's order;
    the part's tokens and known words in its first row."""
    words = group["words"].combine_chunks()
    data, _ = flat(group["n"])
    at = words.flatten().dictionary_encode().indices.to_numpy()
    totals = np.bincount(at, data.view(np.uint32)).astype(np.int64)
    lens = pc.list_value_length(words).to_numpy()
    once = np.arange(group.num_rows) == 0
    return pa.table([group["block"], group["part"],
                     _binary(totals[at], np.concatenate([[0], np.cumsum(lens)])),
                     pa.array(once * totals.sum()), pa.array(once * (totals > 0).sum())],
                    names=["block", "part", "totals", "n", "known"])


def _some_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted rows in tables of whole parts, about 2**18 grams or one part each."""
    for rows, cut in key_ranges(batches):
        _, at = flat(rows["grams"])
        for lo, hi in row_slices(at[cut], 1 << 20):
            yield rows.slice(cut[lo], cut[hi] - cut[lo])


def _unpacked(rows: pa.Table, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Grams and training counts of packed rows, and the rows' offsets in them."""
    data, at = flat(rows["grams"])
    at = at // 4
    sums = np.concatenate([[0], np.cumsum(data.view(np.uint32).astype(np.int64))])
    part = rows["key"].to_numpy() << _low_bits(depth)
    lens = np.diff(at)
    return (sums[1:] + np.repeat(part - sums[at[:-1]], lens),
            flat(rows["n"])[0].view(np.uint32).astype(np.int64), at)


def _deep(depth: int):
    """Nodes of the parts' own depth."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _some_parts(batches):
            gram, n, _ = _unpacked(rows, depth)
            gram, n = _added(gram, n)
            top = levels(gram[n > 0], n[n > 0], depth, min(depth, 3))[-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (top.keys, top.zeros, top.ones, top.log_pw)],
                ["key", "zeros", "ones", "log_pw"])
    return run


def _weighted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes from their counts and their children's log P_w."""
    for batch in batches:
        key, zeros, ones, children = (batch.column(c).to_numpy() for c in range(4))
        node = Nodes(key, zeros, ones, children)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c) for c in (key, zeros, ones, node.log_pw, node.weight)],
            ["key", "zeros", "ones", "log_pw", "weight"])


def _evaluate(depth: int, near: Nodes, root: Nodes):
    """log10 probabilities of each row's grams, in their order. Rows with
    ``nodes`` bring the depth-2 nodes above a part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _some_parts(batches):
            brought = rows["nodes"].combine_chunks().flatten()
            rows = rows.filter(pc.is_valid(rows["grams"]))
            asked, n, at = _unpacked(rows, depth)
            gram, n = _added(asked, n)
            nodes = levels(gram[n > 0], n[n > 0], depth, min(depth, 3))
            if depth > 2:
                keys, one = np.unique(brought.field("key").to_numpy(), return_index=True)
                above = Nodes(*[np.zeros(0)] * 4)
                above.keys = keys
                above.zeros, above.ones, above.log_pw, above.weight = (
                    brought.field(c).to_numpy()[one] for c in ("zeros", "ones", "log_pw", "weight"))
                nodes = [*nodes, above]
            logp = log10_of(gram, [*nodes, near, root], depth)
            yield pa.RecordBatch.from_arrays(
                [rows["block"].combine_chunks(), rows["key"].combine_chunks(),
                 _binary(logp[np.searchsorted(gram, asked)], at)], ["block", "part", "logp"])
    return run


def _parents(nodes: DataFrame) -> DataFrame:
    """Sums of the nodes one level up."""
    return (nodes.groupBy(F.expr("shiftright(key, 16) * 256 + (key & 255)").alias("key"))
            .agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("log_pw").alias("log_pw")))


def tree_values(asked: DataFrame, depth: int) -> DataFrame:
    """block, part, logp: the tree's values of the packed grams of ``asked``
    (block, part, grams, n)."""
    rows = asked.select(F.col("part").alias("key"), "block", "grams", "n")
    in_parts = lambda df: df.repartition("key").sortWithinPartitions("key")
    node = "key long, zeros double, ones double, log_pw double"
    nodes = in_parts(rows.select("key", "grams", "n")).mapInArrow(_deep(depth), node)
    kind = f"{node}, weight double"
    if depth > 2:
        nodes = staged(_parents(nodes).mapInArrow(_weighted, kind), "nodes")
        above = (nodes.groupBy(F.shiftright("key", 8).alias("two"))  # 255 decisions at most
                 .agg(F.collect_list(F.struct(*nodes.columns)).alias("nodes")))
        below = rows.select("key").distinct().withColumn("two", F.shiftright("key", 8))
        rows = rows.unionByName(below.join(above, "two").drop("two"), allowMissingColumns=True)
    else:
        rows = rows.withColumn("nodes", F.lit(None).cast("array<struct<key:bigint>>"))
    found = _parents(nodes).orderBy("key").collect()  # depth 1: 256 contexts of 255 decisions at most
    column = lambda c: np.array([r[c] for r in found], np.int64 if c == "key" else float)
    near = Nodes(*[column(c) for c in ("key", "zeros", "ones", "log_pw")])
    return in_parts(rows).mapInArrow(_evaluate(depth, near, near.parents()), "block long, part long, logp binary")


def _score_block(depth: int, parts: int, total: int, distinct: int, n_texts: int):
    rest = total + 0.1 * (distinct + 1)

    def run(texts: pa.Table, values: pa.Table) -> pa.Table:
        row = {c: texts[c].combine_chunks().flatten() for c in ("doc_id", "held_out", "lens")}
        at = np.concatenate([[0], np.cumsum(row["lens"].to_numpy())])
        data = np.frombuffer(pa.decompress(texts["texts"][0].as_py(), int(at[-1]), "zstd"), np.uint8)
        (words, _, _), (gram, _) = _block_counts(data, at, np.ones(len(at) - 1, bool), depth, parts)
        values = values.sort_by("part")
        answers = {c: flat(values[c])[0] for c in ("totals", "logp")}
        logs = np.log10((answers["totals"].view(np.int64) + 0.1) / rest)
        logp = answers["logp"].view(np.float64)
        assert len(logs) == len(words) and len(logp) == len(gram)
        value = dict(zip(words, logs.tolist()))
        never, end = log10(0.1 / rest), log10((n_texts + 0.1) / rest)
        n_tokens, n_known, base, score = [], [], [], []
        for lo, hi in row_slices(at, 1 << 20):
            for i in range(lo, hi):
                tokens = data[at[i]:at[i + 1]].tobytes().lower().split()
                found = np.fromiter((value[t] for t in tokens), float, len(tokens))
                n_tokens.append(len(tokens) + 1)
                n_known.append(int((found > never + 0.1).sum()) + (n_texts > 0))
                base.append(float(found.sum()) + end)
            if hi - lo == 1:
                score.append(sum(float(logp[np.searchsorted(gram, np.sort(code))].sum())
                                 for code in codes(data[at[lo]:at[hi]], depth)))
                continue
            code, ends = grams(data[at[lo]:at[hi]], at[lo:hi + 1] - at[lo], depth)
            for a, b in zip(ends, ends[1:]):
                # in order, neighbours are found near each other
                score.append(float(logp[np.searchsorted(gram, np.sort(code[a:b]))].sum()))
        return pa.table([
            row["doc_id"], row["held_out"], pa.array(n_tokens, pa.int64()),
            pa.array(n_known, pa.int64()), pa.array(base if total else [None] * len(base), pa.float64()),
            pa.array(score, pa.float64()), pa.array(np.diff(at) + 1)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "n_symbols"])
    return run


def language_model(docs: DataFrame, depth: int = 5, held_out: int = 10,
                   block_rows: int = 4000, block_bytes: int = 1 << 23) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte: one row per row of ``docs``. Learns from the rows whose
    crc32 of doc_id modulo ``held_out`` is not 0. A block has at most
    ``block_rows`` texts and ``block_bytes`` bytes, or one longer text."""
    if not 2 <= depth <= 6:
        raise ValueError("depth must be 2 to 6")
    remainder = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % held_out, F.lit(0))
    id_type = dict(docs.dtypes)["doc_id"]
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"),
                        (remainder == 0).alias("held_out"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("bytes"),
                     F.count_if(~F.col("held_out")).alias("taught")).first()
    parts, taught = 1 + (size["bytes"] or 0) // (2 * block_bytes), size["taught"]
    dealt = staged(texts.mapInArrow(
        _blocks(depth, parts, block_rows, block_bytes),
        f"{_ASKED}, doc_id array<{id_type}>, held_out array<boolean>, lens array<bigint>, texts binary"), "blocks")
    words = staged(dealt.where(F.col("words").isNotNull()).groupBy("part").applyInArrow(
        _word_totals, "block long, part long, totals binary, n long, known long"), "words")
    total = words.agg(F.sum("n").alias("n"), F.sum("known").alias("v")).first()
    n_all, n_distinct = (total["n"] or 0) + taught, (total["v"] or 0) + (taught > 0)
    answers = words.select("block", "part", "totals").unionByName(
        tree_values(dealt.where(F.col("grams").isNotNull()), depth), allowMissingColumns=True)
    packed = dealt.where(F.col("texts").isNotNull()).select("block", "doc_id", "held_out", "lens", "texts")
    scored = packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score_block(depth, parts, n_all, n_distinct, taught),
        f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, "
        "score double, n_symbols long")
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(n_all).cast("long").alias("train_tokens"),
        "base_score", "score",
        (-F.col("score") / F.log10(F.lit(2.0)) / F.col("n_symbols")).alias("bits_per_byte"))
