"""Packing token pieces into sequences, certified by lower bounds.

A document's ids are cut into pieces of ``capacity`` ids, the last may be
shorter. The pieces are dealt at random over partitions of about ``share``
pieces. Each partition runs best-fit decreasing and computes a lower bound of
its sequences from dual-feasible functions: each maps a share of a sequence to
a weight such that pieces that fit together weigh 1 at most, so the weights'
sum bounds the count from below. A partition whose count equals its bound
is certified. In the next round the partitions with a gap give up all sequences that
are not full, and every partition its emptiest one, whose rest may fit with
those of others; these pieces are dealt anew and packed again. Rounds end when the whole count
equals the bound of all pieces' ids, when nothing is left to exchange, when one
partition has packed everything given up, when an exchange saves no sequence
(what was packed before it then stays), or after ``rounds``.

Ids: those of the tokenizer, then ``end_id``. Words are encoded once each and
kept, which gives the tokenizer's own ids because it treats the words of its
pattern separately; a worker process keeps them from task to task; texts with characters beyond Latin-1 or a special token
go through the tokenizer whole.

Defined cases: NULL text counts as empty, whose ids are the end id alone;
repeated rows are packed each for itself; a NULL doc_id stays NULL; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import flat, package_path, row_slices, staged

#: The tokenizer's words for texts of Latin-1 characters after lower-casing.
WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
                  "|[^\t-\r \x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
OTHER = re.compile("[^\x00-\xff]|<\\|(?:start|end)oftext\\|>")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers. Words met lately
    are kept, in two generations of at most ``most`` each."""

    def __init__(self, path: str, most: int = 300_000) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(package_path(path))
        # for words: they are normalised and cut already
        self.plain = Tokenizer.from_file(package_path(path))
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.most = most

        self.last = np.array([s.endswith("</w>") for s, _ in sorted(
            self.tokenizer.get_vocab(with_added_tokens=False).items(), key=lambda x: x[1])])

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, from one text of all: a word's last id says so."""
        ids = np.array(self.plain.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        cut = [0, *(4 * (np.flatnonzero(self.last[ids]) + 1)).tolist()]
        if len(cut) != len(words) + 1:
            return [self._encode(w).tobytes() for w in words]
        raw = ids.tobytes()
        return [raw[lo:hi] for lo, hi in zip(cut, cut[1:])]

    def _learn(self, asked: set[str]) -> None:
        if len(self.known) + len(asked) > self.most:
            self.known, self.older = {}, self.known
        new = asked.difference(self.known)
        again = new.intersection(self.older)
        self.known.update((w, self.older[w]) for w in again)
        new = list(new - again)
        for i in range(0, len(new), 512):
            self.known.update(zip(new[i:i + 512], self._encode_words(new[i:i + 512])))

    def __call__(self, texts: list[str]) -> list[bytes]:
        words = [None if OTHER.search(t) else WORD.findall(t.lower()) for t in texts]
        self._learn(set(chain.from_iterable(ws for ws in words if ws)))
        get = self.known.__getitem__
        return [self._encode(t).tobytes() if ws is None else b"".join(map(get, ws))
                for t, ws in zip(texts, words)]


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """One for all tasks of a worker process: the words it knows stay."""
    return Encoder(path)


def _pieces(path: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(path), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            _, at = flat(batch.column("text"))
            row, piece, start, length, crc = [], [], [], [], []
            for lo, hi in row_slices(at, 1 << 20):
                texts = batch.column("text").slice(lo, hi - lo).to_pylist()
                for i, ids in enumerate(encoder(texts), lo):
                    ids += end
                    for k, s in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[s:s + 4 * capacity]
                        row.append(i)
                        piece.append(k)
                        start.append(s // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
            ids = batch.column("doc_id").take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                 pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32."""
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        _pieces(tokenizer, end_id, capacity),
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The largest bound of two families of dual-feasible functions."""
    if not len(lengths):
        return 0
    n = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1)
    count, total = np.cumsum(n), np.cumsum(n * size)
    # for each e: pieces over capacity - e weigh 1, those under e nothing
    e = np.arange(0, capacity // 2 + 1)
    large = count[-1] - count[capacity - e]
    middle = total[capacity - e] - np.where(e > 0, total[np.maximum(e - 1, 0)], 0)
    best = int((large - (-middle // capacity)).max())
    for k in range(1, 40):  # (k + 1) x rounded down to a multiple of 1 / k, whole values stay
        scaled = (k + 1) * size
        weight = np.where(scaled % capacity == 0, size * k, scaled // capacity * capacity)
        best = max(best, -int(-(n * weight).sum() // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Sequence and offset of each piece, and the number of sequences."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # sequences by their room
    open_rooms, used = 0, 0  # a bit for each room that some sequence has
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = open_rooms >> size
        if fits:
            left = (fits & -fits).bit_length() - 1 + size
            own = room[left].pop()
            if not room[left]:
                open_rooms ^= 1 << left
        else:
            own, left = used, capacity
            used += 1
        sequence[i], offset[i] = own, capacity - left
        left -= size
        if left:
            if not room[left]:
                open_rooms |= 1 << left
            room[left].append(own)
    return sequence, offset, used


def _packer(capacity: int, turn: int):
    def run(group: pa.Table) -> pa.Table:
        lengths = group["length"].to_numpy()
        sequence, offset, used = best_fit_decreasing(lengths, capacity)
        filled = np.bincount(sequence, lengths, used).astype(np.int64)
        gap = used > lower_bound(lengths, capacity)
        give = (filled < capacity) if gap else np.zeros(used, bool)
        emptiest = int(filled.argmin())
        give[emptiest] |= filled[emptiest] < capacity
        number = (turn << 56) + (int(group["part"][0].as_py()) << 24)
        return group.drop_columns(["part"]).append_column(
            "sequence_id", pa.array(sequence + number)).append_column(
            "offset", pa.array(offset)).append_column("give", pa.array(give[sequence]))
    return run


def pack(pieces: DataFrame, capacity: int = 4096, share: int = 10_000, rounds: int = 6) -> DataFrame:
    """``pieces`` (with a column length of 1 to ``capacity``) and their
    sequence_id and offset."""
    columns = ", ".join(f"{c} {t}" for c, t in pieces.dtypes)
    shape = f"{columns}, uid long, sequence_id long, offset long, give boolean"
    # numbered before they are written: dealt alike whenever read
    rest = staged(pieces.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    size = rest.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("ids")).first()
    bound = -(-(size["ids"] or 0) // capacity)
    left, kept, settled, best, before = size["n"], [], 0, None, None
    for turn in range(rounds):
        parts = max(1, -(-left // share))
        dealt = rest.withColumn("part", F.pmod(F.xxhash64("uid", F.lit(turn)), F.lit(parts)))
        packed = staged(dealt.groupBy("part").applyInArrow(_packer(capacity, turn), shape), f"round{turn}")
        of = packed.groupBy("sequence_id").agg(F.first("give").alias("give"), F.count(F.lit(1)).alias("n"))
        now = of.agg(F.count(F.lit(1)).alias("all"), F.count_if("give").alias("given"),
                     F.sum(F.when(F.col("give"), F.col("n"))).alias("n")).first()
        if best is not None and settled + now["all"] >= best:
            kept[-1] = before  # the exchange has saved nothing
            break
        best, before = settled + now["all"], packed
        done = best <= bound or not now["given"] or parts == 1 or turn == rounds - 1
        kept.append(packed if done else packed.where(~F.col("give")))
        if done:
            break
        settled += now["all"] - now["given"]
        rest, left = packed.where("give").drop("sequence_id", "offset", "give"), now["n"]
    out = kept[0]
    for more in kept[1:]:
        out = out.unionByName(more)
    return out.drop("uid", "give")


def pack_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1,
                   capacity: int = 4096, share: int = 10_000) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(token_pieces(docs, tokenizer, end_id, capacity), capacity, share)
