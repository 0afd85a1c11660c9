"""Toxic spans by a linear-chain conditional random field.

The chain has two states, clean (0) and toxic (1), and starts in clean. A
token's evidence is the sum of the weights of its features: the word, its first
4, 5 and 6 bytes, its last 4 bytes. Marginals come from forward-backward over
the whole text; runs of a text are advanced side by side as products of 2 x 2
matrices, so the work is exact and vectorised. Adjacent tokens of a marginal of
0.5 or more form a span, given by its character offsets. The document score is
a logistic function of the expected number of toxic tokens and the largest
marginal.

Training takes at most ``sample`` labelled documents of each label and of at
most ``sample_chars`` characters each, those with the smallest hash of doc_id. They are cut into
words in the executors; the driver gets 8 bytes for each of their words and every distinct word
once, so what it holds is bounded by these parameters. Labels of documents
become labels of tokens: a token of a toxic document is toxic if one of its
features marks toxic documents, that is, occurs in a ``share`` of those in the sample (in ``least`` at the
least; near copies count once) and ``ratio`` times as often as in clean ones.

Defined cases: NULL text counts as empty; a text without words has the score of
no evidence; rows of labels with a NULL doc_id or label are left out, the
largest label of a doc_id counts; without labels of both kinds every score is
0; repeated rows are scored each for itself; a text longer than ``sample_chars`` is
scored in whole, but not learnt from; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import flat, row_slices, staged

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
SLOTS = 64


@dataclass
class Model:
    weights: dict[bytes, float] = field(default_factory=dict)
    bias: float = -8.0
    steps: tuple[float, float, float] = (1.0, 1.0, 1.0)  # factors 0 -> 1, 1 -> 0, 1 -> 1
    score: tuple[float, float, float] | None = None  # None: nothing was learnt


def features(word: bytes) -> list[bytes]:
    out = [b"=" + word]
    for k in (4, 5, 6):
        if len(word) >= k:
            out.append(b"<%d" % k + word[:k])
    if len(word) >= 4:
        out.append(b">" + word[-4:])
    return out


def forward_backward(x: np.ndarray, lens: np.ndarray, steps: tuple[float, float, float],
                     pairs: bool = False):
    """Marginals of state 1 for tokens end to end. x: factor of state 1 of each
    token; lens: tokens of each text, all over 0. pairs: also the expected
    numbers of steps 0 -> 1, 1 -> 0 and 1 -> 1."""
    t01, t10, t11 = steps
    runs = -(-lens // SLOTS)
    first = np.cumsum(runs) - runs
    pos = np.arange(len(x)) - np.repeat(np.cumsum(lens) - lens, lens)
    run, slot = np.repeat(first, lens) + pos // SLOTS, pos % SLOTS
    n = int(runs.sum())
    factor = np.zeros((SLOTS, n))
    factor[slot, run] = x
    real = factor > 0
    a = np.ones((SLOTS, n))
    b, c, d = t01 * factor, np.where(real, t10, 0.0), np.where(real, t11 * factor, 1.0)
    # the product of each run's steps, from state 0 (p) and from state 1 (q)
    p0, p1, q0, q1 = np.ones(n), np.zeros(n), np.zeros(n), np.ones(n)
    for t in range(SLOTS):
        p0, p1 = p0 * a[t] + p1 * c[t], p0 * b[t] + p1 * d[t]
        q0, q1 = q0 * a[t] + q1 * c[t], q0 * b[t] + q1 * d[t]
        scale = 1 / (p0 + p1 + q0 + q1)
        p0, p1, q0, q1 = p0 * scale, p1 * scale, q0 * scale, q1 * scale
    # what enters each run from its left and its right
    left, right = np.zeros(n), np.full(n, 0.5)  # share of state 1
    here, back = np.zeros(len(lens)), np.full(len(lens), 0.5)
    for k in range(int(runs.max(initial=0))):
        on = np.flatnonzero(runs > k)
        i, j = first[on] + k, first[on] + runs[on] - 1 - k
        left[i], right[j] = here[on], back[on]
        v1 = here[on]
        y0, y1 = (1 - v1) * p0[i] + v1 * q0[i], (1 - v1) * p1[i] + v1 * q1[i]
        here[on] = y1 / (y0 + y1)
        v1 = back[on]
        y0, y1 = (1 - v1) * p0[j] + v1 * p1[j], (1 - v1) * q0[j] + v1 * q1[j]
        back[on] = y1 / (y0 + y1)
    before = np.empty((SLOTS, n))
    state = left
    for t in range(SLOTS):
        before[t] = state
        y0, y1 = (1 - state) * a[t] + state * c[t], (1 - state) * b[t] + state * d[t]
        state = y1 / (y0 + y1)
    marginal, moved = np.empty((SLOTS, n)), np.zeros(3)
    state = right
    for t in range(SLOTS - 1, -1, -1):
        u1, w1 = before[t], state
        u0, w0 = 1 - u1, 1 - w1
        s00, s01, s10, s11 = u0 * a[t] * w0, u0 * b[t] * w1, u1 * c[t] * w0, u1 * d[t] * w1
        total = s00 + s01 + s10 + s11
        marginal[t] = (s01 + s11) / total
        if pairs:
            on = real[t] / total
            moved += [s01 @ on, s10 @ on, s11 @ on]
        y0, y1 = a[t] * w0 + b[t] * w1, c[t] * w0 + d[t] * w1
        state = y1 / (y0 + y1)
    out = marginal[slot, run]
    return (out, moved) if pairs else out


def evidence(marginals: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """For each text: log of its expected toxic tokens, largest marginal."""
    out = np.zeros((len(lens), 2))
    has = np.flatnonzero(lens)
    if len(has):
        at = (np.cumsum(lens) - lens)[has]
        out[has, 0] = np.add.reduceat(marginals, at)
        out[has, 1] = np.maximum.reduceat(marginals, at)
    out[:, 0] = np.log(out[:, 0] + 1e-3)
    return out


def _first_of_group(group: np.ndarray, label: np.ndarray, lens: np.ndarray, ids: np.ndarray, pw: np.ndarray,
                    pf: np.ndarray, n_features: int) -> np.ndarray:
    """Numbers of groups of near copies that hold a feature, by the label of the first document of the
    group with it: 2 rows of counts."""
    counts = np.zeros((2, n_features), np.int64)
    order = np.argsort(group, kind="stable")
    first, each = np.searchsorted(pw, np.arange(pw[-1] + 2 if len(pw) else 1)), np.cumsum(lens) - lens
    for same in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
        seen = np.zeros(0, np.int64)
        for d in same.tolist():
            words = np.unique(ids[each[d]:each[d] + lens[d]])
            n = first[words + 1] - first[words]
            at = np.repeat(first[words] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            new = np.setdiff1d(pf[at], seen)
            counts[label[d], new] += 1
            seen = np.union1d(seen, new) if len(same) > 1 else seen
    return counts


def _markers(counts: np.ndarray, sizes: np.ndarray, share: float, least: int, ratio: float) -> np.ndarray:
    """Features that mark toxic documents: in ``share`` of them (in ``least`` at the least), and ``ratio``
    times as often as in clean ones."""
    rate = (sizes[1] + 1) / (sizes[0] + 1)
    support = max(least, share * sizes[1])
    return (counts[1] >= support) & ((counts[1] + 0.5) / (counts[0] + 0.5) >= ratio * rate)


def train(vocabulary: list[bytes], ids: np.ndarray, lens: np.ndarray, toxic: np.ndarray, same: np.ndarray,
          prior: tuple[float, float], share: float = 0.005, least: int = 2, ratio: float = 50.0,
          rounds: int = 40) -> Model:
    """ids: the word numbers (of ``vocabulary``) of all documents end to end; lens, toxic, same: number of words,
    label and group of near copies of each. prior: numbers of clean and toxic labelled documents."""
    if len(set(toxic.tolist())) < 2:
        return Model()
    common = Counter(f for w in vocabulary for f in features(w))
    known: dict[bytes, int] = {}
    pair_word, pair_feature = [], []
    for i, w in enumerate(vocabulary):
        for f in features(w):
            if f[:1] == b"=" or common[f] >= 2:
                pair_word.append(i)
                pair_feature.append(known.setdefault(f, len(known)))
    del common
    pw, pf = np.array(pair_word, np.int64), np.array(pair_feature, np.int64)
    del pair_word, pair_feature
    markers = _markers(_first_of_group(same, toxic, lens, ids, pw, pf, len(known)), np.bincount(toxic, minlength=2),
                       share, least, ratio)
    marked = np.bincount(pw, markers[pf], len(vocabulary)) > 0
    label = (marked[ids] & np.repeat(toxic == 1, lens)).astype(float)
    starts = np.cumsum(lens) - lens
    last = np.r_[0.0, label[:-1]] if len(label) else label
    last[starts[lens > 0]] = 0.0
    seen = np.array([((1 - last) * label).sum(), (last * (1 - label)).sum(), (last * label).sum()])
    names = vocabulary
    theta, steps, bias = np.zeros(len(known)), np.zeros(3), -4.0
    square, square_steps, square_bias = np.full(len(known), 1e-6), np.full(3, 1e-6), 1e-6
    has = lens[lens > 0]
    ends = np.cumsum(has)
    blocks = [(slice(int(ends[lo] - has[lo]), int(ends[hi - 1])), slice(lo, hi))
              for lo, hi in row_slices(np.concatenate([[0], ends]), 100_000)]
    positive = np.bincount(ids, label, len(names))
    for _ in range(rounds if len(ids) else 0):
        word = np.bincount(pw, theta[pf], len(names)) + bias
        factor, moved, miss = np.exp(np.clip(word, -30, 30)), np.zeros(3), positive.copy()
        for tokens, rows_ in blocks:
            m, part = forward_backward(factor[ids[tokens]], has[rows_], tuple(np.exp(steps)), pairs=True)
            moved += part
            miss -= np.bincount(ids[tokens], m, len(names))
        g = np.bincount(pf, miss[pw], len(known)) - 0.05 * theta
        square += g * g
        theta += 0.5 * g / np.sqrt(square)
        g = seen - moved
        square_steps += g * g
        steps += 0.2 * g / np.sqrt(square_steps)
        square_bias += miss.sum() ** 2
        bias += 0.5 * miss.sum() / np.sqrt(square_bias)
    weights = {f: float(theta[i]) for f, i in known.items() if abs(theta[i]) > 0.05}
    model = Model(weights, float(bias), tuple(np.exp(steps).tolist()))
    of_word = Factors(model)
    factor = np.array([of_word[w] for w in names])
    m = np.concatenate([forward_backward(factor[ids[tokens]], has[rows_], model.steps)
                        for tokens, rows_ in blocks] or [np.zeros(0)])
    x = np.c_[np.ones(len(lens)), evidence(m, lens)]
    held = np.bincount(toxic, minlength=2)
    weight = np.array([prior[k] / held[k] for k in (0, 1)])[toxic]
    weight /= weight.mean()
    beta = np.zeros(3)
    for _ in range(30):
        y = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        h = (x * (weight * y * (1 - y))[:, None]).T @ x + np.eye(3) * 0.1
        beta += np.linalg.solve(h, x.T @ (weight * (toxic - y)) - 0.1 * beta)
    model.score = tuple(beta.tolist())
    return model


class Factors(dict):
    """exp of a word's evidence, kept for the words met so far."""

    def __init__(self, model: Model, most: int = 300_000) -> None:
        super().__init__()
        self.model, self.most = model, most

    def __missing__(self, word: bytes) -> float:
        if len(self) >= self.most:
            self.clear()
        get = self.model.weights.get
        e = self.model.bias + sum(get(f, 0.0) for f in features(word))
        out = self[word] = float(np.exp(min(max(e, -30.0), 30.0)))
        return out


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))


def _spans(raw: bytes, marginals: np.ndarray) -> list[dict]:
    out: list[dict] = []
    joined = False
    for found, m in zip(WORD.finditer(raw.lower()), marginals.tolist()):
        if m >= 0.5 and joined:
            out[-1]["end"], out[-1]["score"] = found.end(), max(out[-1]["score"], m)
        elif m >= 0.5:
            out.append({"start": found.start(), "end": found.end(), "score": m})
        joined = m >= 0.5
    for s in out:
        s["start"], s["end"] = len(raw[:s["start"]].decode()), len(raw[:s["end"]].decode())
    return out


def _score(model: Model, marginals: np.ndarray, lens: np.ndarray) -> np.ndarray:
    if model.score is None:
        return np.zeros(len(lens))
    z = model.score[0] + evidence(marginals, lens) @ np.array(model.score[1:])
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def _scorer(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = Factors(model)
        for batch in batches:
            data, at = flat(batch.column("text"))
            scores, spans = [], []
            for lo, hi in row_slices(at, 1 << 20):
                raw = [data[at[i]:at[i + 1]].tobytes() for i in range(lo, hi)]
                words = [WORD.findall(r.lower()) for r in raw]
                lens = np.array([len(w) for w in words])
                x = np.fromiter((factor[w] for ws in words for w in ws), float, int(lens.sum()))
                m = forward_backward(x, lens[lens > 0], model.steps) if len(x) else x
                scores.append(_score(model, m, lens))
                ends = np.cumsum(lens)
                for i, r in enumerate(raw):
                    own = m[ends[i] - lens[i]:ends[i]]
                    spans.append(_spans(r, own) if len(own) and own.max() >= 0.5 else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                 pa.array(spans, SPANS)], ["doc_id", "score", "spans"])
    return run


def learnt(docs: DataFrame, labels: DataFrame, held_out: int = 5, sample: int = 2000,
           sample_chars: int = 100_000) -> Model:
    """The model of the labelled documents whose crc32 of doc_id modulo
    ``held_out`` is not 0."""
    usable = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % held_out != 0)
              .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    counts = {r["toxic"]: r["n"] for r in usable.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [usable.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
              for k in (0, 1)]
    # 2 * sample ids at most
    chosen = F.broadcast(picked[0].unionByName(picked[1]))
    texts = (docs.select("doc_id", "text").where(F.length("text") <= sample_chars)
             .join(chosen, "doc_id").dropDuplicates(["doc_id"]).select("toxic", "text"))
    tokens = staged(texts.mapInArrow(_tokens, "toxic int, same long, words array<binary>"), "tokens")
    # the driver gets numbers and each word once, never texts
    coded = tokens.select("toxic", "same", F.transform("words", lambda w: F.xxhash64(w)).alias("codes")).toArrow()
    known = tokens.select(F.explode("words").alias("word")).distinct().select("word", F.xxhash64("word").alias("code"))
    known = known.orderBy("code").toArrow()
    codes = known["code"].to_numpy()
    lists = coded["codes"].combine_chunks()
    ids = np.searchsorted(codes, lists.flatten().to_numpy()).astype(np.int32)
    lens = lists.value_lengths().to_numpy().astype(np.int64)
    toxic, same = coded["toxic"].to_numpy().astype(int), coded["same"].to_numpy()
    del coded, lists
    return train(known["word"].to_pylist(), ids, lens, toxic, same, (counts.get(0, 0), counts.get(1, 0)))


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """toxic, same, words: a text's words, and the least hash of five of them in a row, which near
    copies share mostly."""
    for batch in batches:
        data, at = flat(batch.column("text"))
        words = [WORD.findall(data[at[i]:at[i + 1]].tobytes().lower()) for i in range(len(batch))]
        same = [min((zlib.crc32(b" ".join(w[i:i + 5])) for i in range(max(1, len(w) - 4))), default=0) for w in words]
        yield pa.RecordBatch.from_arrays(
            [batch.column("toxic"), pa.array(same, pa.int64()), pa.array(words, pa.list_(pa.binary()))],
            ["toxic", "same", "words"])


def toxicity(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, score, spans (start, end, score): one row per row of ``docs``."""
    model = learnt(docs, labels, **options)
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        _scorer(model),
        f"doc_id {kind}, score double, spans array<struct<start: long, end: long, score: double>>")


def _keep_clean(model: Model, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factor = Factors(model)
        for batch in batches:
            data, at = flat(batch.column("text"))
            scores = [np.zeros(0)]
            for lo, hi in row_slices(at, 1 << 20):
                words = [WORD.findall(data[at[i]:at[i + 1]].tobytes().lower()) for i in range(lo, hi)]
                lens = np.array([len(w) for w in words])
                x = np.fromiter((factor[w] for ws in words for w in ws), float, int(lens.sum()))
                m = forward_backward(x, lens[lens > 0], model.steps) if len(x) else x
                scores.append(_score(model, m, lens))
            yield batch.filter(pa.array(np.concatenate(scores) < threshold))
    return run


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """``docs`` without the documents of a score of ``threshold`` or more."""
    return docs.mapInArrow(_keep_clean(learnt(docs, labels, **options), threshold), docs.schema)
