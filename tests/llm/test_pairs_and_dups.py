"""Exact dedup, byte-string dedup, Jaccard join and line dedup against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import marlstone.llm.line_dedup as ld
from marlstone.llm.common import bit_filter, key_ranges, maybe_in, without
from marlstone.llm.components import components
from marlstone.llm.exact_dedup import exact_dedup, powers
from marlstone.llm.jaccard_join import jaccard_dedup, jaccard_join, survival
from marlstone.llm.line_dedup import (
    _shared_bands, alike, alike_pairs, drop_repeated_lines, line_dedup, linked_lines, shingle_sets)
from marlstone.llm.queries import op3_suffix_dedup
from marlstone.llm.suffix_dedup import SLICE, suffix_dedup
from tests.llm.fixtures import SCHEMA, corpus, make_text, words

ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def low(doc_id):
    return -1 if doc_id is None else doc_id


@pytest.mark.parametrize("chunk, primes", [(1 << 20, (2147483647, 2147483629)), (7, (2147483647, 2147483629)),
                                           (64, (3, 5))])
def test_exact_dedup(docs, chunk, primes):
    # two tiny primes make fingerprints collide, so that the comparison decides
    groups = defaultdict(list)
    for i, t, *_ in ROWS:
        groups[t or ""].append(i)
    expected = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        for n, i in enumerate(sorted(ids, key=lambda x: (x != keep, low(x)))):
            expected[(i, keep, len(ids), n == 0, sha)] += 1
    assert Counter(rows_of(exact_dedup(docs, chunk=chunk, primes=primes))) == expected


def test_fingerprints_compose():
    p, r = 2147483647, 911382323
    table = powers(r, p, 300)
    data = np.random.default_rng(0).integers(0, 256, 300)
    whole = sum(int(b + 1) * pow(r, j, p) for j, b in enumerate(data.tolist())) % p
    parts = [int((data[s:s + 37] + 1) @ table[:len(data[s:s + 37])]) % p * pow(r, s, p) for s in range(0, 300, 37)]
    assert sum(parts) % p == whole


@pytest.mark.parametrize("length", [32, 48, 400])
def test_suffix_dedup(docs, length):
    texts = [(i, (t or "").encode()) for i, t, *_ in ROWS]
    seen = Counter(b[k:k + length] for _, b in texts for k in range(len(b) - length + 1))
    expected = Counter()
    for i, b in texts:
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k] += 1
                gone[k + length] -= 1
        mark = np.cumsum(gone)[:len(b)] > 0
        spans = int((mark & ~np.r_[False, mark[:-1]]).sum()) if len(b) else 0
        expected[(i, len(b), int(mark.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~mark]))] += 1
    got = Counter((r[0], r[1], r[2], r[3], bytes(r[4])) for r in suffix_dedup(docs, length).collect())
    assert got == expected


def test_suffix_dedup_query_on_passages(spark, tmp_path):
    # 400 bytes decide, not the number of words; n_bytes is the input's length whatever is removed
    rng = random.Random(3)
    long, short = make_text(rng, 130), "".join(f"{w:04d} " for w in range(60))
    assert len(long.encode()) >= 400 > len(short) and len(short.split()) > 50
    body = "".join(rng.choices("abcdefgh ", k=SLICE + 5000))
    edge = body[SLICE - 300:SLICE + 500]
    parts = {0: ("A", long, "B"), 1: ("C", long, "D"), 2: (f"A{short}B", "", ""), 3: (f"C{short}D", "", ""),
             4: (make_text(rng, 300), "", ""), 5: (body[:SLICE - 300], edge, body[SLICE + 500:]), 6: ("A", edge, "B")}
    spark.createDataFrame([(i, "".join(x)) for i, x in parts.items()], "doc_id long, text string") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    expected = {(i, len("".join(x).encode()), len(x[1].encode()), int(x[1] != ""),
                 hashlib.sha256((x[0] + x[2]).encode()).hexdigest()) for i, x in parts.items()}
    assert set(rows_of(op3_suffix_dedup(spark, str(tmp_path)))) == expected


def test_suffix_dedup_rejects_other_lengths(docs):
    with pytest.raises(ValueError):
        suffix_dedup(docs, 100)


def shingles(text):
    w = words(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard_truth():
    sets = [shingles(t) for _, t, *_ in ROWS]
    root, links = list(range(len(sets))), [0] * len(sets)

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= 0.8 * len(a | b):
                links[i] += 1
                links[j] += 1
                root[top(i)] = top(j)
    least = {}
    for i, (d, *_) in enumerate(ROWS):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [(d, len(sets[i]), least.get(top(i)) if sets[i] else d, links[i]) for i, (d, *_) in enumerate(ROWS)]


@pytest.mark.parametrize("options", [{}, {"limit": 2, "block": 3, "depth": 4, "recall": 0.999}])
def test_jaccard_join(docs, options):
    got = rows_of(jaccard_join(docs, **options).drop("text_key"))
    assert Counter(got) == Counter(jaccard_truth())


def test_jaccard_dedup(docs):
    got = rows_of(jaccard_dedup(docs))
    truth = jaccard_truth()
    classes = {c for (_, n, c, _), _r in zip(truth, ROWS) if n}
    with_words = [r for r in got if words(r[1])]
    assert sorted(low(r[0]) for r in with_words) == sorted(low(c) for c in classes)
    assert len(got) - len(with_words) == sum(1 for r in ROWS if not words(r[1]))
    assert set(got) <= set(ROWS)


def test_large_group_of_near_copies(spark):
    """Records that stay together under every token: their buckets are kept whole, once,
    and compared in blocks; other texts beside them are not linked."""
    rng = np.random.default_rng(9)
    base = [f"word{x}" for x in rng.integers(0, 10_000, 150)]
    texts = []
    for i in range(150):
        words_ = list(base)
        words_[int(rng.integers(0, 150))] = f"changed{i}"
        texts.append(" ".join(words_))
    texts += [" ".join(f"other{x}" for x in rng.integers(0, 10_000, 60)) for _ in range(100)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [shingles(t) for t in texts]
    truth = [sum(1 for j, b in enumerate(sets) if i != j and len(a & b) >= 0.8 * len(a | b))
             for i, a in enumerate(sets)]
    for options in ({"limit": 16, "block": 32, "recall": 0.999}, {"limit": 16, "block": 1024, "recall": 0.999, "depth": 4}):
        got = {r.doc_id: r for r in jaccard_join(docs, **options).collect()}
        assert all(got[i].class_id == (0 if i < 150 else i) for i in range(250))
        assert all(got[i].n_links <= n for i, n in enumerate(truth))
        assert sum(r.n_links for r in got.values()) >= 0.98 * sum(truth)


def test_runs_reach_the_recall():
    # the branching process against its simulation
    rng = np.random.default_rng(3)
    alive = np.ones(20_000, int)
    for _ in range(5):
        alive = rng.poisson(0.8 / 0.6 * alive)
    assert abs((alive > 0).mean() - survival(0.8, 5)) < 0.02


def line_shingles(line):
    return shingle_sets(np.frombuffer(line, np.uint8), np.array([0, len(line)]))[0]


def test_line_shingles():
    lines = [b"abcdefghijk", b"short", b"", b"abababababab", b"abcdefgh"]
    got = shingle_sets(np.frombuffer(b"".join(lines), np.uint8), np.cumsum([0] + [len(x) for x in lines]))
    for line, found in zip(lines, got):
        assert found.tolist() == sorted({int.from_bytes(line[i:i + 8], "big") for i in range(len(line) - 7)})


def _batches(rng, rows, names):
    """The rows in batches of random sizes, empty ones too."""
    while rows:
        some, rows = rows[:(k := rng.randint(0, 7))], rows[k:]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(zip(*some)) or [[], []])], names)


def test_sorted_rows_across_batches():
    """Bands with two lines and groups of a key, however the rows are cut into batches."""
    rng = random.Random(1)
    for _ in range(200):
        rows = sorted((rng.randint(0, 12), rng.randint(0, 3)) for _ in range(rng.randint(0, 60)))
        got = [r for b in _shared_bands(_batches(rng, rows, ["band", "line"]))
               for r in zip(*(c.to_pylist() for c in b.columns))]
        lines = {band: {x for b, x in rows if b == band} for band, _ in rows}
        assert got == sorted({r for r in rows if len(lines[r[0]]) > 1})
        groups = [table["key"].to_pylist()[lo:hi] for table, cut in key_ranges(_batches(rng, rows, ["key", "v"]))
                  for lo, hi in zip(cut, cut[1:])]
        assert [g[0] for g in groups] == sorted(lines) and sum(groups, []) == [r[0] for r in rows]


@pytest.mark.parametrize("settled", [1, 3, 50, 1 << 21])
def test_packed_bands_are_settled_in_turns(monkeypatch, settled):
    monkeypatch.setattr(ld, "SETTLED", settled)
    rng = random.Random(settled)
    for _ in range(60):
        pairs = [(rng.randrange(-30, 30) << 57, rng.randrange(6)) for _ in range(rng.randrange(80))]
        packed = [ld._packed([np.array(pairs[i:i + 7], np.int64)]) for i in range(0, len(pairs), 7)]
        got = [r for b in ld._met(iter(packed)) for r in zip(*(c.to_pylist() for c in b.columns))]
        lines = defaultdict(set)
        for band, line in pairs:
            lines[band].add(line)
        assert set(got) == {r for r in pairs if len(lines[r[0]]) > 1}
        assert len(got) == len(set(got)) or settled < len(pairs)


def test_bands_travel_packed():
    rng = random.Random(5)
    bodies = [" ".join(rng.choices(["lorem", "ipsum", "dolor", "sit"], k=9)) for _ in range(400)] + ["short", ""]
    batch = pa.RecordBatch.from_pydict({"line": list(range(402)), "body": bodies})
    rows = list(ld._band_keys(iter([batch, batch])))
    assert len(rows) == 1 and rows[0].num_rows <= 1 << ld.PART_BITS
    pairs = [r for b in ld._unpacked(iter(rows)) for r in zip(*(c.to_pylist() for c in b.columns))]
    assert Counter(line for _, line in pairs) == {i: 2 * ld.BANDS for i in range(400)}
    # all pairs of a band are in one part
    parts = {band: {(band % (1 << 64)) >> (64 - ld.PART_BITS)} for band, _ in pairs}
    for part, packed in zip(*(c.to_pylist() for c in rows[0].columns)):
        for band in np.frombuffer(packed, np.int64)[::2].tolist():
            parts[band].add(part)
    assert {len(p) for p in parts.values()} == {1}


def line_truth(least=24, similarity=0.8):
    docs = sorted({(low(i), i, t) for i, t, *_ in ROWS if t is not None}, key=lambda x: x[0])
    found = {}
    for rank, i, t in docs:
        for k, line in enumerate(t.split("\n")):
            body = line.lower().strip(" ")
            if body:
                found.setdefault(body, []).append((rank, t, k))
    bodies = list(found)
    root = list(range(len(bodies)))
    sets = [{b.encode()[i:i + 8] for i in range(len(b.encode()) - 7)} for b in bodies]

    def top(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            # shorter lines are alike only if equal
            if min(len(bodies[i]), len(bodies[j])) >= least and len(a & b) >= similarity * len(a | b):
                root[top(i)] = top(j)
    classes = defaultdict(list)
    for i, b in enumerate(bodies):
        classes[top(i)] += found[b]
    return docs, classes


def test_line_dedup(docs):
    got = {}
    for r in line_dedup(docs).collect():
        got[(r["doc_id"], r["n_lines"], r["n_removed"], r["text"])] = got.get(
            (r["doc_id"], r["n_lines"], r["n_removed"], r["text"]), 0) + 1
    truth_docs, classes = line_truth()
    # one line of each class is left, by the least doc_id; texts of one NULL id tie by a hash
    gone = defaultdict(set)
    for members in classes.values():
        first = min(m[0] for m in members)
        for m in members:
            if m[0] != first:
                gone[m[:2]].add(m[2])
            else:
                places = [x for x in members if x[0] == first]
                if len({x[1] for x in places}) == 1 and m[2] != min(x[2] for x in places):
                    gone[m[:2]].add(m[2])
    for rank, i, t in truth_docs:
        if rank < 0:
            continue
        lines = t.split("\n")
        kept = "\n".join(x for k, x in enumerate(lines) if k not in gone[(rank, t)])
        assert got.get((i, len(lines), len(gone[(rank, t)]), kept)) == sum(r[:2] == (i, t) for r in ROWS)
    assert sum(got.values()) == len(ROWS)


@pytest.mark.parametrize("block", [2, 8, 256])
def test_lines_of_a_large_band(spark, block):
    # near copies of three lines, and lines that only begin alike
    rng = np.random.default_rng(2)
    base = ["".join(rng.choice(list("abcdefgh "), 200)) for _ in range(3)]
    lines = [b[:k] + "#" + b[k + 1:] for b in base for k in range(20, 180, 4)]
    lines += [base[0][:150] + "".join(rng.choice(list("xyz"), 150)) for _ in range(40)]
    rows = spark.createDataFrame(list(enumerate(lines)), "line long, body string")
    found = dict(rows_of(components(linked_lines(rows, 0.8, block))))
    for g in range(3):
        assert len({found.get(i, i) for i in range(40 * g, 40 * g + 40)}) == 1
    assert len({found.get(i, i) for i in range(len(lines))}) == 43


def test_blocks_of_a_large_band_lose_no_link(spark):
    # variants of one line, many pairs near the limit: classes hang together through lines that are no heads
    rng = np.random.default_rng(4)
    lines = []
    for g in range(5):
        base = rng.choice(list("abcdefgh "), 200)
        for _ in range(100):
            line = base.copy()
            line[rng.choice(200, 1 + g // 2 if g % 2 else 2, replace=False)] = rng.choice(list("xyz#"))
            lines.append("".join(line))
    rows = spark.createDataFrame(list(enumerate(lines)), "line long, body string").cache()
    whole, dealt = (dict(rows_of(components(linked_lines(rows, 0.8, b)))) for b in (len(lines), 8))
    assert whole and dealt == whole


def test_pairs_of_a_group_by_product():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40, n).astype(np.uint64)) for n in rng.integers(0, 60, 50)]
    sets += [np.arange(9000, dtype=np.uint64), np.arange(8000, dtype=np.uint64)]
    truth = {(i, j) for i in range(len(sets)) for j in range(i) if alike(sets[i], sets[j], 0.7)}
    assert truth and set(alike_pairs(sets, 0.7)) == truth


def test_line_shingles():
    assert len(line_shingles(b"short")) == 0
    a, b = line_shingles(b"abcdefghij"), line_shingles(b"abcdefghijk")
    assert len(a) == 3 and not alike(a, b, 0.8) and alike(a, b, 0.75)


def test_line_dedup_keeps_columns_and_clean_documents(docs):
    cut = drop_repeated_lines(docs)
    assert cut.columns == docs.columns
    ids = {r[0] for r in cut.select("doc_id").collect()}
    # the first of their texts; 5 and 50 are also there without an id, which comes first
    assert set(range(60)) - {5, 50} <= ids and None in ids
    bad = cut.where("n_chars <> length(text)").count()
    assert bad == 0


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(k, k + 1) for k in range(1000, 1100)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x
    for a, b in edges:
        hi, lo = max(top(a), top(b)), min(top(a), top(b))
        root[hi] = lo
    got = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long"))))
    assert {x: got.get(x, x) for x in root} == {x: top(x) for x in root}


def test_filters_lose_nothing(spark):
    df = spark.range(5000).selectExpr("id as doc_id", "id * 7 as text_key")
    some = df.where("doc_id % 11 = 0")
    hit, rest = maybe_in(df, ["doc_id"], bit_filter(some, ["doc_id"]), other=True)
    assert hit.count() + rest.count() == 5000
    assert hit.join(some, "doc_id").count() == some.count()
    assert hit.count() < 600
    assert without(df, some).count() == 5000 - some.count()


@pytest.mark.parametrize("operator", [exact_dedup, suffix_dedup, jaccard_join, jaccard_dedup, line_dedup])
def test_empty_table(docs, operator):
    assert operator(docs.limit(0)).count() == 0
