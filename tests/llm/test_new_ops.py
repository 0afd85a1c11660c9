"""Prefix trie, periodic runs and sharding: brute force, edge cases and SQL."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import __spark_entry__ as entry
from marlstone.llm.periodic_runs import periodic_runs, run_digest, runs_of, split_segments
from marlstone.llm.prefix_trie import numbered_turns, prefix_trie, rebuilt_turns
from marlstone.llm.queries import with_repeats
from marlstone.llm.sharding import keyed, shard_documents
from tests.conftest import SF_SMALL
from tests.llm.fixtures import SCHEMA, corpus
from tests.oracle_check import compare

ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SF_SMALL, ["op11_prefix_trie", "op12_periodic_runs", "op13_sharding"])


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_periodic_runs", "op13_sharding"])
def test_query_matches_sql(results, name):
    assert results[name]["columns_match"] and results[name]["values_match"], results[name]
    assert name in entry.queries() and name in entry.oracle_sql()


# --- prefix trie -------------------------------------------------------------

def spaced(text):
    return (text or "").encode().split()


def trie_of(sequences):
    """conv -> tuple of (role, text): the rows that the operator gives."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    children = defaultdict(list)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out, totals = [], {}
    for p in sorted(members, key=len, reverse=True):
        saved = (len(members[p]) - 1) * len(spaced(p[-1][1])) if p else 0
        totals[p] = (sum(totals[k][0] for k in children[p]) or 1, saved + sum(totals[k][1] for k in children[p]))
        listed = ",".join(map(str, sorted(ends[p])))
        out.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(children[p]),
                    *totals[p], hashlib.sha256(listed.encode()).hexdigest()))
    return Counter(out)


def own_sequences(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            turns[c].append((t is not None, t or 0, name, (role, text)))
    return {c: tuple(x[-1] for x in sorted(v)) for c, v in turns.items()}


def rebuilt(own):
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = own.get(base, ())[:h] + seq[h:]
    return out


def conversations(rng, n, depth, words):
    """Conversations that share beginnings, whole copies, NULLs, ties, gaps between turns."""
    rows, said = [], [" ".join(rng.choices(["a", "b", "c\td", "é"], k=k % words)) for k in range(4)] + [None, ""]
    for c in rng.sample(range(-3, 3 * n), n):
        size = rng.choice([1, 2, 3, depth, depth])
        for t in range(size):
            turn = rng.choice([None, 0]) if t == 0 else t * 3
            rows.append((c, turn, rng.choice(["user", None, "user"]), rng.choice(said[:2]) if t % 3 else said[t % 5]))
    rows += [(None, 0, "user", "nobody's")] * 2 + [(0, 1, "user", "tie"), (0, 1, "user", "other"), (0, 1, "user", "tie")]
    rng.shuffle(rows)
    return rows


TURNS = "conv_id long, turn long, role string, text string, name string, at long, depth int, conv long"


@pytest.mark.parametrize("seed, depth", [(1, 4), (3, 70)])
def test_prefix_trie(spark, seed, depth):
    rows = conversations(random.Random(seed), 40, depth, 5)
    table = spark.createDataFrame([(*r, "clash", 1, 2, 3) for r in rows], TURNS).repartition(5)
    own = numbered_turns(table).cache()
    convs = own.select("conv").distinct()
    sequences = own_sequences(rows)
    assert Counter(map(tuple, prefix_trie(own, convs).collect())) == trie_of(sequences)
    assert Counter(map(tuple, prefix_trie(rebuilt_turns(own), convs).collect())) == trie_of(rebuilt(sequences))


def test_prefix_trie_of_copies_and_turnless(spark):
    # base 20 is absent, so its followers of few turns have none left
    rows = [(c, t, "user", "same words here") for c in range(21, 40) for t in range(1 + c % 3)]
    rows += [(c, t, "user", "x") for c in range(100, 9000, 7) for t in range(2)]
    own = numbered_turns(spark.createDataFrame([(*r, "", 0, 0, 0) for r in rows], TURNS)).cache()
    got = prefix_trie(rebuilt_turns(own), own.select("conv").distinct())
    expected = trie_of(rebuilt(own_sequences(rows)))
    assert Counter(map(tuple, got.collect())) == expected
    assert any(r[1] == 0 and r[-1] != hashlib.sha256(b"").hexdigest() for r in expected)


def test_prefix_trie_of_nothing(spark):
    own = numbered_turns(spark.createDataFrame([], TURNS))
    assert prefix_trie(rebuilt_turns(own), own.select("conv").distinct()).collect() == []


# --- periodic runs -----------------------------------------------------------

def brute_runs(words):
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            size = j - i + q
            if size >= max(6, 4 * q) and not any(
                    all(words[x] == words[x + p] for x in range(i, i + size - p)) for p in range(1, q)):
                found.append((i, size, q))
            i = max(j, i + 1) if j == i else j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return b" ".join(w for i, w in enumerate(words) if i not in gone)


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=6), st.integers(1, 7)), max_size=8))
def test_runs_against_brute_force(parts):
    words = [x for block, times in parts for x in block * times]
    got = runs_of(np.array(words, np.int64), np.array([0, len(words)]), 4, 6)
    assert got == [brute_runs(words)]


def test_runs_of_several_texts_do_not_meet():
    codes = np.array([1, 2] * 3 + [1, 2] * 5 + [7] * 9)
    assert runs_of(codes, np.array([0, 6, 16, 16, 25]), 4, 6) == [[], [(0, 10, 2)], [], [(0, 9, 1)]]


def test_segments_are_split_until_stable():
    # 5 splits the text, after that 1 is too rare on either side
    codes = np.array([1, 1, 1, 2, 2, 2, 2, 5, 1, 1, 2, 2, 2, 2, 2, 2])
    lows, highs = split_segments(codes, np.zeros(len(codes), np.int64), 4, 6)
    assert list(zip(lows.tolist(), highs.tolist())) == [(10, 16)]


def test_periodic_runs(spark, docs):
    texts = [("a b " * 40 + "c") * 3, "x " * 2000, " ".join("p q r s p q r s p q r s p q r s".split() * 30),
             "u v " * 8, "\tk\nk k\x0bk\x0ck\rk ", " ".join(f"w{i % 500}" for i in range(2600))]
    extra = [(1000 + i, t, "en", "s", 0, "clash", 1, 2) for i, t in enumerate(texts)]
    table = docs.unionByName(spark.createDataFrame(extra, SCHEMA)).withColumnRenamed("size", "n_words")
    found = periodic_runs(table, slice_bytes=5000)
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "text_key", "row", "n_words", "runs", "collapsed"]
    expected = Counter()
    for i, t, *_ in [*ROWS, *extra]:
        words = spaced(t)
        runs = brute_runs(words) if len(words) < 4000 else []
        expected[(i, len(words), tuple(runs), collapsed(words, runs).decode())] += 1
    got = Counter((r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in found.collect())
    assert got == expected
    assert sum(bool(k[2]) for k in expected) >= 5


def test_planted_repeats_and_digest(spark, docs):
    rows = [(i, t) for i, t, *_ in ROWS if len(spaced(t)) < 4000]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(map(tuple, run_digest(periodic_runs(with_repeats(table))).collect()))
    expected, changed = Counter(), 0
    for i, t in rows:
        words = planted(i, spaced(t))
        changed += words != spaced(t)
        runs = brute_runs(words)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
        expected[(i, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                  hashlib.sha256(listed).hexdigest(), hashlib.sha256(collapsed(words, runs)).hexdigest())] += 1
    assert got == expected and changed


def test_long_text_of_two_words(spark):
    # every segment survives the splitting, so the scan does all the work
    rng = random.Random(4)
    words = rng.choices([1, 2], k=60_000)
    words[20_000:30_000] = [1, 2, 2, 1, 2] * 2000
    (runs,) = runs_of(np.array(words), np.array([0, len(words)]), 4, 6)
    assert any(s <= 20_000 and s + n >= 30_000 and q == 5 for s, n, q in runs)
    short = words[:800]
    assert runs_of(np.array(short), np.array([0, 800]), 4, 6) == [brute_runs(short)]


def test_periodic_runs_of_nothing(docs):
    assert periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(docs, repeats=3)


# --- sharding ----------------------------------------------------------------

def jump(key, shards):
    key, b, j = (key or 0) % (1 << 64), -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_sharding(docs):
    got = shard_documents(docs.withColumnRenamed("size", "shard")).collect()
    expected = Counter()
    for i, t, *_ in ROWS:
        raw = (t or "").encode()
        expected[(i, len(raw) + 8, zlib.crc32(raw), "key", jump(i, 24), jump(i, 25))] += 1
    assert Counter((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard) for r in got) == expected
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_sharding_of_one_hot_id(spark):
    rows = [(7, "same")] * 3000 + [(i, str(i)) for i in range(6000)] + [(-1, None), (None, ""), (-(1 << 63), "x")]
    got = shard_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(16), 5).collect()
    assert len(got) == len(rows)
    by_shard = defaultdict(list)
    for r in got:
        by_shard[r.shard].append((r.slot, r.doc_id is not None, r.doc_id or 0))
        assert r.shard == jump(r.doc_id, 5) and r.grown_shard == jump(r.doc_id, 6)
    for placed in by_shard.values():
        placed.sort()
        assert [x[0] for x in placed] == list(range(len(placed)))
        assert [x[1:] for x in placed] == sorted(x[1:] for x in placed)


def test_only_the_needed_rows_move(spark):
    table = spark.range(20_000).selectExpr("id AS doc_id", "'' AS text")
    for shards in (1, 2, 24, 100):
        rows = keyed(table, shards).groupBy("shard", "grown_shard").count().collect()
        assert all(r.shard == r.grown_shard or r.grown_shard == shards for r in rows)
        moved = sum(r["count"] for r in rows if r.shard != r.grown_shard)
        assert abs(moved - 20_000 / (shards + 1)) < 5 * (20_000 / (shards + 1)) ** 0.5 + 5
    sizes = [r["count"] for r in keyed(table, 24).groupBy("shard").count().collect()]
    assert len(sizes) == 24 and max(sizes) < 1.25 * min(sizes)


def test_sharding_of_nothing(docs):
    assert shard_documents(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        shard_documents(docs, 0)
