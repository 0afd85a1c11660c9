"""corpus_pipeline.run on a small corpus: every stage replayed on what its predecessor kept."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from marlstone.llm.decontamination import decontaminate
from marlstone.llm.jaccard_join import jaccard_join
from marlstone.llm.line_dedup import line_dedup
from marlstone.llm.toxicity import toxicity
from tests.llm.fixtures import make_text, words

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Clean texts, a toxic vocabulary, near copies, benchmark passages, repeated lines, NULLs, long texts."""
    rng = random.Random(12)
    base = [make_text(rng, rng.randint(30, 150)) for _ in range(120)]
    items = [make_text(rng, 30) for _ in range(4)]
    texts = list(base)
    for i in range(60):
        parts = make_text(rng, 60).split(" ")
        for _ in range(5):
            parts.insert(rng.randrange(len(parts)), rng.choice(["idiot", "scum", "worthless"]))
        texts.append(" ".join(parts))
    for t in base[:10]:
        parts = t.split(" ")
        parts[len(parts) // 2] = "changed"
        texts.append(" ".join(parts))
    for _ in range(6):  # the same words in other lines: near copies that the line stage leaves
        w = words(make_text(rng, 120))
        texts += ["\n".join(" ".join(w[i:i + n]) for i in range(0, len(w), n)) for n in (9, 16)]
    texts += [make_text(rng, 20) + " " + " ".join(words(i)) for i in items]
    texts += [base[50], base[50] + "\n" + make_text(rng, 40), None, "", "   ", make_text(rng, 9000)]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)] + [(None, base[51], "en", "s", 5)]
    out = tmp_path_factory.mktemp("corpus")
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{out}/documents.parquet")
    labels = [(i, 0, int(120 <= i < 180)) for i in range(180)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_stages_take_effect_one_after_the_other(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("labels", "benchmark"))
    kept, held = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, held, sf_dir)
        if name != "packing":
            assert out.columns == docs.columns, name
        path = f"{sf_dir}/{name}"
        out.write.parquet(path)
        kept[name], held = (held, spark.read.parquet(path)), spark.read.parquet(path)

    before, after = kept["toxicity"]
    scores = {(r.doc_id, r.score < 0.5) for r in toxicity(before, labels).select("doc_id", "score").collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, clean in scores if clean}
    assert len([i for i, clean in scores if not clean]) >= 50
    assert set(range(100)) <= {r.doc_id for r in after.collect()}

    before, after = kept["line_dedup"]
    cut = line_dedup(before).collect()
    assert Counter(r.text for r in after.collect()) == Counter(
        r.text for r in cut if r.n_removed == 0 or r.text.strip(" "))
    assert any(r.n_removed for r in cut)

    before, after = kept["jaccard_join"]
    classes = jaccard_join(before)
    groups = {r.class_id if r.class_id is not None else (r.doc_id,) for r in classes.collect()}
    assert after.count() == len(groups) < before.count()

    before, after = kept["decontamination"]
    bad = {r.doc_id for r in decontaminate(before, items).where("contaminated").collect()}
    assert len(bad) >= 4
    assert rows_of(after) == Counter({k: n for k, n in rows_of(before).items() if k[0] not in bad})

    before, after = kept["packing"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()}
    filled = {}
    for r in after.collect():
        filled.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert rows_of(corpus_pipeline.run(spark, sf_dir).select("doc_id", "piece", "start", "length", "ids_crc32")) == rows_of(
        after.select("doc_id", "piece", "start", "length", "ids_crc32"))


def test_empty_documents(spark, sf_dir, tmp_path):
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    spark.createDataFrame([], DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
