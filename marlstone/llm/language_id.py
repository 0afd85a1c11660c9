"""Language of web pages by Bayesian fusion of four kinds of evidence.

- Text: a naive Bayes model of hashed byte trigrams, counted over all of
  ``documents`` by language. A page's log likelihoods are scaled as if it had
  ``tempered`` trigrams at most, because neighbours are not independent.
- Declared markup language (<html lang>): P(declared | language), estimated
  from all pages by grouped soft counts.
- Address suffix and host: a prior of the languages, smoothed hierarchically: the
  counts of a host are mixed with the estimate of its domain, those with the
  estimate of its suffix, those with all pages', each weighing ``weight``
  pages. Counts are soft (posteriors of the text alone) and leave
  out the page in question.

The posterior is proportional to prior * P(declared | language) * text. Groups
are summed by grouped aggregation, which combines before it shuffles, and
joined back as tables of one row for each host; a hot host is one row there.

The driver holds the trigram table: 32,768 numbers for each language, of which
``most_languages`` are allowed.

Defined cases: NULL html or one without visible text gives no text evidence; no
or an unknown declaration counts as a value of its own; a NULL or unusable url
has the empty host; documents with NULL lang or text teach nothing; repeated
rows count each; without documents lang is NULL; other columns are ignored.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import flat, row_slices, staged

CELLS = 1 << 15
HIDDEN = re.compile(r"<(script|style|nav|footer|aside|head)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)|<[^>]*>", re.S | re.I)


def trigrams(data: np.ndarray) -> np.ndarray:
    """Cells of the trigrams of lower-cased bytes."""
    low = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    low = low.astype(np.uint32)
    if len(low) < 3:
        return np.zeros(0, np.int64)
    x = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:]
    return ((x * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int64)


def visible(html: str) -> bytes:
    return b" ".join(markup.unescape(HIDDEN.sub(" ", html)).encode("utf-8", "ignore").split())


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """lang, cell, n."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        data, at = flat(batch.column("text"))
        langs = batch.column("lang").to_pylist()
        for lang in set(langs):
            rows = [i for i, x in enumerate(langs) if x == lang]
            sums = total.setdefault(lang, np.zeros(CELLS, np.int64))
            lens = np.diff(at)[rows]
            for lo, hi in row_slices(np.concatenate([[0], np.cumsum(lens)]), 1 << 20):
                cells = [trigrams(data[at[i]:at[i + 1]]) for i in rows[lo:hi]]
                sums += np.bincount(np.concatenate(cells), minlength=CELLS)
    for lang, sums in total.items():
        on = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(on), pa.string()), pa.array(on), pa.array(sums[on])],
                                         ["lang", "cell", "n"])


def text_model(docs: DataFrame, most_languages: int) -> tuple[list[str], np.ndarray]:
    """Languages, sorted, and log P(cell | language)."""
    counts = (docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
              .mapInArrow(_counts, "lang string, cell long, n long")
              .groupBy("lang", "cell").agg(F.sum("n").alias("n")))
    counts = staged(counts, "trigrams")
    langs = [r[0] for r in counts.select("lang").distinct().limit(most_languages + 1).collect()]
    if len(langs) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    langs.sort()
    table = np.full((len(langs), CELLS), 0.5)
    for lang, cell, n in counts.collect():  # CELLS rows for each language at most
        table[langs.index(lang), cell] += n
    return langs, np.log(table / table.sum(axis=1, keepdims=True))


def _likelihoods(log_p: np.ndarray, tempered: float):
    small = log_p.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for page in batch.column("html").to_pylist():
                cells = trigrams(np.frombuffer(visible(page or ""), np.uint8))
                if not len(cells):
                    out.append(np.zeros(len(small)).tolist())
                    continue
                n = np.bincount(cells, minlength=CELLS)
                on = np.flatnonzero(n)
                total = small[:, on].astype(float) @ n[on]
                out.append((total * min(1.0, tempered / len(cells))).tolist())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("page_id", "declared", "host", "domain", "suffix")],
                 pa.array(out, pa.list_(pa.float64()))],
                ["page_id", "declared", "host", "domain", "suffix", "text"])
    return run


def softmax(logs: list[Column]) -> list[Column]:
    top = F.greatest(*logs) if len(logs) > 1 else logs[0]
    parts = [F.exp(x - top) for x in logs]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return [p / total for p in parts]


def address(url: Column) -> dict[str, Column]:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return {"host": host, "domain": F.substring_index(host, ".", -2), "suffix": F.substring_index(host, ".", -1)}


def identify(pages: DataFrame, docs: DataFrame, weight: float = 10.0, tempered: float = 40.0,
             most_languages: int = 200) -> DataFrame:
    """One row per row of ``pages``: page_id, lang, probability, text_lang
    (by the text alone), declared, host."""
    langs, log_p = text_model(docs, most_languages)
    declared = F.lower(F.regexp_extract(
        F.coalesce("html", F.lit("")), r"(?i)<html\b[^>]{0,400}?\blang\s{0,3}=\s{0,3}[\"']?([A-Za-z]{2,3})", 1))
    kind = dict(pages.dtypes)["page_id"]
    base = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html"),
                        declared.alias("declared"), *[c.alias(n) for n, c in address(F.col("url")).items()])
    if not langs:
        none = F.lit(None)
        return base.select("page_id", none.cast("string").alias("lang"), none.cast("double").alias("probability"),
                           none.cast("string").alias("text_lang"), "declared", "host")
    known = F.when(F.col("declared").isin(langs), F.col("declared")).otherwise(F.lit(""))
    rows = staged(base.withColumn("declared", known).mapInArrow(
        _likelihoods(log_p, tempered), f"page_id {kind}, declared string, host string, domain string, "
        "suffix string, text array<double>"), "likelihoods")
    k = len(langs)
    ps = [f"p{i}" for i in range(k)]
    soft = rows.select("*", *[p.alias(n) for p, n in zip(softmax([F.col("text")[i] for i in range(k)]), ps)])
    sums = lambda level: [F.sum(p).alias(f"{level}{p}") for p in ps]
    total = soft.agg(*sums("all")).first()
    seen = {r["declared"]: [r[f"d{p}"] for p in ps] for r in soft.groupBy("declared").agg(*sums("d")).collect()}
    totals = [max(total[f"all{p}"] or 0.0, 1e-9) for p in ps]
    joined = soft
    for level in ("suffix", "domain", "host"):
        joined = joined.join(soft.groupBy(level).agg(*sums(level), F.count(F.lit(1)).alias(f"{level}_n")), level)
    # P(declared | language), a pseudo-count of 1 for each value
    values = [*langs, ""]
    given = F.create_map(*[x for d in values for x in (F.lit(d), F.array(*[
        F.lit(float(np.log((seen.get(d, [0.0] * k)[i] + 1) / (totals[i] + len(values))))) for i in range(k)]))])
    logs = []
    for i, p in enumerate(ps):
        prior = (F.lit(totals[i]) - F.col(p) + 1) / (sum(totals) - 1 + k)
        for level in ("suffix", "domain", "host"):
            mine = F.greatest(F.col(f"{level}{p}") - F.col(p), F.lit(0.0))
            # a page's soft counts sum to 1
            prior = (mine + weight * prior) / (F.col(f"{level}_n") - 1 + weight)
        logs.append(F.log(F.greatest(prior, F.lit(1e-12))) + given[F.col("declared")][i] + F.col("text")[i])
    scored = joined.select("page_id", "declared", "host", F.array(*[F.col(p) for p in ps]).alias("alone"),
                           F.array(*logs).alias("logs"))
    scored = scored.withColumn("post", F.array(*softmax([F.col("logs")[i] for i in range(k)])))
    name = lambda c: F.element_at(F.array(*[F.lit(x) for x in langs]),
                                  F.array_position(c, F.array_max(c)).cast("int"))
    return scored.select("page_id", name(F.col("post")).alias("lang"), F.array_max("post").alias("probability"),
                         name(F.col("alone")).alias("text_lang"), "declared", "host")
