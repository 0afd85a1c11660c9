"""Benchmark decontamination by winnowing. DataFrame functions only.

A text's words are cut into overlapping segments, so that no array grows with
the text. Of every ``WINDOW`` consecutive ``K``-word hashes the smallest is
kept, the first of equals. A span of ``SPAN`` = K + WINDOW - 1 words that a
document shares with a benchmark item holds a whole window on both sides, so
both keep the same hash at the same place of the span: joining the kept hashes
finds every such span. Each hit names a diagonal, document position minus item
position; on it the words themselves are compared along the whole item, and
the windows of equal words are the occurrences.

Items of fewer words than SPAN are one window of all their words and found by
the hash of that many words at every document position; these passes run only
for the lengths that occur.

Defined cases: a NULL or empty text has no words and is not hit; items without
words are left out; an item_id given twice stands for
all its texts; rows of ``docs`` given twice get a result each, the same where
doc_id and text are; a NULL doc_id is a value like any other; items with a NULL item_id
count as one item, which has no place in the list of ids; other columns
are ignored; without benchmark rows nothing is hit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import LOWER, NON_WORD, UPPER, staged, without

SPAN, K = 13, 6
WINDOW = SPAN - K + 1
SEGMENT = 2048
#: Bits of a position within a segment.
BITS = 13


def words_of(text: str) -> Column:
    low = F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER)
    return F.array_remove(F.split(low, NON_WORD), "")


def _hashes(segments: DataFrame, keys: list[str], k: int) -> DataFrame:
    """grams: for each position the hash of ``k`` words, its low bits replaced
    by the position."""
    hashed = segments.select(*keys, "base", F.transform("part", lambda w: F.xxhash64(w)).alias("h1"))

    def gram(i: Column) -> Column:
        h = F.xxhash64(F.slice("h1", i + 1, F.lit(k)))
        return F.shiftleft(F.shiftrightunsigned(h, BITS), BITS).bitwiseOR(i.cast("long"))
    return hashed.select(*keys, "base", F.transform(
        F.sequence(F.lit(0), F.size("h1") - k), gram).alias("grams"))


def _segments(texts: DataFrame, keys: list[str], span: int) -> DataFrame:
    """Segments of the words, each but the last followed by span - 1 more."""
    n = F.size("words")
    return (texts.where(n >= span)
            .select(*keys, "words", F.explode(F.sequence(F.lit(0), n - span, F.lit(SEGMENT))).alias("base"))
            .select(*keys, "base", F.slice("words", F.col("base") + 1, F.lit(SEGMENT + span - 1)).alias("part")))


def _placed(kept: DataFrame, keys: list[str]) -> DataFrame:
    return kept.select(*keys, F.shiftright("m", BITS).alias("h"),
                       (F.col("base") + F.col("m").bitwiseAND((1 << BITS) - 1)).alias("pos"))


def fingerprints(texts: DataFrame, keys: list[str]) -> DataFrame:
    """Winnowed hashes h of the words and their positions pos."""
    grams = _hashes(_segments(texts, keys, SPAN), keys, K)
    least = F.transform(F.sequence(F.lit(1), F.size("grams") - (WINDOW - 1)),
                        lambda i: F.array_min(F.slice("grams", i, F.lit(WINDOW))))
    return _placed(grams.select(*keys, "base", F.explode(F.array_distinct(least)).alias("m")), keys)


def every_hash(texts: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The hash of ``k`` words at each position."""
    grams = _hashes(_segments(texts, keys, k), keys, k)
    return _placed(grams.select(*keys, "base", F.explode("grams").alias("m")), keys)


def occurrences(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, text_key, item_id, start, span: the windows of items in documents."""
    doc = ["doc_id", "text_key"]
    texts = docs.select(*doc, words_of("text").alias("words"))
    items = (benchmark.select("item_id", words_of("text").alias("words"))
             .where(F.size("words") > 0).distinct()
             .withColumn("item_key", F.xxhash64("words", F.col("item_id").isNull(), F.col("item_id").cast("string"))))
    items = staged(items, "items")
    item = ["item_key"]
    place = F.col("pos") - F.col("item_pos")
    seeds = (fingerprints(texts, doc)
             .join(fingerprints(items, item).withColumnRenamed("pos", "item_pos"), "h")
             .select(*doc, *item, place.alias("diagonal")))
    sizes = items.where(F.size("words") < SPAN).select(F.size("words").alias("n")).distinct().collect()
    for n in sorted(r["n"] for r in sizes):  # SPAN - 1 lengths at most
        short = (every_hash(items.where(F.size("words") == n), item, n)
                 .withColumnRenamed("pos", "item_pos"))
        seeds = seeds.unionByName(every_hash(texts, doc, n).join(short, "h")
                                  .select(*doc, *item, place.alias("diagonal")))
    # what one document shares with the benchmark, to read its words once
    found = (seeds.distinct().groupBy(doc)
             .agg(F.collect_list(F.struct(*item, "diagonal")).alias("seeds"))
             .withColumnsRenamed({"doc_id": "d", "text_key": "k"}))
    along = (docs.select(*doc, "text")
             .join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
             .select(*doc, words_of("text").alias("words"), "seeds")
             .select(*doc, "words", F.explode("seeds").alias("seed"))
             .select(*doc, "seed.*", "words"))
    first = F.greatest(F.col("diagonal"), F.lit(0))
    sized = items.select(*item, "item_id", F.col("words").alias("item_words"))
    lengths = items.select(*item, F.size("words").alias("n"))
    pieces = (along.join(lengths, item)
              .select(*doc, *item, first.alias("first"), "n",
                      (first - F.col("diagonal")).alias("skipped"),
                      F.slice("words", first + 1, F.col("n")).alias("piece")))
    equal = F.zip_with("piece", F.slice("item_words", F.col("skipped") + 1, F.col("n")),
                       lambda a, b: F.coalesce(a == b, F.lit(False)))
    span = F.least(F.lit(SPAN), F.col("n"))
    compared = (pieces.join(sized, item)
                .select(*doc, "item_id", "first", span.alias("span"), equal.alias("equal"))
                .where(F.size("equal") >= F.col("span")))
    starts = F.filter(F.sequence(F.lit(0), F.size("equal") - F.col("span")),
                      lambda i: F.forall(F.slice("equal", i + 1, F.col("span")), lambda x: x))
    return (compared.select(*doc, "item_id", "first", "span", F.explode(starts).alias("i"))
            .select(*doc, "item_id", (F.col("first") + F.col("i")).alias("start"), "span").distinct())


def decontaminate(docs: DataFrame, benchmark: DataFrame, share: int = 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, text_key, n_words, n_hit, n_items,
    items_sha256, contaminated. A document is contaminated if it is hit and
    ``share`` times its hit words are at least all its words."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("text_key", F.xxhash64("text"))
    hits = staged(occurrences(docs, benchmark), "occurrences")
    key = ["doc_id", "text_key"]
    # the union of a document's windows, in the order of their starts
    ordered = Window.partitionBy(key).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("span")
    spans = hits.groupBy(*key, "start").agg(F.max("span").alias("span"))
    covered = (spans.select(*key, "start", "span", F.max(end).over(ordered).alias("before"))
               .groupBy(key).agg(F.sum(F.greatest(
                   F.lit(0), end - F.greatest(F.col("start"), F.coalesce("before", F.lit(0)))))
                   .alias("n_hit")))
    items = (hits.groupBy(key).agg(F.collect_set(F.col("item_id").cast("string")).alias("items"),
                                   F.max(F.col("item_id").isNull().cast("int")).alias("unnamed"))
             .withColumnsRenamed({"doc_id": "d", "text_key": "k"}))
    found = (covered.join(items, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
             .select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "n_hit", "items", "unnamed"))
    counted = docs.select(*key, F.size(words_of("text")).cast("long").alias("n_words"))
    n_hit = F.coalesce(F.col("n_hit"), F.lit(0)).cast("long")
    listed = F.coalesce(F.array_join(F.sort_array("items"), ","), F.lit(""))
    return (counted.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")),
                         "left")
            .select(*key, "n_words", n_hit.alias("n_hit"),
                    F.coalesce(F.array_size("items") + F.col("unnamed"), F.lit(0)).cast("long").alias("n_items"),
                    F.sha2(listed, 256).alias("items_sha256"),
                    ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, share: int = 20) -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = staged(decontaminate(docs, benchmark, share).where("contaminated").select("doc_id", "text_key"), "bad")
    nested = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id",
                         F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))
    return without(nested, bad).select("_row.*")
