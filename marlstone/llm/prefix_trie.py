"""The trie of conversation prefixes, by van Emde Boas recursion.

A conversation is a sequence of turns; a node of the trie is a distinct prefix. Equal
conversations are first joined into one sequence with a weight. A problem is a
tree of height 2^k: a root (a node) and the distinct sequences below it. It is cut at
half height: a sequence that reaches the cut is in the upper tree only by the cut prefix it
starts with, one for all that share it, and goes on in the lower tree below that
prefix. Upper trees and lower forests are problems of half the height, all of them cut in the same
pass, so a trie of depth D takes log D passes and no pass has more rows than
the trie has nodes and leaves.

* Names. A block of 2^k turns that starts at a multiple of 2^k is named by the names of its
  halves; a cut prefix by its root's name and the block between. Names are MD5
  (128 bits), so one prefix has one name wherever it is met.
* Totals. Upwards, a problem's total is its upper tree's plus the totals of
  the lower trees grafted on it: one grouping a level. Then downwards: the root of
  a lower tree gets its own tree's total and the totals of the nodes at its lower edge, which
  the level above has already.

All groupings combine before the shuffle. Hot names (a first turn that a third of the
conversations share) meet only there and in joins with a table of one row a name.
Turns get their numbers by a sort by range, so a conversation with a third of all
turns is dealt over many tasks.

Defined cases: rows with NULL conv_id belong to no conversation and are left out; NULL turns
come first, turns that are equal come in the order of the MD5 of their role and text;
NULL role or text is empty; a conversation without turns is a member of the root alone; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marlstone.llm.common import staged

ROOT = bytes(16)
WORD = r"[^\x20\x09-\x0D]+"
#: Ids of one piece of a list of ids: those with the same conv_id div this.
PIECE = 1 << 13


def _name(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv, at, name, words: the turns of each conversation, numbered from 0."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = (conversations.where(F.col("conv_id").isNotNull())
             .select(F.col("conv_id").cast("long").alias("conv"), "turn",
                     _name(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("name"),
                     F.regexp_count(text, F.lit(WORD)).cast("long").alias("words")))
    order = ["conv", "turn", "name"]
    # place = partition * 2^33 + row of the sorted partition; fixed once written
    placed = staged(turns.repartitionByRange(*order).sortWithinPartitions(*order)
                    .withColumn("place", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    parts = placed.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part")) - F.col("n")
    starts = parts.select("conv", "part", (before - F.col("first")).alias("shift"))
    return (placed.join(starts, ["conv", "part"])
            .select("conv", (F.col("place") + F.col("shift")).alias("at"), "name", "words"))


def rebuilt_turns(turns: DataFrame, family: int = 20, shared: int = 4) -> DataFrame:
    """conv, at, name, words of the conversations rebuilt so that many share a beginning: the
    first h turns of conversation c - c % family (all if it has fewer, none if it is absent), then c's own
    after its first h; h = crc32 of c as decimal text, modulo ``shared``."""
    base = turns.where((F.col("conv") % family == 0) & (F.col("at") < shared - 1)).groupBy(
        F.col("conv").alias("base")).agg(F.sort_array(F.collect_list(F.struct("at", "name", "words"))).alias("first"))
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % shared).cast("int")
    heads = (turns.select("conv").distinct()
             .select("conv", (F.col("conv") - F.col("conv") % family).alias("base"), h.alias("h"))
             .join(base, "base", "left")
             .select("conv", "h", F.slice(F.coalesce("first", F.array().cast("array<struct<at:bigint,name:binary,words:bigint>>")),
                                          F.lit(1), F.col("h")).alias("head")))
    tails = (turns.join(heads.select("conv", "h", F.size("head").alias("m")), "conv")
             .where("at >= h").select("conv", (F.col("at") - F.col("h") + F.col("m")).alias("at"), "name", "words"))
    return heads.select("conv", F.inline("head")).unionByName(tails)


def _blocks(turns: DataFrame, levels: int) -> list[DataFrame]:
    """For each level k: conv, block, name of the whole blocks of 2^k turns."""
    out = [turns.select("conv", F.col("at").alias("block"), "name")]
    for k in range(1, levels):
        half = out[-1].select("conv", F.shiftright("block", 1).alias("block"),
                              (F.col("block") % 2).alias("side"), "name")
        whole = half.groupBy("conv", "block").agg(
            F.max(F.when(F.col("side") == 0, F.col("name"))).alias("left"),
            F.max(F.when(F.col("side") == 1, F.col("name"))).alias("right"))
        out.append(staged(whole.where("left IS NOT NULL AND right IS NOT NULL")
                          .select("conv", "block", _name(F.col("left"), F.col("right")).alias("name")), f"blocks{k}"))
    return out


def _classes(convs: DataFrame, turns: DataFrame, blocks: list[DataFrame]) -> DataFrame:
    """whole, conv, size, n, ends: one row for each distinct sequence: its name (that of the node where
    it ends), the smallest of its n conversations, its number of turns and the SHA-256 of their ids."""
    sizes = convs.join(turns.groupBy("conv").agg(F.count(F.lit(1)).alias("size")), "conv", "left") \
        .select("conv", F.coalesce("size", F.lit(0)).alias("size"))
    cover = None
    for k, level in enumerate(blocks):  # of the blocks that make up a sequence, one a level at most
        own = (level.join(sizes, "conv")
               .where((F.shiftright("size", k) % 2 == 1) & (F.col("block") == F.shiftright("size", k) - 1))
               .select("conv", F.lit(k).alias("k"), "name"))
        cover = own if cover is None else cover.unionByName(own)
    # the largest block first, as the cuts name prefixes: a sequence has its last node's name
    named = cover.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("k", "name")), asc=False).alias("parts"))
    whole = F.aggregate("parts", F.lit(ROOT), lambda a, x: _name(a, x["name"]))
    members = staged(sizes.join(named, "conv", "left")
                     .select("conv", "size", F.coalesce(whole, F.lit(ROOT)).alias("whole")), "members")
    counts = members.groupBy("whole").agg(F.min("conv").alias("conv"), F.max("size").alias("size"),
                                          F.count(F.lit(1)).alias("n"))
    pieces = (members.groupBy("whole", F.floor(F.col("conv") / F.lit(PIECE)).alias("piece"))
              .agg(F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids")))
    ends = (pieces.repartition("whole").sortWithinPartitions("whole", "piece")
            .mapInArrow(_digests, "whole binary, ends string"))
    return staged(counts.join(ends, "whole"), "classes")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """whole, ends: SHA-256 of the comma-joined pieces of each name; rows come sorted, one
    state is held."""
    name, state = None, hashlib.sha256()
    for batch in batches:
        names, sums = [], []
        for whole, ids in zip(batch.column("whole").to_pylist(), batch.column("ids").to_pylist()):
            if whole == name:
                state.update(b",")
            else:
                if name is not None:
                    names.append(name)
                    sums.append(state.hexdigest())
                name, state = whole, hashlib.sha256()
            state.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(sums, pa.string())],
                                         ["whole", "ends"])
    if name is not None:
        yield pa.RecordBatch.from_arrays([pa.array([name], pa.binary()), pa.array([state.hexdigest()])],
                                         ["whole", "ends"])


def _cut(classes: DataFrame, blocks: list[DataFrame]) -> tuple[list[DataFrame], DataFrame, list[DataFrame]]:
    """The recursion. Returns, for each level k: the cut nodes (name, depth, up, conv, n; up is the
    root of the problem that the cut is in), all at odd multiples of 2^k; name, parent of every node; and
    the pairs (top, name) of a cut node and a node 2^k below it, where a problem's lower edge is."""
    root = F.lit(ROOT)
    rows = classes.where("size > 0").select(
        F.lit(0).cast("long").alias("s"), root.alias("top"), "conv", "n", F.col("size").alias("stop"),
        F.lit(None).cast("binary").alias("name"))
    cuts: list[DataFrame] = [None] * len(blocks)
    edges: list[DataFrame] = [None] * len(blocks)
    for k in reversed(range(len(blocks))):
        half = 1 << k
        inner = blocks[k].where("block % 2 = 0").select(
            "conv", F.shiftleft("block", k).alias("s"), F.col("name").alias("content"))
        reach = F.col("stop") >= F.col("s") + half
        met = rows.join(inner, ["conv", "s"], "left").withColumn(
            "cut", F.when(reach, _name(F.col("top"), F.col("content"))))
        met = staged(met.drop("content"), f"met{k}")
        short = met.where("cut IS NULL").drop("cut")
        cuts[k] = staged(met.where("cut IS NOT NULL").groupBy("s", "top", "cut")
                         .agg(F.min("conv").alias("conv"), F.sum("n").alias("n"))
                         .select(F.col("cut").alias("name"), (F.col("s") + half).alias("depth"),
                                 F.col("top").alias("up"), "conv", "n"), f"cuts{k}")
        upper = cuts[k].select((F.col("depth") - half).alias("s"), F.col("up").alias("top"), "conv", "n",
                               F.col("depth").alias("stop"), "name")
        lower = (met.where(F.col("cut").isNotNull() & (F.col("stop") > F.col("s") + half))
                 .select((F.col("s") + half).alias("s"), F.col("cut").alias("top"), "conv", "n", "stop", "name"))
        edges[k] = lower.where("name IS NOT NULL").select("top", "name")
        rows = short.unionByName(upper).unionByName(lower)
    return cuts, rows.select("name", F.col("top").alias("parent")), edges


def _totals(nodes: DataFrame, cuts: list[DataFrame], edges: list[DataFrame]) -> DataFrame:
    """name, leaves, saved: sums over the subtree of every node of ``nodes``
    (name, depth, up, leaves, saved)."""
    sums = ["leaves", "saved"]
    own: list[DataFrame] = []
    at = nodes.select("name", "depth", "up", *sums)
    for k in range(len(cuts)):
        cut = F.col("depth") % (2 << k) != 0
        own.append(at.where(cut).select("name", *sums))
        grafted = at.where(cut).select(F.col("up").alias("name"), F.lit(None).cast("long").alias("depth"),
                                       F.lit(None).cast("binary").alias("up"), *sums)
        at = staged(at.where(~cut).unionByName(grafted).groupBy("name").agg(
            F.max("depth").alias("depth"), F.max("up").alias("up"), *[F.sum(c).alias(c) for c in sums]), f"tree{k}")
    whole = at.select("name", *sums)  # the root
    for k in reversed(range(len(cuts))):
        below = edges[k].join(whole, "name").select(F.col("top").alias("name"), *sums)
        level = own[k].unionByName(below).groupBy("name").agg(*[F.sum(c).alias(c) for c in sums])
        whole = whole.unionByName(staged(level, f"whole{k}"))
    return whole


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a node of the trie of the sequences ``turns`` (conv, at, name, words: turns
    numbered from 0) of the conversations ``convs`` (conv, each once): conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns = staged(turns, "turns")
    deepest = turns.agg(F.max("at")).first()[0]
    levels = 1 if deepest is None else (deepest + 1).bit_length()
    blocks = _blocks(turns, levels)
    classes = _classes(convs, turns, blocks)
    cuts, parents, edges = _cut(classes, blocks)
    nodes = cuts[0]
    for more in cuts[1:]:
        nodes = nodes.unionByName(more)
    nodes = (nodes.join(parents, "name")
             .join(turns.select("conv", (F.col("at") + 1).alias("depth"), "words"), ["conv", "depth"]))
    top = (classes.groupBy().agg(F.min("conv").alias("conv"), F.sum("n").alias("n")).where("n IS NOT NULL")
           .select("conv", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("name"),
                   F.lit(None).cast("binary").alias("up"), "n", F.lit(None).cast("binary").alias("parent"),
                   F.lit(0).cast("long").alias("words")))
    nodes = staged(nodes.unionByName(top), "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("name")).agg(
        F.count(F.lit(1)).alias("n_children"))
    counted = staged(nodes.join(children, "name", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))), "counted")
    totals = _totals(counted.select(
        "name", "depth", "up", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n") - 1) * F.col("words")).alias("saved")), cuts, edges)
    above = counted.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv_id"))
    ends = classes.select(F.col("whole").alias("name"), "ends")
    return (counted.join(totals, "name").join(above, "parent", "left").join(ends, "name", "left")
            .select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
                    "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
                    F.coalesce("ends", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
