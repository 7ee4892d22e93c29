"""Trie of conversation prefixes: how many conversations share a start, and what sharing it saves.

A node is a distinct sequence of first turns. It is named by its depth and two 64-bit lanes, each the
exclusive or of hashes of (position, turn) over the sequence: lanes are cumulated in bands of HEIGHT
turns, so that no conversation is one group, and a parent's lanes are the node's without its last turn.

Totals of subtrees are rolled up by depth bands. A band's paths are rows of at most HEIGHT nodes, and a
node adds to its ancestors on such a path alone, which gives each node's total inside its band. The
nodes at the tops of bands form a smaller trie, which is rolled up the same way; each completed top
then adds its total to the HEIGHT nodes above it. So a depth of d takes log d (base HEIGHT) levels.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.llm import text as T

HEIGHT = 32  # turns of a band
CHUNK = 1024  # turn numbers that are put in order together
GROUP = 20  # conversations that take their first turns from one of them
IDS = 4096  # ids that are joined to one text at a time
NODE = ("depth", "k1", "k2")
SUMS = ("leaves", "saved")
WORDS = r"[^\x20\x09-\x0D]+"
EMPTY = hashlib.sha256().hexdigest()


def _numbered(conversations: DataFrame) -> DataFrame:
    """conv, pos (from 1), digest, words: every turn with its place in its conversation.

    Turns are ranked within CHUNK turn numbers; counts of the chunks before are added.
    """
    chunk = F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(-(1 << 63)))
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = (conversations.where(F.col("conv_id").isNotNull())
             .select(F.col("conv_id").cast("long").alias("conv"),
                     F.col("turn").cast("long").alias("turn"), role.alias("role"),
                     text.alias("text"))
             .withColumn("chunk", chunk))
    sizes = turns.groupBy("conv", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select("conv", "chunk",
                           F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    own = Window.partitionBy("conv", "chunk").orderBy(F.asc_nulls_first("turn"), "role", "digest")
    hashed = turns.select(
        "conv", "chunk", "turn", "role",
        F.md5(F.concat(F.octet_length("role"), F.lit(":"), "role", "text")).alias("digest"),
        F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"))
    return (hashed.withColumn("at", F.row_number().over(own)).join(offsets, ["conv", "chunk"])
            .select("conv", (F.col("offset") + F.col("at")).alias("pos"), "digest", "words"))


def _rebuilt(turns: DataFrame) -> DataFrame:
    """conv, pos, digest, words: the first turns taken from the group's first conversation."""
    sizes = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    convs = sizes.select("conv", (F.col("conv") - F.col("conv") % GROUP).alias("base"),
                         (F.crc32(F.col("conv").cast("string").cast("binary")) % 4).alias("h"))
    bases = sizes.select(F.col("conv").alias("base"), F.col("n").alias("base_n"))
    convs = convs.join(bases, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    heads = turns.where("pos <= 3").withColumnRenamed("conv", "base")
    taken = (convs.join(heads, "base").where("pos <= taken")
             .select("conv", "pos", "digest", "words"))
    # A conversation's row meets its turns in blocks of CHUNK of them.
    blocked = turns.withColumn("block", F.floor(F.col("pos") / CHUNK))
    blocks = (blocked.select("conv", "block").distinct()
              .join(convs.select("conv", "h", "taken"), "conv"))
    own = (blocked.join(blocks, ["conv", "block"]).where("pos > h")
           .select("conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "digest",
                   "words"))
    roots = sizes.select("conv", F.lit(0).cast("long").alias("pos"),
                         F.lit(None).cast("string").alias("digest"),
                         F.lit(0).cast("long").alias("words"))
    return roots.unionByName(taken).unionByName(own)


def _paths(rebuilt: DataFrame, height: int) -> DataFrame:
    """conv, band, last, path: the nodes of a conversation's band, at most ``height`` of them.

    ``last`` marks the band that a conversation ends in.
    """
    # The root, which has no turn, adds nothing to the lanes.
    def lane(*order: str):
        return F.when(F.col("pos") > 0, F.xxhash64(*order)).otherwise(F.lit(0))

    turns = rebuilt.select("conv", "pos", F.floor(F.col("pos") / height).alias("band"), "words",
                           lane("pos", "digest").alias("e1"), lane("digest", "pos").alias("e2"))
    totals = turns.groupBy("conv", "band").agg(F.bit_xor("e1").alias("x1"),
                                               F.bit_xor("e2").alias("x2"))
    bands = Window.partitionBy("conv").orderBy("band")
    before = bands.rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "conv", "band", F.lead("band").over(bands).isNull().alias("last"),
        *[F.coalesce(F.bit_xor(x).over(before), F.lit(0)).alias(c)
          for x, c in (("x1", "c1"), ("x2", "c2"))])
    upto = Window.partitionBy("conv", "band").orderBy("pos").rowsBetween(
        Window.unboundedPreceding, 0)
    nodes = (turns.withColumns({"y1": F.bit_xor("e1").over(upto), "y2": F.bit_xor("e2").over(upto)})
             .join(carried, ["conv", "band"])
             .withColumns({"k1": F.col("c1").bitwiseXOR(F.col("y1")),
                           "k2": F.col("c2").bitwiseXOR(F.col("y2"))}))
    node = F.struct(F.col("pos").alias("depth"), "k1", "k2", "words",
                    F.col("k1").bitwiseXOR(F.col("e1")).alias("p1"),
                    F.col("k2").bitwiseXOR(F.col("e2")).alias("p2"))
    return nodes.groupBy("conv", "band").agg(
        F.max("last").alias("last"), F.sort_array(F.collect_list(node)).alias("path"))


def _nodes(paths: DataFrame) -> DataFrame:
    """depth, k1, k2, conv_id, n_convs, words, p1, p2: each node with its smallest member."""
    return (paths.select("conv", F.inline("path")).groupBy(*NODE)
            .agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"),
                 F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2")))


def _rolled(paths: DataFrame, values: DataFrame, height: int) -> DataFrame:
    """depth, k1, k2, leaves, saved: the values summed over each node's subtree.

    ``values`` has each node's own and its smallest member ``conv_id``; ``paths`` (conv, band, path)
    has that conversation's nodes by bands. Depths count the nodes of this trie.
    """
    band = F.floor(F.col("depth") / height).alias("band")
    # The nodes of a band with one smallest member lie on its path.
    own = (values.groupBy(F.col("conv_id").alias("conv"), band)
           .agg(F.collect_list(F.struct("depth", *SUMS)).alias("own")))

    def below(name: str, node):
        return F.aggregate("own", F.lit(0).cast("long"), lambda total, v: total + F.when(
            v["depth"] >= node["depth"], v[name]).otherwise(0)).alias(name)

    inside = (paths.join(own, ["conv", "band"])
              .select(F.inline(F.transform("path", lambda node: F.struct(
                  *[node[c].alias(c) for c in NODE], *[below(c, node) for c in SUMS]))))
              .groupBy(*NODE).agg(*[F.sum(c).alias(c) for c in SUMS]))
    deepest = values.agg(F.max("depth")).first()[0]
    if deepest is None or deepest < height:
        return inside
    inside = T.written(inside, "trie-bands")
    tops = (inside.where(F.col("depth") % height == 0)
            .join(values.select(*NODE, "conv_id"), list(NODE))
            .withColumn("depth", F.floor(F.col("depth") / height)))
    above = (paths.select("conv", F.floor(F.col("band") / height).alias("over"), F.struct(
        F.col("band").alias("depth"), F.col("path")[0]["k1"].alias("k1"),
        F.col("path")[0]["k2"].alias("k2")).alias("top"))
        .groupBy("conv", F.col("over").alias("band"))
        .agg(F.sort_array(F.collect_list("top")).alias("path")))
    tops = T.written(tops, "trie-tops")
    done = _rolled(T.written(above, "trie-paths"), tops, height)
    handed = (done.where("depth > 0").join(tops.select(*NODE, "conv_id"), list(NODE))
              .select(F.col("conv_id").alias("conv"), (F.col("depth") - 1).alias("band"), *SUMS)
              .join(paths, ["conv", "band"])
              .select(F.explode("path").alias("node"), *SUMS)
              .select(*[f"node.{c}" for c in NODE], *SUMS))
    return (inside.unionByName(handed).groupBy(*NODE)
            .agg(*[F.sum(c).alias(c) for c in SUMS]))


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, k1, k2, conv) to (depth, k1, k2, first, ids): runs of up to IDS ids."""
    names = [*NODE, "first", "ids"]
    node, ids = None, []

    def run() -> pa.RecordBatch:
        return pa.record_batch([*(pa.array([c], pa.int64()) for c in (*node, ids[0])),
                                pa.array([",".join(map(str, ids))])], names=names)

    for batch in batches:
        for *own, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if ids and (own != node or len(ids) == IDS):
                yield run()
                ids = []
            node = own
            ids.append(conv)
    if ids:
        yield run()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (depth, k1, k2, first, ids) to one hash for each node; nothing is held but its state."""
    def done(found: list) -> pa.RecordBatch:
        columns = list(zip(*found, strict=True)) or [()] * 4
        return pa.record_batch([*(pa.array(c, pa.int64()) for c in columns[:3]),
                                pa.array(columns[3], pa.string())],
                               names=[*NODE, "ends_sha256"])

    node, state = None, None
    for batch in batches:
        found = []
        for *own, _, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own == node:
                state.update(b",")
            else:
                if node:
                    found.append((*node, state.hexdigest()))
                node, state = own, hashlib.sha256()
            state.update(ids.encode())
        yield done(found)
    if node:
        yield done([(*node, state.hexdigest())])


def _ends(paths: DataFrame) -> DataFrame:
    """depth, k1, k2, ends_sha256 of the nodes that conversations end in.

    Ids are sorted over ranges, so that a node where very many end is spread over tasks; what then
    meets in one task is one row for IDS of them, and a hash that takes them in order.
    """
    last = F.element_at("path", -1)
    ends = paths.where("last").select(*[last[c].alias(c) for c in NODE], "conv")
    runs = (ends.repartitionByRange(*NODE, "conv").sortWithinPartitions(*NODE, "conv")
            .mapInArrow(_joined, "depth long, k1 long, k2 long, first long, ids string"))
    return (runs.repartition(*NODE).sortWithinPartitions(*NODE, "first")
            .mapInArrow(_hashed, "depth long, k1 long, k2 long, ends_sha256 string"))


def trie(conversations: DataFrame, height: int = HEIGHT) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    One row for each node; a node is known by its depth and ``conv_id``, its smallest member. The
    turns of a conversation are ordered by ``turn``, null first, then by role, then by the MD5 of role
    and text; repeated rows are turns of their own. Null roles and texts are empty. Rows without a
    conversation id are left out; other columns are ignored. A conversation takes its first turns
    from its group's first one, as many as crc32 says, where that has them; one that is left without
    turns is a member of the root. Texts of any length and conversations of any number of turns
    count whole. Without conversations there is no node, the root neither. Equal 128-bit lanes are
    taken for equal sequences.
    """
    turns = T.written(_numbered(conversations), "trie-turns")
    paths = T.written(_paths(_rebuilt(turns), height), "trie-conversations")
    found = T.written(_nodes(paths), "trie-found")
    children = (found.where("depth > 0")
                .groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"),
                         F.col("p2").alias("k2")).agg(F.count("*").alias("n_children")))
    nodes = T.written(found.join(children, list(NODE), "left").fillna(0, ["n_children"])
                      .withColumns({
                          "leaves": (F.col("n_children") == 0).cast("long"),
                          "saved": (F.col("n_convs") - 1) * F.col("words")}), "trie-nodes")
    sums = _rolled(paths.select("conv", "band", "path"), nodes.select(*NODE, "conv_id", *SUMS),
                   height)
    whole = (nodes.drop(*SUMS).join(sums, list(NODE)).join(_ends(paths), list(NODE), "left"))
    # All first turns have the root for a parent; deeper nodes look theirs up.
    root = nodes.where("depth = 0").select("conv_id").scalar()
    parents = nodes.where("depth > 0 AND n_children > 0").select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"),
        F.col("conv_id").alias("parent_conv_id"))
    deep = whole.where("depth > 1").join(parents, ["depth", "p1", "p2"])
    top = whole.where("depth <= 1").withColumn("parent_conv_id",
                                               F.when(F.col("depth") == 1, root))
    return top.unionByName(deep).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
