"""The prefix trie of conversations, with totals over subtrees by centroid decomposition.

A node is a distinct sequence of first turns. It is named by the smallest conversation that starts with
it and its depth, so parents, children and ancestors are found by equal keys alone. No conversation is
ever gathered: turns are numbered and their prefixes hashed in segments of bounded size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from podium.llm.common import WORD, staged, unstage

# Conversations come in families: each takes its first turns from the family's first conversation.
FAMILY, MOST_SHARED = 20, 4
# Turns of one conversation whose prefixes one window computes.
SEGMENT = 1 << 16
# Weight up to which a component is decomposed inside a task, and nodes that a task takes at a time.
LOCAL_WEIGHT, TASK_NODES = 1 << 16, 100_000
# Ids (by value) whose texts are joined before the lists of ids are hashed.
ID_BITS = 8

TOTALS = "conv long, depth long, leaves long, saved long"


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from the first one of its family."""
    return F.crc32(conv.cast("string").cast("binary")) % MOST_SHARED


def numbered_turns(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, pos (from 0), digest, words of every turn, in the order of the conversation.

    Equal rows are counted first. The others are dealt out by ranges of (conversation, turn, digest), so
    a conversation of any length is numbered in pieces, each in its own task; a piece that goes on
    with a conversation is the first one of its range, so there are no more offsets than ranges.
    """
    role_text, own_text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in (role, text))
    content = F.concat(F.octet_length(role_text).cast("string"), F.lit(":"), role_text, own_text)
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.unhex(F.md5(content.cast("binary"))).alias("digest"),
        F.regexp_count(own_text, F.lit(WORD)).alias("words"),
    )
    order = ["conv", "turn", "digest"]
    copies = rows.groupBy(*order).agg(F.any_value("words").alias("words"), F.count(F.lit(1)).alias("n"))
    dealt = staged(copies.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "turn-ranges")
    up_to = Window.partitionBy("part", "conv").orderBy("turn", "digest").rowsBetween(Window.unboundedPreceding, 0)
    pieces = dealt.groupBy("conv", "part").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(pieces.select("part", "conv", F.sum("n").over(before).alias("offset")).where("offset is not null"), "offsets")
    ended = dealt.withColumn("end", F.sum("n").over(up_to)).join(F.broadcast(offsets), ["part", "conv"], "left")
    end = F.col("end") + F.coalesce("offset", F.lit(0))
    turns = staged(
        ended.select("conv", F.explode(F.sequence(end - F.col("n"), end - 1)).alias("pos"), "digest", "words"), "turns"
    )
    unstage(dealt)
    unstage(offsets)
    return turns


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv, depth (from 1), digest, words, size: the turns of every rebuilt conversation, and a row of
    depth 0 for each. `size` is the conversation's number of turns."""
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    convs = convs.select("conv", "own", (F.col("conv") - F.col("conv") % FAMILY).alias("first"), shared_turns(F.col("conv")).alias("h"))
    heads = (
        turns.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < MOST_SHARED - 1))
        .groupBy(F.col("conv").alias("first"))
        .agg(F.array_sort(F.collect_list(F.struct("pos", "digest", "words"))).alias("heads"))
    )
    convs = convs.join(heads, "first", "left")
    taken = F.slice(F.coalesce("heads", F.array().cast("array<struct<pos:bigint,digest:binary,words:int>>")), F.lit(1), F.col("h").cast("int"))
    convs = convs.withColumn("heads", taken).withColumn(
        "size", F.size("heads") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    )
    convs = staged(convs.select("conv", "h", "heads", "size"), "conversations")
    root = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.unhex(F.lit("")).alias("digest"), F.lit(0).alias("words"), "size")
    shared = convs.select("conv", F.explode("heads").alias("t"), "size").select(
        "conv", (F.col("t.pos") + 1).alias("depth"), "t.digest", "t.words", "size"
    )
    # A conversation of very many turns meets one row here, which adaptive execution can split.
    own = turns.join(convs.select("conv", "h", F.size("heads").alias("k"), "size"), "conv").where("pos >= h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("k") + 1).alias("depth"), "digest", "words", "size")
    return root.unionByName(shared).unionByName(own)


def prefixes(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """`rows` with p and q, 128 bits that stand for the first `depth` turns, instead of the digest.

    A prefix's bits are those of its turns with their places, combined by exclusive or, so that they
    can be put together from segments.
    """
    bits = [F.when(F.col("depth") > 0, F.xxhash64(F.lit(k), "depth", "digest")).otherwise(F.lit(0)).alias(name) for k, name in ((1, "p"), (2, "q"))]
    rows = rows.select("conv", "depth", "words", "size", F.floor(F.col("depth") / segment).alias("segment"), *bits)
    rows = staged(rows, "turn-bits")
    up_to = Window.partitionBy("conv", "segment").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    longer = rows.where(F.col("size") >= segment).groupBy("conv", "segment").agg(F.bit_xor("p").alias("p"), F.bit_xor("q").alias("q"))
    earlier = longer.select(
        "conv", "segment", F.bit_xor("p").over(before).alias("p0"), F.bit_xor("q").over(before).alias("q0")
    )
    own = rows.withColumns({"p": F.bit_xor("p").over(up_to), "q": F.bit_xor("q").over(up_to)})
    whole = own.join(earlier, ["conv", "segment"], "left")
    p, q = (F.col(a).bitwiseXOR(F.coalesce(b, F.lit(0))).alias(a) for a, b in (("p", "p0"), ("q", "q0")))
    found = staged(whole.select("conv", "depth", p, q, "words", "size"), "prefixes")
    unstage(rows)
    return found


def hashed_ids(ends: DataFrame) -> DataFrame:
    """conv, depth, ends_sha256 of each node in `ends` (rep, depth, conv: a conversation that ends there).

    SHA-256 reads its bytes in order, so the ids of one node pass through one task, as a stream in bounded
    memory; the texts of neighbouring ids are joined before that, wherever they are.
    """
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string")), ",")
    block = F.call_function("shiftright", F.col("conv"), F.lit(ID_BITS)).alias("block")
    texts = ends.groupBy("rep", "depth", block).agg(ids.alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv", "depth", "ends_sha256"]

        def batch(rows: list) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()))], names=names)

        at, state, rows = None, None, []
        for part in batches:
            for rep, depth, text in zip(*(part.column(k).to_pylist() for k in range(3))):
                if (rep, depth) != at:
                    if state:
                        rows.append((*at, state.hexdigest()))
                    at, state = (rep, depth), hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            yield batch(rows)
            rows = []
        if state:
            yield batch([(*at, state.hexdigest())])

    dealt = texts.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "block")
    return dealt.select("rep", "depth", "ids").mapInArrow(run, "conv long, depth long, ends_sha256 string")


# --- totals over subtrees


def decompose(parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For each node of a forest the totals of `values` (a row per node) over its subtree.

    `parent` is the place of each node's parent, -1 for the top of a tree; `weight` is that of the whole
    subtree, growing with every step up. All components are split at their centroids at once: the
    deepest node that has half of its component's weight below it. The total below a centroid is added
    to the nodes on the path from it to the component's top; its children's subtrees and what is left
    above become components.
    """
    n = len(parent)
    # Places in preorder: the subtree of a node is the run of places that follows it.
    by_depth = np.argsort(depth, kind="stable")
    steps = np.flatnonzero(np.diff(depth[by_depth])) + 1
    levels = np.split(by_depth, steps)
    count = np.ones(n, dtype=np.int64)
    for level in reversed(levels):
        below = level[parent[level] >= 0]
        np.add.at(count, parent[below], count[below])
    place = np.zeros(n, dtype=np.int64)
    tops = np.flatnonzero(parent < 0)
    place[tops] = np.cumsum(count[tops]) - count[tops]
    for level in levels:
        below = level[parent[level] >= 0]
        below = below[np.argsort(parent[below], kind="stable")]
        before = np.cumsum(count[below]) - count[below]
        new = np.flatnonzero(np.diff(parent[below], prepend=-1))
        sizes = np.diff(np.append(new, len(below)))
        place[below] = place[parent[below]] + 1 + before - np.repeat(before[new], sizes)
    order = np.empty(n, dtype=np.int64)
    order[place] = np.arange(n)
    up = np.where(parent[order] < 0, -1, place[parent[order]])
    count, weight, values = count[order], weight[order].copy(), values[order]

    done = np.zeros_like(values)
    component = np.zeros(n, dtype=np.int64)
    component[up < 0] = np.flatnonzero(up < 0)
    component = np.maximum.accumulate(component)
    active = np.arange(n)
    centroid = np.zeros(n, dtype=np.int64)
    while len(active):
        own = component[active]
        on_path = active[2 * weight[active] >= weight[own]]
        centroid[own] = -1
        np.maximum.at(centroid, component[on_path], on_path)  # the deepest is the last one
        x = centroid[own]
        within = (active >= x) & (active < x + count[x])
        totals = np.zeros_like(values)
        np.add.at(totals, x[within], values[active[within]])
        x_of_path = centroid[component[on_path]]
        done[on_path] += totals[x_of_path]
        above = on_path != x_of_path
        weight[on_path[above]] -= weight[x_of_path[above]]
        # Below the centroid: the component of a node is the last child of the centroid up to its place.
        below = within & (active != x)
        nodes, old = active[below], own[below]
        by_old = np.lexsort((nodes, old))
        nodes, old = nodes[by_old], old[by_old]
        child = np.maximum.accumulate(np.where(up[nodes] == centroid[old], np.arange(len(nodes)), 0))
        component[nodes] = nodes[child]
        active = active[active != x]
    out = np.empty_like(done)
    out[order] = done
    return out


def _local_totals(nodes: DataFrame, task_nodes: int) -> DataFrame:
    """Totals of the nodes of small components, many of them in each task."""
    buckets = max(1, -(-nodes.count() // task_nodes))

    def run(group: pa.Table) -> pa.Table:
        conv, depth, up, top, top_depth, weight, leaf, saved, more_leaves, more_saved = (
            np.asarray(group.column(k).fill_null(0)).astype(np.int64) for k in range(10)
        )
        known, codes = np.unique(np.concatenate([conv, up]), return_inverse=True)
        keys = depth * len(known) + codes[: len(conv)]
        wanted = (depth - 1) * len(known) + codes[len(conv) :]
        order = np.argsort(keys)
        at_top = (conv == top) & (depth == top_depth)
        found = order[np.minimum(np.searchsorted(keys, wanted, sorter=order), len(keys) - 1)]
        parent = np.where(at_top, -1, found)
        totals = decompose(parent, depth, weight, np.stack([leaf, saved], axis=1)) + np.stack([more_leaves, more_saved], axis=1)
        columns = [conv, depth, totals[:, 0], totals[:, 1]]
        return pa.table([pa.array(x) for x in columns], names=["conv", "depth", "leaves", "saved"])

    names = ["conv", "depth", "up", "top", "top_depth", "weight", "leaf", "saved", "more_leaves", "more_saved"]
    bucket = F.pmod(F.xxhash64("top", "top_depth"), F.lit(buckets)).alias("bucket")
    # applyInArrow hands the grouping column over too; it comes last and is not used.
    return nodes.select(*names, bucket).groupBy("bucket").applyInArrow(run, TOTALS)


def subtree_totals(
    nodes: DataFrame, paths: DataFrame, *, local_weight: int = LOCAL_WEIGHT, task_nodes: int = TASK_NODES
) -> DataFrame:
    """conv, depth, leaves, saved: totals over the subtree of each of `nodes` (conv, depth, up, weight,
    leaf, saved).

    Components heavier than `local_weight` are split at their centroids by joins, all of them in each
    round, which halves the heaviest; the others are decomposed in tasks that take many of them, see
    :func:`decompose`. A node's weight is the number of turns of its members from it on. That is
    known without any walk, and makes the number of rounds grow with the logarithm of the input.
    `paths` (conv, depth, rep, up) leads from a conversation to the node that it passes at a depth, and
    to that node's parent: it tells which child of a centroid a node is below.
    """
    root = nodes.where("depth = 0").select("conv").first()  # one at most
    zero = F.lit(0).cast("long")
    active = nodes.withColumns(
        {"top": F.lit(root and root["conv"]).cast("long"), "top_depth": zero, "more_leaves": zero, "more_saved": zero}
    )
    names = active.columns
    finished, small = [], []
    while True:
        tops = active.where("conv = top and depth = top_depth").select("top", "top_depth", F.col("weight").alias("total"))
        heavy = staged(tops.where(F.col("total") > local_weight), "heavy")
        if heavy.isEmpty():
            small.append(active)
            break
        key = ["top", "top_depth"]
        weighed = staged(active.join(heavy, key, "left"), "weighed")
        small.append(weighed.where("total is null").select(*names))
        # Nodes with half of the weight are the path from the top down to the centroid.
        on_path = 2 * F.col("weight") >= F.col("total")
        big = weighed.where("total is not null")
        centroids = big.where(on_path).groupBy(*key).agg(F.max_by(F.struct("conv", "depth", "weight"), "depth").alias("x"))
        centroids = staged(centroids.select(*key, F.col("x.conv").alias("xc"), F.col("x.depth").alias("xd"), F.col("x.weight").alias("xw")), "centroids")
        split = big.join(centroids, key)
        deeper = paths.select(F.col("conv").alias("pc"), F.col("depth").alias("pd"), F.col("rep").alias("child"), F.col("up").alias("child_up"))
        split = split.join(deeper, (F.col("conv") == F.col("pc")) & (F.col("xd") + 1 == F.col("pd")) & (F.col("depth") > F.col("xd")), "left")
        below = (F.col("depth") > F.col("xd")) & F.col("child_up").eqNullSafe(F.col("xc"))
        is_x = (F.col("conv") == F.col("xc")) & (F.col("depth") == F.col("xd"))
        split = staged(split.withColumns({"below": below, "is_x": is_x, "on_path": on_path}).drop("pc", "pd", "child_up"), "split")
        below_x = split.where("below or is_x").groupBy(*key).agg(F.sum("leaf").alias("sum_leaf"), F.sum("saved").alias("sum_saved"))
        below_x = staged(below_x, "component-totals")
        summed = split.join(below_x, key)
        added = {
            "more_leaves": F.col("more_leaves") + F.when(F.col("on_path"), F.col("sum_leaf")).otherwise(0),
            "more_saved": F.col("more_saved") + F.when(F.col("on_path"), F.col("sum_saved")).otherwise(0),
            "weight": F.col("weight") - F.when(F.col("on_path") & ~F.col("is_x"), F.col("xw")).otherwise(0),
            "top": F.when(F.col("below"), F.col("child")).otherwise(F.col("top")),
            "top_depth": F.when(F.col("below"), F.col("xd") + 1).otherwise(F.col("top_depth")),
        }
        after = staged(summed.withColumns(added).select(*names, "is_x"), "split-nodes")
        for frame in (heavy, centroids, split, below_x):
            unstage(frame)
        finished.append(after.where("is_x").select("conv", "depth", F.col("more_leaves").alias("leaves"), F.col("more_saved").alias("saved")))
        active = after.where("not is_x").select(*names)
    local = _local_totals(reduce(DataFrame.unionByName, small), task_nodes)
    return reduce(DataFrame.unionByName, finished, local)


def prefix_trie(
    conversations: DataFrame,
    *,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    segment: int = SEGMENT,
    local_weight: int = LOCAL_WEIGHT,
    task_nodes: int = TASK_NODES,
) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    A conversation is rebuilt from the first h turns of the first conversation of its family (its id
    without the rest by 20) and its own turns after its first h, h being crc32 of its id modulo 4. A
    node is a distinct sequence of first turns (role and text) of rebuilt conversations, which are its
    members; the root has none. n_leaves and saved_tokens (the members but one, times the words of the
    last turn) are totals over the subtree; ends_sha256 hashes the ids of the conversations that end there.

    Turns are ordered by `turn`, null first; turns of one number by the MD5 of role and text, repeated
    rows one after the other. A null role or text is empty. Rows without a conversation are left out. A
    conversation that is left without turns is a member of the root. A conversation of any length, and any
    number of equal ones, is dealt over many tasks. Other columns are ignored. An empty table has no
    node.
    """
    turns = numbered_turns(conversations, conv_id, turn, role, text)
    members = prefixes(rebuilt(turns), segment)
    key = ["depth", "p", "q"]
    weight = F.sum(F.col("size") - F.col("depth") + 1).alias("weight")
    named = staged(
        members.groupBy(*key).agg(
            F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n_convs"), F.any_value("words").alias("words"), weight
        ),
        "named",
    )
    passed = staged(
        members.join(named.select(*key, "rep"), key).select("conv", "depth", "rep", (F.col("depth") == F.col("size")).alias("ends")),
        "passed",
    )
    unstage(members)
    above = passed.select("conv", (F.col("depth") + 1).alias("depth"), F.col("rep").alias("up"))
    paths = staged(passed.join(above, ["conv", "depth"], "left"), "paths")
    unstage(passed)
    unstage(turns)
    own = named.select(F.col("rep").alias("conv"), "depth", "n_convs", "words", "weight")
    nodes = staged(own.join(paths.where("conv = rep").select("conv", "depth", "up"), ["conv", "depth"]), "nodes")
    unstage(named)
    children = nodes.where("up is not null").groupBy(F.col("up").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes2 = staged(nodes.join(children, ["conv", "depth"], "left").fillna(0, ["n_children"]), "nodes")
    unstage(nodes)
    saved = (F.col("n_convs") - 1) * F.col("words")
    valued = nodes2.select(
        "conv", "depth", "up", "weight", (F.col("n_children") == 0).cast("long").alias("leaf"), saved.cast("long").alias("saved")
    )
    totals = subtree_totals(valued, paths, local_weight=local_weight, task_nodes=task_nodes)
    hashes = hashed_ids(paths.where("ends").select("rep", "depth", "conv"))
    return (
        nodes2.join(totals, ["conv", "depth"])
        .join(hashes, ["conv", "depth"], "left")
        .select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("up").alias("parent_conv_id"),
            "n_convs",
            "n_children",
            F.col("leaves").alias("n_leaves"),
            F.col("saved").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )
