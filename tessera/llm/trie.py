"""Prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of first turns. Its key is a digest of the sums
of 4 x 32 hash bits of (depth, turn) over the sequence: sums are running
totals, so a conversation with very many turns is spread over tasks by
position, and a node's parent is the same sum without the last turn.

Subtree totals come from the forest of parent edges. A component is a
connected part of it with a top node. Each round picks the centroid of every
component: the deepest node that still holds more than half of the
component's weight. The weight below a node (turns of its members from there
on) falls out of the grouping, so no round has to measure subtrees. The
totals of the component at and below the centroid are added to the centroid
and to the nodes between it and the top; the centroid goes, its children
become tops, and the rest stays one component that has lost that weight. No
part keeps more than half, so rounds are logarithmic in the turns, however
deep a chain is. Components of at most ``LOCAL`` nodes are taken apart in the
same way within one task. An ancestor of a node at a given depth is looked up
by the node's smallest member and that depth.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.shared import map_batches, written
from tessera.operators.joins import checked_broadcast

LOCAL = 4096
HEAD, FAMILY = 9, 5
PIECES = ("s0", "s1", "s2", "s3")
CHUNK_IDS = 1 << 14


def with_running(df: DataFrame, key: str, order: Sequence[str], sums: dict[str, Column], total: str | None = None) -> DataFrame:
    """Running sums (long, this row included) of ``sums`` within ``key`` by ``order``; ``total``: rows of the key.

    Rows are dealt by ranges of key and order, so a hot key spreads over many
    partitions; each (partition, key) piece is summed by itself and shifted by
    the totals of the key's earlier pieces. The dealt rows are written, as
    both steps must see the same ranges.
    """
    dealt = written(df.select("*", *[v.alias(f"_{k}") for k, v in sums.items()]).repartitionByRange(key, *order)
                    .withColumn("_part", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_part", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    pieces = dealt.groupBy("_part", key).agg(F.count(F.lit(1)).alias("_n"), *[F.sum(f"_{k}").alias(f"_{k}_sum") for k in sums])
    of_key = Window.partitionBy(key)
    before = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = pieces.select("_part", key, F.sum("_n").over(of_key).alias("_total"),
                           *[F.coalesce(F.sum(f"_{k}_sum").over(before), F.lit(0)).alias(f"_{k}_shift") for k in sums])
    local = dealt.select("*", *[F.sum(f"_{k}").over(inside).alias(f"_{k}_here") for k in sums])
    return local.join(shifts, ["_part", key]).select(
        *df.columns, *[(F.col(f"_{k}_here") + F.col(f"_{k}_shift")).alias(k) for k in sums],
        *([F.col("_total").alias(total)] if total else []))


def rebuilt_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv_id, depth, turn_hash, bytes)`` of the rebuilt conversations, and the ids of all conversations."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        "conv_id", "turn", F.md5(F.encode(F.concat(F.octet_length(role), F.lit(":"), role, text), "UTF-8")).alias("turn_hash"),
        F.octet_length(text).cast("long").alias("bytes"))
    numbered = written(with_running(turns, "conv_id", ["turn", "turn_hash"], {"at": F.lit(1).cast("long")})
                       .select("conv_id", "at", "turn_hash", "bytes"), "turns")
    convs = numbered.select("conv_id").distinct().select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"),
        (F.crc32(F.encode(F.col("conv_id").cast("string"), "UTF-8")) % HEAD).alias("h"))
    heads = numbered.where((F.col("at") < HEAD) & (F.col("conv_id") % FAMILY == 0)).withColumnRenamed("conv_id", "base")
    led = heads.groupBy("base").agg(F.count(F.lit(1)).alias("n"))
    convs = written(convs.join(led, "base", "left").select(
        "conv_id", "base", "h", F.least("h", F.coalesce("n", F.lit(0))).alias("lead")), "conversations")
    front = heads.join(convs, "base").where("at <= h").select("conv_id", F.col("at").alias("depth"), "turn_hash", "bytes")
    own = numbered.join(checked_broadcast(convs.select("conv_id", "h", "lead")), "conv_id").where("at > h").select(
        "conv_id", (F.col("lead") + F.col("at") - F.col("h")).alias("depth"), "turn_hash", "bytes")
    return front.unionByName(own), convs.select("conv_id")


def _node_key(depth: Column, *sums: Column) -> Column:
    return F.md5(F.encode(F.concat_ws(":", depth, *sums), "UTF-8"))


def member_rows(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per conversation and depth, the root (depth 0) included: ``conv_id, depth, key, parent, bytes, length``."""
    hashed = turns.withColumn("_d", F.md5(F.encode(F.concat_ws(":", "depth", "turn_hash"), "UTF-8")))
    sums = {k: F.conv(F.substring("_d", 8 * i + 1, 8), 16, 10).cast("long") for i, k in enumerate(PIECES)}
    for k, v in sums.items():
        hashed = hashed.withColumn(f"{k}_own", v)
    hashed = hashed.drop("_d", "turn_hash")
    walked = with_running(hashed, "conv_id", ["depth"], {k: F.col(f"{k}_own") for k in PIECES}, total="length")
    root = _node_key(*[F.lit(0)] * 5)
    rows = walked.select("conv_id", "depth", _node_key(F.col("depth"), *map(F.col, PIECES)).alias("key"),
                         _node_key(F.col("depth") - 1, *[F.col(k) - F.col(f"{k}_own") for k in PIECES]).alias("parent"),
                         "bytes", "length")
    rows = written(rows, "rows")
    lengths = rows.where("depth = 1").select("conv_id", "length")
    tops = convs.join(lengths, "conv_id", "left").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), root.alias("key"), F.lit(None).cast("string").alias("parent"),
        F.lit(0).cast("long").alias("bytes"), F.coalesce("length", F.lit(0)).alias("length"))
    return written(rows.unionByName(tops), "members")


def centroid_totals(parent: Sequence[int], values: np.ndarray) -> np.ndarray:
    """Subtree totals of one component by centroid decomposition: ``parent`` of each node (-1: the top, first row).

    Rows are ordered by depth. Components wait in a list, so deep chains need
    no recursion.
    """
    totals = np.zeros_like(values)
    waiting = [list(range(len(parent)))]
    below = [0] * len(parent)
    while waiting:
        nodes = waiting.pop()
        top = nodes[0]
        for x in nodes:
            below[x] = 1
        for x in reversed(nodes[1:]):
            below[parent[x]] += below[x]
        centroid = next(x for x in reversed(nodes) if 2 * below[x] > len(nodes))
        held = {centroid: -1}  # nodes at and below the centroid: the child of the centroid they belong to
        rest, parts = [], {}
        for x in nodes:
            if x == centroid:
                continue
            if x != top and parent[x] in held:
                branch = x if parent[x] == centroid else held[parent[x]]
                held[x] = branch
                parts.setdefault(branch, []).append(x)
            else:
                rest.append(x)
        total = values[list(held)].sum(axis=0)
        x = centroid
        while True:
            totals[x] += total
            if x == top:
                break
            x = parent[x]
        waiting.extend(parts.values())
        if rest:
            waiting.append(rest)
    return totals


def _local_totals(columns: Sequence[str]):
    """Totals of components, each in one piece of rows sorted by top and depth."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        now = None

        def done() -> pd.DataFrame:
            part = pd.concat(held) if len(held) > 1 else held[0]
            keys = part["key"].tolist()
            at = {k: i for i, k in enumerate(keys)}
            parent = [-1, *[at[p] for p in part["parent"].tolist()[1:]]]
            totals = centroid_totals(parent, part[list(columns)].to_numpy(np.int64))
            return pd.DataFrame({"key": keys, **{c: totals[:, k] for k, c in enumerate(columns)}})

        out: list[pd.DataFrame] = []
        for b in batches:
            tops = b["top"].to_numpy()
            cut = np.flatnonzero(np.append(True, tops[1:] != tops[:-1]))
            for s, e in zip(cut, [*cut[1:], len(b)], strict=True):
                if tops[s] != now and held:
                    out.append(done())
                    held = []
                now = tops[s]
                held.append(b.iloc[s:e])
            if out:
                yield pd.concat(out)
                out = []
        if held:
            yield done()
    return run


def subtree_totals(nodes: DataFrame, members: DataFrame, columns: Sequence[str], local: int = LOCAL) -> DataFrame:
    """``(key, *columns)``: every column summed over the node's subtree.

    ``nodes(key, parent, depth, conv_id, weight, *columns)``, the weight at and
    below a node; ``members(conv_id, depth, key, parent)`` to find ancestors.
    """
    alive = nodes.join(nodes.where("depth = 0").select(F.col("key").alias("top")).hint("broadcast"))  # one root
    done: list[DataFrame] = []
    while True:
        alive = written(alive.select("key", "parent", "depth", "conv_id", "weight", "top", *columns), "alive")
        tops = alive.groupBy("top").agg(F.count(F.lit(1)).alias("n"), F.max("weight").alias("total"),
                                        F.min("depth").alias("top_depth"))
        large = written(tops.where(F.col("n") > local), "large")
        small = alive.join(checked_broadcast(large.select("top")), "top", "left_anti")
        done.append(map_batches(small.repartition("top").sortWithinPartitions("top", "depth"), _local_totals(columns),
                                "key string, " + ", ".join(f"{c} long" for c in columns)))
        if large.isEmpty():
            break
        alive = alive.join(checked_broadcast(large.select("top", "total", "top_depth")), "top")
        centroids = written(alive.where(2 * F.col("weight") > F.col("total")).groupBy("top", "top_depth").agg(
            F.max_by(F.struct("key", "conv_id", "depth"), "depth").alias("z"))
            .select("top", "top_depth", F.col("z.key").alias("z"), F.col("z.conv_id").alias("z_conv"),
                    F.col("z.depth").alias("z_depth")), "centroids")
        held = alive.join(checked_broadcast(centroids.drop("top_depth")), "top")
        # the child of the centroid above each chain of nodes with one smallest member
        chains = held.where("depth > z_depth").select("top", "z", "z_depth", "conv_id").distinct()
        branches = chains.join(members.select("conv_id", (F.col("depth") - 1).alias("z_depth"), F.col("key").alias("branch"),
                                              F.col("parent").alias("z")), ["conv_id", "z_depth", "z"]).select(
            "top", "conv_id", "branch")
        held = written(held.join(branches, ["top", "conv_id"], "left").select(
            "key", "parent", "depth", "conv_id", "weight", "top", "z", *columns,
            F.when(F.col("depth") > F.col("z_depth"), F.col("branch")).alias("branch")), "held")
        within = (F.col("key") == F.col("z")) | F.col("branch").isNotNull()
        sums = held.where(within).groupBy("top").agg(
            *[F.sum(c).alias(c) for c in columns], F.max(F.when(F.col("key") == F.col("z"), F.col("weight"))).alias("lost"))
        sums = written(sums.join(centroids, "top"), "totals")
        path = (members.select("conv_id", "depth", "key").join(
            checked_broadcast(sums.withColumnRenamed("z_conv", "conv_id")), "conv_id")
            .where("depth BETWEEN top_depth AND z_depth"))
        path = written(path.select("key", "lost", *columns), "paths")
        done.append(path.select("key", *columns))
        rest = held.where(F.col("key") != F.col("z")).join(path.select("key", "lost"), "key", "left")
        alive = rest.select("key", "parent", "depth", "conv_id", (F.col("weight") - F.coalesce("lost", F.lit(0))).alias("weight"),
                            F.coalesce("branch", "top").alias("top"), *columns)
    return reduce(DataFrame.unionByName, done).groupBy("key").agg(*[F.sum(c).alias(c) for c in columns])


def _joined_ids(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of ids of one key, comma-joined; rows come sorted by key and id."""
    for b in batches:
        for s in range(0, len(b), CHUNK_IDS):
            part = b.iloc[s:s + CHUNK_IDS]
            keys, ids = part["key"].to_numpy(), part["conv_id"].tolist()
            cut = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])).tolist()
            yield pd.DataFrame([(keys[i], ids[i], ",".join(map(str, ids[i:j]))) for i, j in zip(cut, [*cut[1:], len(ids)])],
                               columns=["key", "first", "ids"])


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each key's chunks, fed one by one; rows come sorted by key and first id."""
    now, sha = None, None
    for b in batches:
        out = []
        for key, ids in zip(b["key"], b["ids"]):
            if key != now:
                if now is not None:
                    out.append((now, sha.hexdigest()))
                now, sha = key, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        yield pd.DataFrame(out, columns=["key", "ends_sha256"])
    if now is not None:
        yield pd.DataFrame([(now, sha.hexdigest())], columns=["key", "ends_sha256"])


def end_digests(members: DataFrame) -> DataFrame:
    """``(key, ends_sha256)`` of nodes at which conversations end.

    Sorting and joining the ids is spread by ranges of (node, id); only the
    hash of a node's joined ids, sequential by its nature, is one task's work,
    in the memory of one batch.
    """
    ends = members.where("depth = length").select("key", "conv_id")
    chunks = map_batches(ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id"), _joined_ids,
                         "key string, first long, ids string")
    return map_batches(chunks.repartition("key").sortWithinPartitions("key", "first"), _digested, "key string, ends_sha256 string")


def rollup(conversations: DataFrame, local: int = LOCAL) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``, and ``key`` and ``parent`` that name nodes (they hold for
    one input and code version). Turns are ordered by turn, null first, and by
    a hash of role and text where turns tie; a null role or text is empty;
    repeated rows are turns of their own. Rows with a null conv_id belong to
    no conversation and are left out. ``conv_id % 5`` has the sign of conv_id,
    as in SQL. Only conv_id, turn, role and text are read; an empty table has
    no conversation, so no node.
    """
    turns, convs = rebuilt_turns(conversations.select("conv_id", "turn", "role", "text"))
    members = member_rows(turns, convs)
    nodes = written(members.groupBy("key", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("bytes").alias("bytes"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight")), "nodes")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = written(nodes.join(children, "key", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))),
                    "nodes")
    valued = nodes.select("key", "parent", "depth", "conv_id", "weight",
                          F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"),
                          ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved_tokens"))
    totals = subtree_totals(valued, members.select("conv_id", "depth", "key", "parent"), ["n_leaves", "saved_tokens"], local)
    above = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (nodes.join(totals, "key").join(end_digests(members), "key", "left").join(above, "parent", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"), "key", "parent"))
