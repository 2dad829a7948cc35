"""op13 against a trie of plain dictionaries and against its SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import trie
from tessera.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "conv_id long, turn long, role string, text string, key string, depth int, n string, weight double"
NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def conversations(spark, rows):
    """Turns with columns that clash with names the operator uses."""
    return spark.createDataFrame([(*r, "x", 1, "y", 0.5) for r in rows], SCHEMA)


def plain(rows):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - c % 5 if c >= 0 else c + -c % 5  # the remainder has the sign of c
        rebuilt[c] = own.get(base, [])[:h] + mine[h:]
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, who in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in children
            saved[p[:d]] += (len(who) - 1) * len(p[-1][1].encode()) if p else 0
    out = []
    for p, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(rebuilt[c]) == len(p))
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children[p], leaves[p], saved[p],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()), key=str)


@pytest.mark.parametrize("shape", ["random", "chain", "star", "comb"])
def test_centroid_totals(shape):
    rng, n = random.Random(3), 400
    parent = {"random": [-1] + [rng.randrange(i) for i in range(1, n)], "chain": list(range(-1, n - 1)),
              "star": [-1] + [0] * (n - 1), "comb": [-1, 0] + [i - 2 + i % 2 for i in range(2, n)]}[shape]
    depth = [0] * n
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    order = sorted(range(n), key=lambda i: depth[i])
    place = {x: k for k, x in enumerate(order)}
    parent = [-1 if parent[x] < 0 else place[parent[x]] for x in order]
    values = np.array([[rng.randrange(9), 1] for _ in range(n)], np.int64)
    want = values.copy()
    for i in range(n - 1, 0, -1):
        want[parent[i]] += want[i]
    assert (trie.centroid_totals(parent, values) == want).all()


@pytest.mark.parametrize("local", [trie.LOCAL, 20])
def test_matches_sql(spark, local):
    """With few nodes a task, rounds over tables take most components apart."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF_SMALL}/conversations.parquet')")
    rel = con.sql(ORACLE_SQL["op13_conversation_trie"])
    at = [rel.columns.index(n) for n in NAMES]
    want = sorted((tuple(r[k] for k in at) for r in rel.fetchall()), key=str)
    if local == trie.LOCAL:
        out = QUERIES["op13_conversation_trie"](spark, SF_SMALL)
        assert set(out.columns) == set(NAMES)
    else:
        out = trie.rollup(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"), local)
    assert got(out) == want


def test_deep_and_common_conversations(spark):
    rows = [(10, t, "user", f"t{t % 7}") for t in range(300)]
    rows += [(c, t, "user", f"t{t % 7}") for c in range(11, 15) for t in range(40)]
    rows += [(c, t, "a" if t % 2 else "b", "same é") for c in range(20, 60) for t in range(c % 3 + 1)]
    random.Random(1).shuffle(rows)
    assert got(trie.rollup(conversations(spark, rows).repartition(4), local=16)) == plain(rows)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 1, "user", "x" * 100_000), (5, 3, None, "a"), (5, None, "user", None), (-7, 1, "u", "a"),
            (-5, 0, "u", "z"), (8, 0, "user", "a"), (8, 0, "user", "a"), (1 << 40, 0, "ab", "c"), ((1 << 40) + 1, 0, "a", "bc")]
    missing = [(None, 0, "user", "no conversation"), (None, None, None, None)]
    assert got(trie.rollup(conversations(spark, rows + missing))) == plain(rows)
    empty = trie.rollup(conversations(spark, []))
    assert set(NAMES) <= set(empty.columns) and empty.count() == 0


def test_long_conversation_is_dealt_by_position(spark):
    """The running totals of one hot key agree with a plain count, over many ranges."""
    df = spark.range(5000).select(F.lit(1).alias("k"), ((F.col("id") * 37) % 5000).alias("o"), F.lit("x").alias("_part0"))
    out = trie.with_running(df.repartition(9), "k", ["o"], {"at": F.lit(1).cast("long"), "s": F.col("o")}, total="all")
    assert all(r["at"] == r["o"] + 1 and r["s"] == r["o"] * (r["o"] + 1) // 2 and r["all"] == 5000 for r in out.collect())
