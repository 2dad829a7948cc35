"""op12 against brute force: fingerprints bit by bit, links pair by pair, components by union."""

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import simhash
from tessera.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_operators import docs_of


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\r\x0b\x0c":
            words, word = words + [word] * bool(word), ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """(doc_id, fingerprint, component) of (doc_id, text) rows by comparing all pairs."""
    prints = [plain_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            parent[root(a)] = root(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[root(k)] = min(i, least.get(root(k), i))
    return sorted(((i, f"{p:016x}", least.get(root(k))) for k, ((i, _), p) in enumerate(zip(rows, prints))), key=str)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


def test_golay_tables():
    g = simhash.Golay()
    assert int(g.is_far.sum()) == 1771 and all(len(set(x)) == 5 for x in g.far[g.is_far].tolist())
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 500)
    index, more, far = g.keys(words)
    assert all(0 <= k < 4096 for k in index) and far.shape == (len(more), 5)
    # every word lies within three bits of its codeword, and codewords are multiples of the generator
    s = [simhash._remainder(int(w)) for w in words]
    code = words ^ g.error[s]
    assert all(simhash._remainder(int(c)) == 0 and int(c ^ w).bit_count() <= 3 for c, w in zip(code, words))


def test_every_pair_within_three_bits_shares_a_key():
    rng, golay = np.random.default_rng(2), simhash.Golay()
    a = rng.integers(0, 1 << 64, 4000, dtype=np.uint64)
    b = a.copy()
    for i in range(len(b)):
        for k in rng.choice(64, i % 4, replace=False):
            b[i] ^= np.uint64(1) << np.uint64(k)
    found = []
    for x in (a, b):
        keys, owner = simhash.fingerprint_keys(x, golay)
        held = [set() for _ in x]
        for k, o in zip(keys.tolist(), owner.tolist()):
            assert k not in held[o]
            held[o].add(k)
        found.append(held)
    assert all(x & y for x, y in zip(*found))


def test_components_match_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert got(QUERIES["op12_simhash_components"](spark, SF_SMALL)) == plain_components(rows)


def near_copies(n, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    out = []
    for _ in range(n):
        words = list(base)
        words[rng.randrange(150)] = f"x{rng.randrange(4)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("block", [4096, 16])
def test_large_group_of_near_copies(spark, block):
    """Chains of links, and buckets above the block size, whose blocks meet."""
    rows = list(enumerate(near_copies(250, 3) + near_copies(120, 4)))
    docs = docs_of(spark, rows).repartition(5)
    assert got(simhash.components(docs, block=block)) == plain_components(rows)


def test_blocks_alone_span_the_same_components(spark):
    rng = np.random.default_rng(5)
    fps = np.unique([int(x) for x in rng.integers(0, 1 << 9, 300)])
    df = spark.createDataFrame([(int(x),) for x in fps], "fp long")

    def parts(pairs):
        label = {int(x): int(x) for x in fps}
        for a, b in pairs:
            old, new = max(label[a], label[b]), min(label[a], label[b])
            label = {k: new if v == old else v for k, v in label.items()}
        return label

    want = parts((int(a), int(b)) for a, b in combinations(fps, 2) if int(a ^ b).bit_count() <= 3)
    assert parts((r.a, r.b) for r in simhash.links(df, block=8).collect()) == want
    assert simhash.links(df, block=4096).count() <= 20 * 2 * len(fps)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "alpha beta"), (None, "alpha beta"), (3, " \t\n"), (4, "Éa b"), (4, "éa b"),
            (5, "one"), (6, "ONE"), (7, "one two three"), (7, "one two three"), (9, " ".join(f"w{i}" for i in range(70_000)))]
    assert got(simhash.components(docs_of(spark, rows))) == plain_components(rows)
    empty = docs_of(spark, [])
    out = simhash.components(empty.withColumn("component_id", F.lit(1)).withColumn("fp", F.lit("x")))
    assert out.columns == ["doc_id", "fingerprint", "component_id"] and out.count() == 0
