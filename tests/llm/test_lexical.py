"""op11 against its SQL and against plain Python scoring of every document."""

import math
import re
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import lexical
from tessera.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.llm.test_operators import docs_of

ITEMS = "item_id long, text string, doc_id long, score string, rank int"


def plain_terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lowered)


def plain(docs, items, k=10):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    total, df = sum(n for _, _, n in held), Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in set(items):
        scores = []
        for i, c, n in held:
            m = 25 + (75 * n * len(held)) // total
            s = sum(math.floor(1000 * math.log((2 * len(held) + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t in plain_terms(text) if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=str)


def got(df):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()), key=str)


@pytest.mark.parametrize("sf", [SF_SMALL, SF_ORACLE])
def test_matches_sql(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    rel = con.sql(f"SELECT item_id, rank, doc_id, score FROM ({ORACLE_SQL['op11_ranked_search']})")
    assert got(QUERIES["op11_ranked_search"](spark, sf)) == sorted(rel.fetchall(), key=str)


def test_bounds_hold_for_every_document():
    """No bound falls short of the score, and few are far above it."""
    docs = pd.read_parquet(f"{SF_SMALL}/documents.parquet")
    docs["text"] = [t + " the the zz" * (k % 40) for k, t in enumerate(docs["text"].fillna(""))]
    docs["row_hash"] = np.arange(len(docs))
    stretch = lexical._Stretch()
    stretch.add(docs)
    blocks = list(stretch.rows())
    q = lexical.Queries([(1, docs["text"][0][:300]), (2, "the zz zz"), (3, "nowhere"), (4, docs["text"][7])])
    *blocks, words = [b.iloc[0] for b in blocks]
    df = dict(zip(np.frombuffer(words.terms, np.int64).tolist(), np.frombuffer(words.dfs, np.int64).tolist()))
    q.weigh(sum(b.n_docs for b in blocks), sum(b.n_terms for b in blocks), df)
    near = total = 0
    for b in blocks:
        bounds = q.bounds(b)
        for j, at in enumerate(np.frombuffer(b.row_hashes, np.int64)):
            terms = lexical.terms_of(docs["text"][at])
            for i in range(4):
                score = q.score(i, Counter(terms), len(terms))
                assert bounds[i, j] >= score
                near += bounds[i, j] <= 1.1 * score
                total += 1
    assert near > 0.8 * total


def test_ties_nulls_and_copies(spark):
    rows = [(i, "alpha beta gamma") for i in range(30, 0, -1)] + [(None, "alpha beta gamma"), (5, "alpha"), (5, "alpha"), (6, None),
            (7, ""), (8, "!?"), (9, "ÉTÉ alpha"), (10, "été"), (11, " ".join(f"w{i % 997}" for i in range(60_000)))]
    items = [(1, "Alpha beta"), (1, "Alpha beta"), (1, "gamma"), (2, None), (3, ""), (4, "unheard"), (None, "été w5 w5"), (5, "ÉTÉ")]
    want = plain(rows, [(i, t) for i, t in items if t])
    found = spark.createDataFrame([(i, t, 7, "x", 1) for i, t in items], ITEMS)
    assert got(lexical.ranked(docs_of(spark, rows).repartition(3), found)) == want


def test_items_in_groups(spark, monkeypatch):
    monkeypatch.setattr(lexical, "QUERY_TERMS", 60)
    docs, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("documents", "benchmark"))
    some = items.where("item_id < 5")
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in some.collect()])
    assert got(lexical.ranked(docs, some)) == want


def test_empty_tables(spark):
    docs, items = docs_of(spark, [(1, "a b c")]), spark.createDataFrame([(1, "a", 1, "x", 1)], ITEMS)
    none, no_items = docs_of(spark, []), items.where("false")
    for d, i in ((none, items), (docs, no_items), (none, no_items)):
        out = lexical.ranked(d, i)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0
    assert got(lexical.ranked(docs.withColumn("items", F.lit(1)), items)) == plain([(1, "a b c")], [(1, "a")])
