"""Ranked lexical search over bit-sliced Bloom signatures.

Index. Every document has a Bloom signature of its terms. A term that occurs
more often is inserted again at each step of ``LEVELS`` it reaches, so the
signature also bounds term frequencies. Documents of like size form blocks,
each as wide as its largest document needs; a block is stored by slices: one
bitmap over its documents for every signature bit. A dictionary per stretch of
documents holds its terms' hashes and document frequencies.

Search. The bitmap of a term at a level is the AND of its slices: a superset
of the documents that have it. Summing the bitmaps of an item's terms,
weighted, level by level, gives an upper bound of every document's score. The
ten best bounds of each item are scored exactly, which gives a score that the
tenth place reaches at least; all documents whose bound doesn't fall short of
it are then scored exactly from their whole texts. The bounds hold for every
document, so the result is exact, and false positives only cost time.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.shared import by_text_size, map_batches, scratch_dir, written
from tessera.llm.shingles import mix, term_hashes
from tessera.operators.joins import checked_broadcast
from tessera.operators.sorting import top_k_per_group

TOP = 10
#: Bits for an inserted key, and bits it sets: about one false positive in 300.
KEY_BITS, KEY_HASHES = 12, 6
#: Term frequencies at which a term is inserted again: powers of two and the numbers halfway.
LEVELS = tuple(sorted({1, *(1 << k for k in range(1, 32)), *(3 << k for k in range(31))}))
BLOCK_ROWS, BLOCK_CELLS = 1024, 1 << 24
#: A stretch of documents is cut into blocks at so many (document, term) pairs.
STRETCH = 1 << 21
#: Terms, repeats included, of the items that one search works on.
QUERY_TERMS = 1 << 20
SUM_CELLS = 1 << 22
_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
INDEX = ("width int, doc_ids binary, no_id binary, row_hashes binary, lengths binary, slices binary, "
         "terms binary, dfs binary, n_docs long, n_terms long")
_SALTS = mix(np.arange(1, len(LEVELS) + KEY_HASHES + 1, dtype=np.uint64))


def positions(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """``KEY_HASHES`` rows of signature bits of terms at a level."""
    key = mix(hashes ^ _SALTS[KEY_HASHES + level])
    return np.stack([((mix(key + s) >> np.uint64(32)) * np.uint64(width) >> np.uint64(32)).astype(np.int64)
                     for s in _SALTS[:KEY_HASHES]])


class _Stretch:
    """Documents gathered until they are cut into blocks."""

    def __init__(self):
        self.docs: list[tuple[np.ndarray, ...]] = []
        self.pairs: list[tuple[np.ndarray, ...]] = []
        self.n_docs = self.n_pairs = 0

    def add(self, batch: pd.DataFrame) -> None:
        hashes, owner = term_hashes([t.encode().lower() for t in batch["text"]])
        if not len(hashes):
            return
        lengths = np.bincount(owner, minlength=len(batch))
        same = mix(hashes ^ mix(owner.astype(np.uint64) + _SALTS[0]))  # one value for a document's term; unsalted, a
        # number of a document could stand for a letter
        order = np.argsort(same)
        at = np.flatnonzero(np.diff(same[order], prepend=~same[order[0]]))
        tf, first = np.diff(at, append=len(order)), order[at]
        kept = np.flatnonzero(lengths)  # without a term a document has no score
        number = np.cumsum(lengths > 0) - 1
        ids = batch["doc_id"].astype("Int64")
        self.docs.append((ids.fillna(0).to_numpy(np.int64)[kept], ids.isna().to_numpy()[kept],
                          batch["row_hash"].to_numpy(np.int64)[kept], lengths[kept]))
        self.pairs.append((self.n_docs + number[owner[first]], hashes[first], tf))
        self.n_docs += len(kept)
        self.n_pairs += len(first)

    def rows(self) -> Iterator[pd.DataFrame]:
        """Blocks, and the stretch's dictionary."""
        ids, no_id, row_hash, lengths = map(np.concatenate, zip(*self.docs))
        owner, hashes, tf = map(np.concatenate, zip(*self.pairs))
        inserted = np.bincount(owner, np.searchsorted(LEVELS, tf, "right"), len(ids)).astype(np.int64)
        order = np.argsort(inserted, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        by_place = np.argsort(place[owner], kind="stable")
        pair_place = place[owner][by_place]
        start = 0
        while start < len(ids):
            end = min(start + BLOCK_ROWS, len(ids))
            while end - start > 8 and ((end - start) * inserted[order[end - 1]] * KEY_BITS > BLOCK_CELLS
                                       or inserted[order[end - 1]] > 2 * inserted[order[start]] + 64):
                end = start + (end - start + 1) // 2
            width = int(max(64, inserted[order[end - 1]] * KEY_BITS))
            lo, hi = np.searchsorted(pair_place, [start, end])
            sel = by_place[lo:hi]
            cells = np.zeros((width, end - start), bool)
            for level, least in enumerate(LEVELS):
                sel = sel[tf[sel] >= least]
                if not len(sel):
                    break
                cells[positions(hashes[sel], level, width), place[owner[sel]] - start] = True
            docs = order[start:end]
            yield pd.DataFrame([{
                "width": width, "doc_ids": ids[docs].tobytes(), "no_id": no_id[docs].tobytes(),
                "row_hashes": row_hash[docs].tobytes(), "lengths": lengths[docs].astype(np.int64).tobytes(),
                "slices": np.packbits(cells, axis=1).tobytes(), "terms": None, "dfs": None,
                "n_docs": len(docs), "n_terms": int(lengths[docs].sum())}])
            start = end
        terms, dfs = np.unique(hashes, return_counts=True)
        yield pd.DataFrame([{"width": None, "doc_ids": None, "no_id": None, "row_hashes": None, "lengths": None, "slices": None,
                             "terms": terms.tobytes(), "dfs": dfs.astype(np.int64).tobytes(), "n_docs": 0, "n_terms": 0}])


def _indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    stretch = _Stretch()
    for b in by_text_size(batches, "text"):
        stretch.add(b)
        if stretch.n_pairs >= STRETCH:
            yield from stretch.rows()
            stretch = _Stretch()
    if stretch.n_pairs:
        yield from stretch.rows()


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("row_hash")).where("text IS NOT NULL")


def write_index(docs: DataFrame, path: str) -> None:
    """Index of all rows of ``docs(doc_id, text)`` with a term, as Parquet."""
    map_batches(_rows(docs), _indexed, INDEX).write.parquet(path)


def terms_of(text: str) -> list[bytes]:
    return _TERM.findall(text.encode().lower())


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Queries:
    """Items of one search: their terms, weights and corpus statistics, as arrays for the tasks."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.item_ids = [i for i, _ in items]
        counted = [Counter(terms_of(t)) for _, t in items]
        self.terms = sorted(set().union(*counted))
        number = {t: k for k, t in enumerate(self.terms)}
        self.hashes = term_hashes([b" ".join(self.terms)])[0]
        self.start = np.cumsum([0] + [len(c) for c in counted])
        self.term = np.array([number[t] for c in counted for t in c], np.int64)
        self.times = np.array([k for c in counted for k in c.values()], np.int64)

    def weigh(self, n_docs: int, n_terms: int, dfs: dict[int, int]) -> None:
        self.n_docs, self.n_terms = n_docs, n_terms
        own = np.array([term_weight(n_docs, dfs.get(int(h), 0)) for h in self.hashes.view(np.int64)], np.int64)
        self.weight = own[self.term] * self.times

    def length_norm(self, lengths):
        return 100 - 75 + (75 * lengths * self.n_docs) // self.n_terms

    def bounds(self, block) -> np.ndarray:
        """Upper bound of the score of every item (row) for every document of a block (column)."""
        lengths = np.frombuffer(block.lengths, np.int64)
        m, n = self.length_norm(lengths), len(lengths)
        slices = np.frombuffer(block.slices, np.uint8).reshape(block.width, -1)
        out = np.zeros((len(self.item_ids), n), np.int64)
        live, bits, gain = np.arange(len(self.terms)), None, np.zeros(n, np.int64)
        for level in range(len(LEVELS)):
            at = positions(self.hashes[live], level, block.width)
            here = slices[at[0]]
            for row in at[1:]:
                here &= slices[row]
            bits = here if bits is None else here & bits  # who has a term twice has it once
            keep = bits.any(axis=1)
            live, bits = live[keep], bits[keep]
            if not len(live):
                break
            most = lengths if level + 1 == len(LEVELS) else np.minimum(LEVELS[level + 1] - 1, lengths)
            reached = (1_000_000_000 * most) // (1000 * most + 8 * m)
            out += self._summed(live, np.unpackbits(bits, axis=1, count=n)) * (reached - gain)
            gain = reached
        return out

    def _summed(self, live: np.ndarray, bits: np.ndarray) -> np.ndarray:
        """Weighted sums of the live terms' bitmaps for every item."""
        place = np.full(len(self.terms), -1)
        place[live] = np.arange(len(live))
        uses = np.flatnonzero(place[self.term] >= 0)
        item = np.searchsorted(self.start, uses, "right") - 1
        out = np.zeros((len(self.item_ids), bits.shape[1]), np.int64)
        step = max(1, SUM_CELLS // bits.shape[1])
        for s in range(0, len(uses), step):
            part, own = uses[s:s + step], item[s:s + step]
            edge = np.flatnonzero(np.diff(own, prepend=-1))
            out[own[edge]] += np.add.reduceat(bits[place[self.term[part]]] * self.weight[part, None], edge, axis=0)
        return out

    def score(self, item: int, have: Counter, n: int) -> int:
        m, total = self.length_norm(n), 0
        for k in range(self.start[item], self.start[item + 1]):
            if tf := have.get(self.terms[self.term[k]]):
                total += int(self.weight[k]) * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        return total


def _frequencies(wanted):
    """Document frequencies of the wanted terms, by dictionaries."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = np.sort(wanted.value.hashes)
        total = np.zeros(len(hashes), np.int64)
        for b in batches:
            for terms, dfs in zip(b["terms"], b["dfs"]):
                terms, dfs = np.frombuffer(terms, np.uint64), np.frombuffer(dfs, np.int64)
                at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
                hit = terms[at] == hashes
                total[hit] += dfs[at[hit]]
        yield pd.DataFrame({"term": hashes.view(np.int64), "df": total})
    return run


def _found(item: np.ndarray, doc: np.ndarray, block, **more) -> pd.DataFrame:
    ids = pd.array(np.frombuffer(block.doc_ids, np.int64)[doc], "Int64")
    ids[np.frombuffer(block.no_id, bool)[doc]] = pd.NA
    return pd.DataFrame({"item": item, "doc_id": ids, "row_hash": np.frombuffer(block.row_hashes, np.int64)[doc], **more})


def _best_bounds(queries, k: int):
    """The k best bounds of each item among a task's documents."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, held = queries.value, None
        least = np.zeros(len(q.item_ids), np.int64)
        for b in batches:
            for block in b.itertuples(index=False):
                bound = q.bounds(block)
                item, doc = np.nonzero(bound > least[:, None])
                new = _found(item, doc, block, bound=bound[item, doc])
                held = new if held is None else pd.concat([held, new])
                held = held.sort_values(["item", "bound"], ascending=[True, False], kind="stable").groupby("item").head(k)
                full = held.groupby("item")["bound"].agg(["size", "min"])
                full = full[full["size"] == k]
                least[full.index.to_numpy()] = full["min"].to_numpy()
        if held is not None:
            yield held
    return run


def _not_excluded(queries, places):
    """(item, document) pairs whose bound doesn't fall short of the item's tenth place."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q, (score, doc_id) = queries.value, places.value
        for b in batches:
            for block in b.itertuples(index=False):
                bound = q.bounds(block)
                ids = np.where(np.frombuffer(block.no_id, bool), np.iinfo(np.int64).max, np.frombuffer(block.doc_ids, np.int64))
                item, doc = np.nonzero((bound > score[:, None]) | ((bound == score[:, None]) & (ids <= doc_id[:, None])))
                if len(item):
                    yield _found(item, doc, block)
    return run


def _exact(queries):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        q = queries.value
        for b in by_text_size(batches, "text"):
            out = []
            for doc_id, text, items in zip(b["doc_id"].astype("Int64"), b["text"], b["items"]):
                terms = terms_of(text)
                have = Counter(terms)
                out += [(i, doc_id, s) for i in items if (s := q.score(i, have, len(terms))) > 0]
            yield pd.DataFrame(out, columns=["item", "doc_id", "score"]).astype({"doc_id": "Int64"})
    return run


def _scored(docs: DataFrame, pairs: DataFrame, queries, k: int) -> DataFrame:
    """The k best exact scores of each item among ``pairs(item, doc_id, row_hash)``."""
    spark = docs.sparkSession
    wanted = written(pairs.distinct().groupBy("doc_id", "row_hash").agg(F.collect_list("item").alias("items")), "candidates")
    keys = checked_broadcast(wanted.select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash")))
    on = lambda d, r: F.col("doc_id").eqNullSafe(F.col(d)) & (F.col("row_hash") == F.col(r))
    held = _rows(docs).join(keys, on("_id", "_hash"), "left_semi")
    held = held.join(wanted.select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash"), "items"), on("_id", "_hash"))
    scores = written(map_batches(held.select("doc_id", "text", "items"), _exact(queries), "item int, doc_id long, score long"),
                     "scores")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    out = top_k_per_group(scores, ["item"], order, k)
    ids = spark.createDataFrame(list(enumerate(queries.value.item_ids)), "item int, item_id long")
    return written(out.join(F.broadcast(ids), "item"), "ranked")


def _search(index: DataFrame, docs: DataFrame, items: list[tuple[int | None, str]], k: int) -> DataFrame:
    context = docs.sparkSession.sparkContext
    q = Queries(items)
    total = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("t")).first()
    if q.terms and total.n:
        counts = map_batches(index.where("terms IS NOT NULL").select("terms", "dfs"), _frequencies(context.broadcast(q)),
                             "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
        q.weigh(total.n, total.t, {r.term: r.df for r in counts.collect()})  # one row per term of the items
    blocks = index.where("width IS NOT NULL" if q.terms and total.n else "false").drop("terms", "dfs")
    queries = context.broadcast(q)
    pair = "item int, doc_id long, row_hash long"
    bounds = map_batches(blocks, _best_bounds(queries, k), f"{pair}, bound long")
    first = top_k_per_group(bounds, ["item"], [F.col("bound").desc(), F.col("doc_id").asc_nulls_last(), F.col("row_hash")], k)
    tenth = _scored(docs, first.select("item", "doc_id", "row_hash"), queries, k).where(F.col("rank") == k)
    score, doc_id = np.ones(len(items), np.int64), np.full(len(items), np.iinfo(np.int64).max)
    for r in tenth.collect():  # at most one row per item
        score[r["item"]] = r.score
        if r.doc_id is not None:
            doc_id[r["item"]] = r.doc_id
    pairs = map_batches(blocks, _not_excluded(queries, context.broadcast((score, doc_id))), pair)
    return _scored(docs, pairs, queries, k).select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The ``k`` best documents for every item: ``item_id, rank, doc_id, score``, scores above 0 alone.

    ``docs(doc_id, text)``, ``items(item_id, text)``; other columns are
    ignored. Every row of ``docs`` is a document, rows that share a doc_id or
    a text too; equal scores go by ascending doc_id, null last. Equal rows of
    ``items`` count once; rows that share an item_id but not the text are
    ranked each by itself. Null and empty texts, and texts without a term,
    match nothing. Items are searched in groups of ``QUERY_TERMS`` terms,
    each against all documents. Empty tables give no rows. Corpus terms are
    told apart by 64 hash bits in document frequencies and exactly in scores.
    """
    spark = docs.sparkSession
    path = scratch_dir(spark, "lexical")
    write_index(docs, path)
    index = spark.read.schema(INDEX).parquet(path)
    out, group, size = None, [], 0
    for r in items.select("item_id", "text").where("text IS NOT NULL").distinct().toLocalIterator():
        group.append((r.item_id, r.text))
        size += len(terms_of(r.text))
        if size >= QUERY_TERMS:
            found = _search(index, docs, group, k)
            out, group, size = found if out is None else out.unionByName(found), [], 0
    if group:
        found = _search(index, docs, group, k)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
