"""Near duplicates by improved consistent weighted sampling over TF-IDF shingles.

1. One pass over all texts sums a two-row count-min sketch of document
   frequencies. Its width is fixed against the clip of the IDF: a shingle in
   less than ``RARE`` of all documents has the largest IDF whatever its exact
   frequency, and the sketch's error (shingles per document / width, as a
   share of the documents) stays below that clip at every corpus size.
2. A second pass draws ``BANDS * ROWS`` weighted samples per text (ICWS: for
   a sample k every shingle has fixed draws r, c, beta; the shingle with the
   least c / (y e^r), y = e^(r (t - beta)), t = floor(ln w / r + beta), is the
   sample, identified by shingle and t). Equal texts share one node.
3. Rows of samples form bands. In a bucket every member is a candidate of the
   bucket's smallest node and verified by the exact weighted Jaccard similarity
   of their whole texts.
4. Members not linked to it are compared with all members of the bucket, in
   blocks spread over tasks: first by samples, then those with a candidate left
   exactly, in the same blocks. A pair is looked at in the first band it shares
   and only while its ends are in different classes, so a block gives at most
   one link for each class it joins; its pairs are never rows.
5. Links are joined into classes by connected components.

The weight of a shingle is tf * idf, idf = 1 + DAMPING * ln(1 / p) / ln(1 / RARE)
with p = max(df / N, RARE): IDF damped to a range of 1 to 1 + DAMPING. Plain
IDF would sink pairs of a large group of near copies, whose common shingles
are frequent just because the group is large.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import connected_components
from tessera.llm.shared import by_text_size, map_batches, map_slices, written
from tessera.llm.shingles import mix, weighted_sets
from tessera.operators.joins import checked_broadcast

THRESHOLD = 0.8
#: 1 - (1 - 0.8 ** 3) ** 12 = 0.9998 of pairs at the threshold share a band.
BANDS, ROWS = 12, 3
DAMPING = 0.1
RARE = 1e-3
SKETCH_BITS = 21
#: Share of equal samples below which a candidate isn't verified: at similarity 0.8 fewer than
#: half of 36 samples agree in 2 of 100,000 pairs.
PRECHECK = 0.5
BLOCK = 512
#: Bytes of text that a block holds on average, at most.
BLOCK_BYTES = 1 << 22
#: Partners of one text that are compared with it at a time.
AT_ONCE = 128
#: Characters of text hashed at a time, at some 40 bytes each.
BATCH = 1 << 19
#: Rows of digests and ids that may be broadcast: some ten MB.
FEW = 100_000
DRAWS = 1 << 16


def _sketch_rows(bits: int):
    """Per task: count-min rows of the document frequencies of its texts, and its number of texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, n = np.zeros((2, 1 << bits), np.uint32), 0
        low = np.uint64((1 << bits) - 1)
        for b in by_text_size(batches, "text", BATCH):
            s, _, _ = weighted_sets(b["text"].fillna("").tolist())
            n += len(b)
            for row, shift in zip(rows, (0, bits), strict=True):
                row += np.bincount(((s >> np.uint64(shift)) & low).astype(np.int64),
                                   minlength=1 << bits).astype(np.uint32)
        if n:
            yield pd.DataFrame({"n": [n], "sketch": [zlib.compress(rows.tobytes(), 1)]})
    return run


def idf_levels(docs: DataFrame, bits: int = SKETCH_BITS, damping: float = DAMPING, rare: float = RARE) -> np.ndarray:
    """Damped IDF per sketch cell (2 x 2**bits float32), from all documents.

    The merged sketch has a fixed size (16 MB of counters), whatever the
    corpus; partial sums are merged in a tree on the executors.
    """
    def add(x: tuple, y: tuple) -> tuple:
        total = np.frombuffer(zlib.decompress(x[1]), np.uint32).astype(np.uint64)
        total += np.frombuffer(zlib.decompress(y[1]), np.uint32)
        return x[0] + y[0], zlib.compress(np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes(), 1)

    parts = map_slices(docs.select("text"), _sketch_rows(bits), "n long, sketch binary")
    zero = (0, zlib.compress(np.zeros((2, 1 << bits), np.uint32).tobytes(), 1))
    n, blob = parts.rdd.map(lambda r: (r[0], bytes(r[1]))).treeAggregate(zero, add, add, 3)
    df = np.frombuffer(zlib.decompress(blob), np.uint32).reshape(2, -1)
    share = np.maximum(df / max(n, 1), rare)
    return (1 + damping * np.log(1 / np.minimum(share, 1)) / np.log(1 / rare)).astype(np.float32)


def weights(shingles: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """tf * idf; the sketch's smaller frequency (larger IDF) of the two rows holds."""
    bits = int(idf.shape[1]).bit_length() - 1
    low = np.uint64(idf.shape[1] - 1)
    first = idf[0][(shingles & low).astype(np.int64)]
    second = idf[1][((shingles >> np.uint64(bits)) & low).astype(np.int64)]
    return counts * np.maximum(first, second)


class Sampler:
    """ICWS with its Gamma(2, 1) and uniform draws in seeded tables, looked up by 16 bits of the shingle's hash.

    Shingles that share an entry are told apart by 32 more hash bits, also in
    a sample's identity.
    """

    def __init__(self, samples: int = BANDS * ROWS, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.r = rng.gamma(2.0, 1.0, (samples, DRAWS)).astype(np.float32)
        self.ln_c = np.log(rng.gamma(2.0, 1.0, (samples, DRAWS))).astype(np.float32)
        self.beta = rng.random((samples, DRAWS)).astype(np.float32)
        self.odd = mix(np.arange(1, 2 * samples + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)

    def signature(self, shingles: np.ndarray, weight: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """One row of 32-bit samples per text; ``starts``: where each text's shingles begin."""
        out = np.empty((len(starts), len(self.r)), np.uint32)
        ln_w = np.log(weight).astype(np.float32)
        for k in range(len(self.r)):
            at = ((shingles * self.odd[2 * k]) >> np.uint64(48)).astype(np.int64)
            r, beta = self.r[k][at], self.beta[k][at]
            t = np.floor(ln_w / r + beta)
            ln_a = self.ln_c[k][at] - r * (t - beta + np.float32(1))
            sign = ln_a.view(np.uint32)
            order = np.where(sign >> np.uint32(31), ~sign, sign | np.uint32(0x80000000)).astype(np.uint64)
            order = (order << np.uint64(32)) | ((shingles * self.odd[2 * k + 1]) >> np.uint64(32))
            out[:, k] = mix(np.minimum.reduceat(order, starts)) >> np.uint64(32)
        return out


def _signatures(idf, samples: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sampler, table = Sampler(samples), np.frombuffer(idf.value, np.float32).reshape(2, -1)
        for b in by_text_size(batches, "text", BATCH):
            s, count, owner = weighted_sets(b["text"].fillna("").tolist())
            sig: list = [None] * len(b)
            if len(s):
                starts = np.flatnonzero(np.diff(owner, prepend=-1))
                rows = sampler.signature(s, weights(s, count, table), starts)
                for i, row in zip(owner[starts], rows.view(np.int32), strict=True):
                    sig[i] = row
            yield pd.DataFrame({"doc_id": b["doc_id"], "node": b["node"], "sig": sig, "bytes": b["text"].str.len()})
    return run


def _groups(batches: Iterator[pd.DataFrame], keys: list[str], prepare=lambda b: b) -> Iterator[pd.DataFrame]:
    """Runs of equal ``keys`` of sorted rows, each as one frame; ``prepare`` sees every batch first."""
    held: list[pd.DataFrame] = []
    now = None
    for b in batches:
        b = prepare(b)
        values = [b[k].to_numpy() for k in keys]
        cut = np.flatnonzero(np.append(True, np.any([v[1:] != v[:-1] for v in values], axis=0))) if len(b) else ()
        for s, e in zip(cut, [*cut[1:], len(b)], strict=True):
            part = b.iloc[s:e]
            key = tuple(v[s] for v in values)
            if key != now and held:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            now = key
            held.append(part)
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _open_pairs(x: pd.DataFrame, y: pd.DataFrame, rows: int, least: int) -> np.ndarray:
    """Pairs of residuals ``x`` and members ``y`` of a bucket that this block has to decide.

    ``least`` equal samples, different components, no earlier band in common;
    two residuals meet twice and count where the smaller node is the residual.
    """
    sx, sy = np.stack(x["sig"].to_numpy()), np.stack(y["sig"].to_numpy())
    same = np.zeros((len(x), len(y)), np.uint8)
    earlier, band = np.zeros((len(x), len(y)), bool), int(x["band"].iloc[0])
    for b in range(sx.shape[1] // rows):
        equal = np.ones((len(x), len(y)), bool)
        for k in range(b * rows, (b + 1) * rows):
            one = sx[:, k, None] == sy[None, :, k]
            same += one
            if b < band:
                equal &= one
        if b < band:
            earlier |= equal
    nx, ny = x["node"].to_numpy(str), y["node"].to_numpy(str)
    once = ~y["left"].to_numpy(bool)[None, :] | (nx[:, None] < ny[None, :])
    apart = x["component"].to_numpy()[:, None] != y["component"].to_numpy()[None, :]
    return (same >= least) & apart & once & ~earlier


def _with_candidates(rows: int, least: int):
    """Rows of a block that have a candidate in it; sorted by block."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for g in _groups(batches, ["bucket", "i", "j"]):
            x, y = g[g["residual"]], g[~g["residual"]]
            if len(x) and len(y):
                pairs = _open_pairs(x, y, rows, least)
                yield pd.concat([x[pairs.any(axis=1)], y[pairs.any(axis=0)]])
    return run


def _block_links(idf, rows: int, least: int, threshold: float):
    """Links between components of a block's rows, by exact similarity: at most one for each two that it joins."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.frombuffer(idf.value, np.float32).reshape(2, -1)

        def as_sets(b: pd.DataFrame) -> pd.DataFrame:
            s, count, owner = weighted_sets(b["text"].tolist())
            w = weights(s, count, table)
            edge = np.searchsorted(owner, np.arange(len(b) + 1))
            cut = list(zip(edge[:-1], edge[1:]))
            return b.drop(columns="text").assign(shingles=[s[p:q].copy() for p, q in cut], weights=[w[p:q].copy() for p, q in cut])

        pieces = (as_sets(b) for b in by_text_size(batches, "text", BATCH))
        for g in _groups(pieces, ["bucket", "i", "j"]):
            x, y = g[g["residual"]], g[~g["residual"]]
            if not len(x) or not len(y):
                continue
            pairs = _open_pairs(x, y, rows, least)
            words, place = np.unique(np.concatenate([*x["shingles"], *y["shingles"]]), return_inverse=True)
            sizes = [len(v) for v in [*x["shingles"], *y["shingles"]]]
            places = np.split(place, np.cumsum(sizes)[:-1])
            held = [*x["weights"], *y["weights"]]
            total = np.array([v.sum() for v in held])
            component = np.array([*x["component"], *y["component"]])
            nodes, out = [*x["node"], *y["node"]], []
            own = np.zeros(len(words))
            for i in range(len(x)):
                own[places[i]] = held[i]
                partners = len(x) + np.flatnonzero(pairs[i])
                for s in range(0, len(partners), AT_ONCE):
                    part = partners[s:s + AT_ONCE]
                    part = part[component[part] != component[i]]
                    if not len(part):
                        continue
                    at = np.concatenate([places[k] for k in part])
                    both = np.add.reduceat(np.minimum(own[at], np.concatenate([held[k] for k in part])),
                                           np.cumsum([0, *(len(places[k]) for k in part[:-1])]))
                    similar = both / (total[i] + total[part] - both)
                    for k, sim in zip(part[similar >= threshold], similar[similar >= threshold]):
                        if component[k] != component[i]:
                            out.append((nodes[i], nodes[k], float(sim)))
                            component[component == component[k]] = component[i]
                own[places[i]] = 0
            yield pd.DataFrame(out, columns=["a", "b", "similarity"])
    return run


def _verify(idf, threshold: float):
    """Exact weighted Jaccard of a centre with the members that follow it; rows come sorted by (a, salt, member)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = np.frombuffer(idf.value, np.float32).reshape(2, -1)
        centre, centre_key = None, None
        for b in by_text_size(batches, "text", BATCH):
            s, count, owner = weighted_sets(b["text"].tolist())
            w = weights(s, count, table)
            edge = np.searchsorted(owner, np.arange(len(b) + 1))
            out = []
            for i, (a, salt, member, node) in enumerate(zip(b["a"], b["salt"], b["member"], b["node"], strict=True)):
                own, own_w = s[edge[i]:edge[i + 1]], w[edge[i]:edge[i + 1]]
                if not member:
                    centre, centre_key = (own, own_w, own_w.sum()), (a, salt)
                    continue
                if centre_key != (a, salt):
                    raise RuntimeError("a member came without its centre")
                _, x, y = np.intersect1d(centre[0], own, assume_unique=True, return_indices=True)
                both = np.minimum(centre[1][x], own_w[y]).sum()
                sim = both / (centre[2] + own_w.sum() - both)
                if sim >= threshold:
                    out.append((a, node, float(sim)))
            yield pd.DataFrame(out, columns=["a", "b", "similarity"])
    return run


def with_text(rows: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows(node, ...)`` with the text of each node; only texts that are wanted are shuffled if those are few."""
    wanted = written(rows.select(F.col("node").alias("t_node")).distinct()
                     .join(nodes.select(F.col("node").alias("t_node"), F.col("rep").alias("t_rep")), "t_node"), "wanted")
    held = texts.join(checked_broadcast(wanted, FEW),
                      (F.col("node") == F.col("t_node")) & F.col("doc_id").eqNullSafe(F.col("t_rep"))).select("t_node", "text")
    return rows.join(held, F.col("node") == F.col("t_node")).drop("t_node")


def verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """Those of ``pairs(a, b)`` whose texts reach the threshold.

    Members meet their centre in groups of 64: a hot centre's text is copied
    to many tasks instead of gathering its members in one.
    """
    sized = pairs.join(pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 64).alias("_n")), "a")
    salted = sized.select("a", F.pmod(F.xxhash64("b"), "_n").alias("salt"), "b")
    ends = written(salted.select("a", "salt", F.lit(True).alias("member"), F.col("b").alias("node"))
                   .unionByName(salted.select("a", "salt", F.lit(False).alias("member"), F.col("a").alias("node")).distinct()), "ends")
    rows = (with_text(ends, nodes, texts).select("a", "salt", "member", "node", "text")
            .repartition("a", "salt").sortWithinPartitions("a", "salt", "member", "node"))
    out = map_slices(rows, _verify(idf, threshold), "a string, b string, similarity double")
    return out.groupBy("a", "b").agg(F.max("similarity").alias("similarity"))


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                           damping: float = DAMPING) -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (the smallest doc_id of its class), ``class_size``.

    Two texts are linked if the weighted Jaccard similarity of their five-word
    shingles reaches ``threshold`` (or if they are equal); classes are the
    connected components. A null text or one without a word is a class of its
    own row (class_id = doc_id). A null doc_id gets the smallest doc_id of its
    class, null if there is none. Repeated rows are rows of one class; rows
    that share a doc_id but not the text are classed by their own texts. Only
    ``doc_id`` and ``text`` are read, whatever other columns there are. An
    empty table gives no rows.
    """
    labelled, _, _ = classes_by_text(docs, threshold, bands, rows, damping)
    return labelled.select("doc_id", "class_id", "class_size")


def with_node(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``node``: the text's digest; null for texts without a word."""
    has_word = F.lower("text").rlike(r"[0-9a-z]|[^\x00-\x7F]")
    return docs.select("doc_id", "text", F.when(has_word, F.md5(F.encode("text", "UTF-8"))).alias("node"))


def classes_by_text(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    damping: float = DAMPING) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``near_duplicate_classes`` with the text's digest (``node``), the verified links and the nodes."""
    spark, samples = docs.sparkSession, bands * rows
    texts = with_node(docs.select("doc_id", "text"))
    idf = spark.sparkContext.broadcast(idf_levels(docs, damping=damping).tobytes())
    drawn = map_slices(texts.where(F.col("node").isNotNull()), _signatures(idf, samples),
                        "doc_id long, node string, sig array<int>, bytes long")
    nodes = written(drawn.groupBy("node").agg(F.min("doc_id").alias("rep"), F.any_value("sig").alias("sig"),
                                              F.max("bytes").alias("bytes"), F.count(F.lit(1)).alias("n_rows")), "nodes")

    in_band = nodes.select("node", F.posexplode(F.array(*[
        F.xxhash64(F.lit(b), *[F.col("sig")[b * rows + i] for i in range(rows)]) for b in range(bands)])))
    member = in_band.select("node", F.col("pos").alias("band"), F.col("col").alias("bucket"))
    buckets = (member.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("centre"))
               .where("size > 1"))
    member = written(member.join(buckets, "bucket").where("node <> centre"), "members")

    least = int(np.ceil(PRECHECK * samples))
    star = member.select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    x, y = nodes.select(F.col("node").alias("a"), F.col("sig").alias("sx")), \
        nodes.select(F.col("node").alias("b"), F.col("sig").alias("sy"))
    same = F.size(F.filter(F.zip_with("sx", "sy", lambda p, q: p == q), lambda e: e))
    star = star.join(y, "b").join(x, "a").where(same >= least).select("a", "b")
    linked = written(verified(star, nodes, texts, idf, threshold), "linked")
    # what is already in one class needs no further link
    joined = written(connected_components(linked.select("a", "b")), "joined")

    # members that aren't linked to their bucket's centre meet all members of the bucket, in blocks
    to_centre = linked.select(F.col("a").alias("centre"), F.col("b").alias("node"), F.lit(False).alias("left"))
    member = member.join(to_centre, ["centre", "node"], "left").select(
        "bucket", "band", "node", F.coalesce("left", F.lit(True)).alias("left"))
    member = written(member.join(nodes.select("node", "bytes"), "node").join(joined, "node", "left").withColumn(
        "component", F.xxhash64(F.coalesce("component", "node"))), "placed")
    blocks = lambda n, b: F.ceil(F.greatest(F.sum(n) / BLOCK, F.sum(b) / BLOCK_BYTES)).cast("int")
    left = F.col("left").cast("int")
    counts = (member.groupBy("bucket").agg(blocks(left, left * F.col("bytes")).alias("n_left"),
                                           blocks(F.lit(1), F.col("bytes")).alias("n_all"),
                                           F.min("component").alias("low"), F.max("component").alias("high"))
              .where("n_left > 0 AND low <> high").drop("low", "high"))
    block_of = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    sized = member.join(counts, "bucket")
    side = (sized.where("left").select("bucket", "band", "node", "left", "component", F.lit(True).alias("residual"),
                                       block_of("n_left").alias("i"), every("n_all").alias("j"))
            .unionByName(sized.select("bucket", "band", "node", "left", "component", F.lit(False).alias("residual"),
                                      every("n_left").alias("i"), block_of("n_all").alias("j"))))
    block = ["bucket", "i", "j"]
    side = side.join(nodes.select("node", "sig"), "node").repartition(*block).sortWithinPartitions(*block)
    schema = "node string, bucket long, band int, left boolean, component long, residual boolean, i int, j int, sig array<int>"
    side = written(map_batches(side, _with_candidates(rows, least), schema), "open")
    side = with_text(side, nodes, texts).repartition(*block).sortWithinPartitions(*block)
    more = written(map_slices(side, _block_links(idf, rows, least, threshold), "a string, b string, similarity double"), "more")
    links = linked.select("a", "b").unionByName(more.select("a", "b"))

    # the later links join classes of the first ones
    first = nodes.join(joined, "node", "left").select("node", "rep", "n_rows", F.coalesce("component", "node").alias("first"))
    ends = [first.select(F.col("node").alias(e), F.col("first").alias(f"{e}_first")) for e in ("a", "b")]
    between = more.select("a", "b").join(ends[0], "a").join(ends[1], "b").select(
        F.col("a_first").alias("a"), F.col("b_first").alias("b"))
    again = connected_components(between).withColumnRenamed("node", "first")
    classed = first.join(again, "first", "left").select("node", "rep", "n_rows", F.coalesce("component", "first").alias("component"))
    least_row = F.min(F.struct(F.col("rep").isNull().alias("none"), "rep", "node"))
    of_class = classed.groupBy("component").agg(least_row.alias("m"), F.sum("n_rows").alias("class_size"))
    classed = written(classed.join(of_class, "component").select(
        "node", F.col("m.rep").alias("class_id"), "class_size", (F.col("node") == F.col("m.node")).alias("keeps")), "classes")
    labelled = texts.select("doc_id", "node").join(classed, "node", "left").select(
        "doc_id", "node", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("class_size", F.lit(1)).cast("long").alias("class_size"), F.coalesce("keeps", F.lit(True)).alias("keeps"))
    return labelled, links, nodes


def one_of_each(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with one document of each near-duplicate class: the one with the smallest doc_id.

    All columns stay. A null doc_id comes after all others; among equal ids
    the smaller text digest decides, and of repeated rows with that doc_id and
    text one stays. Documents without a word are kept.
    """
    labelled, _, _ = classes_by_text(docs, **parameters)
    worded = labelled.where(F.col("node").isNotNull())
    stays = F.col("keeps") & F.col("doc_id").eqNullSafe(F.col("class_id"))
    out = written(worded.where(~stays).select("doc_id", "node").distinct(), "removed")
    repeated = written(worded.where(stays).groupBy("doc_id", "node").count().where("count > 1").select("doc_id", "node"), "repeated")
    node = F.md5(F.encode("text", "UTF-8"))
    match = lambda r: node.eqNullSafe(r["node"]) & docs["doc_id"].eqNullSafe(r["doc_id"])
    kept = docs.join(checked_broadcast(out, FEW), match(out), "left_anti")
    if repeated.isEmpty():
        return kept
    single = kept.join(checked_broadcast(repeated, FEW), match(repeated), "left_anti")
    again = kept.join(checked_broadcast(repeated, FEW), match(repeated), "left_semi")
    return single.unionByName(again.dropDuplicates(["doc_id", "text"]))
