"""Near duplicates by SimHash fingerprints, found through Golay-code keys.

A fingerprint is cut into five segments. Of at most three differing bits at
least two segments hold none, and the other three, put together and halved,
have a half with at most one (pigeonhole). The two equal segments are one
part of a key; the other part is made of that half by decoding it in the
perfect binary Golay code (23, 12, 7), every word of which lies within three
bits of exactly one codeword. Two halves that differ in one bit decode alike,
or both lie three bits from their own codeword and four from the other's. So
a word three bits off also takes the five codewords at distance four as keys:
six keys instead of one. As halves that differ in one bit differ in parity,
only those of even weight need the extra keys. All ten pairs of segments and
both halves give about 63 keys of 38 bits a fingerprint, and every pair
within three bits shares one of them.

Fingerprints that meet under a key are compared exactly; a bucket gives a
spanning forest of its links, never its pairs. Buckets above ``BLOCK``
fingerprints are set aside, unread, and compared block against block, spread
over tasks. Only distinct fingerprints are keyed, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.components import connected_components
from tessera.llm.shared import by_text_size, map_batches, written

SEED = 42
SHINGLE = 3
BITS = 3
WIDTHS = (13, 13, 13, 13, 12)
#: Fixed value: generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1 of the Golay code.
GENERATOR = 0xC75
BLOCK = 4096
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str) -> int:
    """64-bit SimHash of the 3-word shingles of a text, A-Z lower-cased; 0 without a word."""
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # at the ASCII white space of the contract
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - SHINGLE + 1)
    starts, ends = starts[:n].tolist(), ends[-n:].tolist()
    ones = np.zeros(64, np.int64)
    for s in range(0, n, SHINGLES_AT_ONCE):
        cut = map(joined.__getitem__, map(slice, starts[s:s + SHINGLES_AT_ONCE], ends[s:s + SHINGLES_AT_ONCE]))
        h = np.fromiter(map(xxh64_intdigest, cut, repeat(SEED)), "<u8", min(SHINGLES_AT_ONCE, n - s))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(k) for k in np.flatnonzero(2 * ones > n)))


def _fingerprints(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in by_text_size(batches, "text"):
        found = np.array([fingerprint(t) for t in b["text"].fillna("")], np.uint64)
        yield pd.DataFrame({"doc_id": b["doc_id"], "fp": found.view(np.int64)})


def _remainder(v: int) -> int:
    """Remainder of a 23-bit polynomial divided by the generator."""
    for k in range(22, 10, -1):
        if v >> k & 1:
            v ^= GENERATOR << (k - 11)
    return v


class Golay:
    """Decoding tables of the Golay code, by the 11-bit remainder of a word."""

    def __init__(self):
        one = [_remainder(1 << k) for k in range(23)]
        self.of_byte = np.zeros((3, 256), np.uint16)
        for part in range(3):
            for byte in range(256):
                bits = [one[8 * part + k] for k in range(8) if byte >> k & 1 and 8 * part + k < 23]
                self.of_byte[part, byte] = np.bitwise_xor.reduce(bits) if bits else 0
        self.error = np.zeros(2048, np.int64)
        far: list[list[int]] = [[] for _ in range(2048)]
        for weight in range(1, 5):
            for places in combinations(range(23), weight):
                s = int(np.bitwise_xor.reduce([one[k] for k in places]))
                pattern = sum(1 << k for k in places)
                if weight < 4:
                    self.error[s] = pattern
                else:
                    far[s].append(pattern)
        self.is_far = np.bitwise_count(self.error) == 3
        self.far = np.array([x if len(x) == 5 else [0] * 5 for x in far], np.int64)  # five for every remainder that is far

    def keys(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """12-bit index of each word's codeword; then the places of words with more keys, and their five each."""
        w = words.astype(np.int64)
        s = self.of_byte[0, w & 255] ^ self.of_byte[1, (w >> 8) & 255] ^ self.of_byte[2, w >> 16]
        more = np.flatnonzero(self.is_far[s] & (np.bitwise_count(w) % 2 == 0))
        return (w ^ self.error[s]) >> 11, more, (w[more, None] ^ self.far[s[more]]) >> 11


def fingerprint_keys(fp: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """``(key, index of the fingerprint)`` of unsigned 64-bit fingerprints."""
    parts, at = [], 0
    for width in WIDTHS:
        parts.append(((fp >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64))
        at += width
    keys, owner, every = [], [], np.arange(len(fp))
    for kind, (i, j) in enumerate(combinations(range(len(WIDTHS)), 2)):
        same = (np.int64(kind) << 26) | (parts[i] << 13) | parts[j]
        rest, at = np.zeros(len(fp), np.int64), 0
        for k in set(range(len(WIDTHS))) - {i, j}:
            rest |= parts[k] << at
            at += WIDTHS[k]
        for half, word in enumerate((rest & ((1 << 19) - 1), rest >> 19)):
            index, more, far = golay.keys(word)
            front = ((same << 1) | half) << 12
            keys += [front | index, (front[more, None] | far).ravel()]
            owner += [every, np.repeat(more, far.shape[1])]
    return np.concatenate(keys), np.concatenate(owner)


def _keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    golay = Golay()
    for b in batches:
        fp = b["fp"].to_numpy(np.int64)
        key, owner = fingerprint_keys(fp.view(np.uint64), golay)
        yield pd.DataFrame({"key": key, "fp": fp[owner]})


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of signed 64-bit fingerprints."""
    return np.bitwise_count((a ^ b).view(np.uint64))  # of signed numbers numpy counts the bits of the absolute value


def forest(fp: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Links that span the components of distinct fingerprints under distances of at most ``bits``."""
    left, out = fp, []
    while len(left) > 1:
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            v = queue.pop()
            near = distance(left, v) <= bits
            if near.any():
                found = left[near]
                left = left[~near]
                queue.extend(found)
                out.extend((int(v), int(x)) for x in found)
    return out


def _linked(bits: int, block: int):
    """Links of the buckets of rows sorted by key; rows of a bucket above ``block`` come out as they are, numbered."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_key, held_fp = np.empty(0, np.int64), np.empty(0, np.int64)
        aside, seen = None, 0

        def links(keys: np.ndarray, fps: np.ndarray) -> pd.DataFrame:
            edge = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
            size = np.diff(edge, append=len(keys))
            two = edge[size == 2]
            near = two[distance(fps[two], fps[two + 1]) <= bits]
            out = list(zip(fps[near].tolist(), fps[near + 1].tolist()))
            for s, n in zip(edge[size > 2], size[size > 2]):
                out += forest(fps[s:s + n], bits)
            out = sorted(set(out))
            return pd.DataFrame({"key": pd.array([pd.NA] * len(out), "Int64"), "a": np.array([x for x, _ in out], np.int64),
                                 "b": np.array([y for _, y in out], np.int64)})

        def unread(fps: np.ndarray) -> pd.DataFrame:
            return pd.DataFrame({"key": pd.array([aside] * len(fps), "Int64"), "a": fps, "b": np.arange(seen, seen + len(fps))})

        for b in batches:
            key = np.concatenate([held_key, b["key"].to_numpy(np.int64)])
            fp = np.concatenate([held_fp, b["fp"].to_numpy(np.int64)])
            if aside is not None:  # the bucket that was set aside goes on
                n = int(np.searchsorted(key, aside, "right"))
                if n:
                    yield unread(fp[:n])
                    seen, key, fp = seen + n, key[n:], fp[n:]
                if len(key):
                    aside = None
            if not len(key):
                held_key, held_fp = key, fp
                continue
            last = int(np.searchsorted(key, key[-1], "left"))
            if last:
                yield links(key[:last], fp[:last])
            held_key, held_fp = key[last:], fp[last:]
            if len(held_key) > block:
                aside, seen = int(held_key[0]), 0
                yield unread(held_fp)
                seen, held_key, held_fp = len(held_fp), held_key[:0], held_fp[:0]
        if len(held_key):
            yield links(held_key, held_fp)
    return run


def _block_links(bits: int):
    """Links of pairs of blocks (key, i, j); rows come sorted by them."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []

        def links() -> pd.DataFrame:
            out = forest(np.unique(np.concatenate(held)), bits)
            return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)

        for b in batches:
            for at, part in b.groupby(["key", "i", "j"], sort=False):
                if at != now and held:
                    yield links()
                    held = []
                now = at
                held.append(part["fp"].to_numpy(np.int64))
        if held:
            yield links()
    return run


def links(fps: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: links that span the components of distinct fingerprints ``fps(fp)``, all exact.

    A bucket of n fingerprints is compared in n / ``block`` squared pairs of
    blocks, each one small task's work, and gives less than n links for each.
    """
    if not 0 <= bits <= BITS:
        raise ValueError(f"the keys find up to {BITS} bits")
    keyed = map_batches(fps.select("fp"), _keyed, "key long, fp long")
    found = written(map_batches(keyed.repartition("key").sortWithinPartitions("key"), _linked(bits, block),
                                "key long, a long, b long"), "links")
    plain = found.where("key IS NULL").select("a", "b")
    aside = found.where("key IS NOT NULL").select("key", F.col("a").alias("fp"), F.floor(F.col("b") / block).alias("block"))
    if aside.isEmpty():
        return plain
    blocks = aside.groupBy("key").agg((F.max("block") + 1).alias("blocks"))
    pairs = (aside.join(blocks, "key")
             .select("key", "fp", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
             .select("key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "fp")
             .repartition("key", "i", "j").sortWithinPartitions("key", "i", "j"))
    return plain.unionByName(map_batches(pairs, _block_links(bits), "a long, b long"))


def components(docs: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (16 hex digits), ``component_id``.

    Documents whose fingerprints differ in at most ``bits`` bits are linked;
    ``component_id`` is the smallest doc_id reachable, itself included. Null
    and empty texts and those without a word have the fingerprint 0 and are
    linked like any other. A null doc_id counts for no minimum: a component of
    such rows alone has a null id. Repeated rows come out as often as they go
    in; rows that share a doc_id are linked by their own texts. Only
    ``doc_id`` and ``text`` are read, whatever other columns there are; an
    empty table gives no rows. A text is held whole by its task.
    """
    prints = written(map_batches(docs.select("doc_id", "text"), _fingerprints, "doc_id long, fp long"), "fingerprints")
    first = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    reach = connected_components(links(first, bits, block)).withColumnRenamed("node", "fp")
    least = reach.join(first, "fp").groupBy("component").agg(F.min("first").alias("least"))
    joined = reach.join(least, "component").select("fp", "least", F.lit(True).alias("joined"))
    ids = first.join(joined, "fp", "left").select("fp", F.when(F.col("joined"), F.col("least")).otherwise(F.col("first"))
                                                  .alias("component_id"))
    return prints.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
