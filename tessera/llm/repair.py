"""Token ids in Re-Pair compressed shards with random access.

Documents are dealt in doc_id order, encoded, and gathered into shards of
about ``SHARD_IDS`` ids. A shard is compressed by itself: the frequent
adjacent pairs of its symbols become nonterminals, again and again, until no
pair is frequent. Its row of the file holds the rules, the length of every
rule's expansion, the remaining symbols, and the symbol at which each
document starts, so that one document, or any range of ids, is decoded
without expanding the rest. Pairs never reach over the end of a document.

Columns of the file (Parquet; numbers as little-endian unsigned 32-bit
integers in binary columns): part, block (order of the shards), n_ids,
rules (left, right of nonterminal ``first_rule + k``), lengths, symbols,
doc_ids (signed 64-bit), is_null (one byte per document: its doc_id is null),
doc_symbols (symbols per document).
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.shared import by_text_size, joined, map_batches, packed, scratch_dir
from tessera.operators.joins import checked_broadcast

SHARD_IDS = 1 << 18
#: A pair becomes a rule if a round replaces it at least so often in its shard.
MIN_USES = 8
#: Pairs that are replaced together occur at least this share as often as the most frequent one.
ROUND_SHARE = 0.1
VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
#: Words whose ids a process keeps: about 60 MB.
WORDS = 300_000
#: Characters of text that are cut into pieces at a time.
BATCH = 1 << 22
#: Characters of whole texts, and pieces, whose tokens stand in memory as objects at a time.
WHOLE = 1 << 20
PORTION = 1000
LETTERS = "A-Za-zÀ-ÖØ-öø-ſ"
#: Characters whose class is beyond doubt; texts with others are encoded whole.
_PLAIN = re.compile(f"[\\n\\r\\t -~{LETTERS}«»¿¡–—‘’“”…]*")
#: Kinds of characters in plain texts; a text's end is a null character.
OTHER, LETTER, DIGIT, WHITE, END = range(5)
_KIND = np.zeros(1 << 16, np.uint8)
for _pattern, _kind in ((f"[{LETTERS}]", LETTER), ("[0-9]", DIGIT), (r"[ \t\n\r]", WHITE), ("\0", END)):
    _KIND[[c for c in range(0x180) if re.fullmatch(_pattern, chr(c))]] = _kind
#: Fixed value: the character by which byte-level BPE spells each byte, printable ones by themselves.
_OWN = [*range(33, 127), *range(161, 173), *range(174, 256)]
ALPHABET = "".join(chr(b if b in _OWN else 256 + sum(c not in _OWN for c in range(b))) for b in range(256))
_SPELT = np.array(list(map(ord, ALPHABET)), "<u2")
#: The low bytes of a number, by how many.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
FILE = ("part int, block int, n_ids long, first_rule long, rules binary, lengths binary, symbols binary, "
        "doc_ids binary, is_null binary, doc_symbols binary")


class Coder:
    """Ids of whole texts by a tokenizers file.

    No merge crosses the cuts that byte-level BPE makes first, so each
    distinct piece goes through the file's merges once and its ids are put
    together; beyond ``WORDS`` pieces the half most used stays. New pieces
    are merged many at a call, set apart by the character of the null byte,
    which no merge holds. A piece's row in the table of ids is found by its
    bytes: as a number if they are at most eight of Latin-1. Texts with characters outside ``_PLAIN`` or with an
    added token's string, and all texts if the file isn't of that kind, are
    encoded as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.coder = Tokenizer.from_file(path)
        self.merges = Tokenizer(self.coder.model)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        cut, model = file["pre_tokenizer"] or {}, file["model"]
        self.by_piece = (file["normalizer"] is None and model["type"] == "BPE" and not model.get("dropout")
                         and not model.get("ignore_merges") and cut.get("type") == "ByteLevel"
                         and cut.get("use_regex", True) and not cut["add_prefix_space"]
                         and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
                         and [t for t in model["vocab"] if ALPHABET[0] in t] == [ALPHABET[0]])
        self.between = self.coder.token_to_id(ALPHABET[0])
        self.added = [t["content"] for t in file["added_tokens"]]
        self.keys, self.key_rows = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.rows: dict[bytes, int] = {}
        self.start, self.count, self.uses = np.empty((3, 0), np.int64)
        self.ids = np.empty(0, np.uint32)

    def _whole(self, texts: list[str]) -> Iterator[np.ndarray]:
        size = np.cumsum([0, *map(len, texts)])
        at = 0
        while at < len(texts):
            end = max(at + 1, int(np.searchsorted(size, size[at] + WHOLE, "right")) - 1)
            for code in self.coder.encode_batch_fast(texts[at:end], add_special_tokens=False):
                yield np.array(code.ids, np.uint32)
            at = end

    def _learn(self, pieces: list[str]) -> None:
        ids = [np.empty(0, np.uint32)]
        for k in range(0, len(pieces), PORTION):
            raw = np.frombuffer(("\0".join(pieces[k:k + PORTION]) + "\0").encode(), np.uint8)
            code, = self.merges.encode_batch_fast([_SPELT[raw].tobytes().decode("utf-16-le")], add_special_tokens=False)
            ids.append(np.array(code.ids, np.uint32))
        new = np.concatenate(ids)
        apart = new == self.between
        count = np.diff(np.flatnonzero(apart), prepend=-1) - 1
        self.start = np.append(self.start, len(self.ids) + np.cumsum(count) - count)
        self.count, self.ids = np.append(self.count, count), np.append(self.ids, new[~apart])
        self.uses = np.append(self.uses, np.zeros_like(count))

    def _trim(self, n: int) -> None:
        stay = np.sort(np.argsort(-self.uses, kind="stable")[:n])
        row = np.full(len(self.uses), -1)
        row[stay] = np.arange(len(stay))
        key_rows = row[self.key_rows]
        self.keys, self.key_rows = self.keys[key_rows >= 0], key_rows[key_rows >= 0]
        self.rows = {p: k for p, k in zip(self.rows, row[list(self.rows.values())].tolist()) if k >= 0}
        self.uses = self.uses[stay] // 2
        self.start, self.count, self.ids = packed(self.start[stay], self.count[stay], self.ids)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if len(self.count) > WORDS:
            self._trim(WORDS // 2)
        plain = [self.by_piece and bool(_PLAIN.fullmatch(t)) and not any(a in t for a in self.added) for t in texts]
        whole = self._whole([t for t, p in zip(texts, plain) if not p])
        pieces = iter(self._by_piece([t for t, p in zip(texts, plain) if p]))
        return [next(pieces) if p else next(whole) for p in plain]

    def _by_piece(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        raw = ("\0".join(texts) + "\0").encode("utf-16-le")
        code = np.frombuffer(raw, "<u2")
        start = np.flatnonzero(_starts(code))
        strings = pa.Array.from_buffers(pa.large_binary(), len(start), [
            None, pa.py_buffer(2 * np.append(start, len(code))), pa.py_buffer(raw)])
        size, is_end = np.diff(start, append=len(code)), code[start] == 0
        in_key = ~is_end & (size <= 8)
        if (wide := code > 255).any():
            in_key &= ~np.logical_or.reduceat(wide, start)
        short, long = np.flatnonzero(in_key), np.flatnonzero(~is_end & ~in_key)
        narrow = np.append(code.astype(np.uint8), np.zeros(8, np.uint8))
        eight = np.ndarray(len(code), "<u8", narrow, strides=(1,))  # from every character on
        key_of, keys = pd.factorize(eight[start[short]] & _LOW[size[short]])
        key_rows = np.append(self.key_rows, -1)[pd.Index(self.keys).get_indexer(keys)]
        strings = strings.take(pa.array(long)).dictionary_encode()
        string_of, strings = strings.indices.to_numpy(), strings.dictionary.to_numpy(zero_copy_only=False).tolist()
        rows = np.fromiter(map(self.rows.get, strings, repeat(-1)), np.int64, len(strings))
        new_keys, new = np.flatnonzero(key_rows < 0), np.flatnonzero(rows < 0)
        if len(new_keys) or len(new):
            key_rows[new_keys] = len(self.count) + np.arange(len(new_keys))
            rows[new] = len(self.count) + len(new_keys) + np.arange(len(new))
            fresh = keys[new_keys]
            self.keys, self.key_rows = np.append(self.keys, fresh), np.append(self.key_rows, key_rows[new_keys])
            fresh, others = fresh.astype("<u8").view("S8").tolist(), [strings[k] for k in new.tolist()]
            self.rows.update(zip(others, rows[new].tolist()))
            self._learn(_as_text(fresh, b"\0", "latin-1") + _as_text(others, b"\0\0", "utf-16-le"))
        self.uses[key_rows] += np.bincount(key_of, minlength=len(keys))
        self.uses[rows] += np.bincount(string_of, minlength=len(strings))
        row = np.empty(len(start), np.int64)
        row[short], row[long] = key_rows[key_of], rows[string_of]
        row, ends = row[~is_end], np.flatnonzero(is_end)
        before = np.append(0, np.cumsum(self.count[row]))[ends - np.arange(len(ends))]
        return np.split(joined(self.start[row], self.count[row], self.ids), before[:-1])


def _as_text(pieces: list[bytes], between: bytes, coding: str) -> list[str]:
    return between.join(pieces).decode(coding).split("\0") if pieces else []


def _starts(code: np.ndarray) -> np.ndarray:
    """Where the pieces begin into which byte-level BPE cuts plain texts, each followed by a null character.

    These are the matches of ``'(?:s|t|re|ve|m|ll|d)| ?letters| ?digits| ?others|\\s+(?!\\S)|\\s+``.
    """
    kind = _KIND[code]
    start = kind == END
    start[0] = True
    start[1:] |= kind[1:] != kind[:-1]
    last = np.flatnonzero((kind[:-1] == WHITE) & (kind[1:] < WHITE))  # of the white space before a word
    start[last] = True
    start[last[code[last] == ord(" ")] + 1] = False
    signs = np.flatnonzero((code == ord("'")) & start)
    for ending in ("s", "t", "re", "ve", "m", "ll", "d"):
        at = signs
        for k, c in enumerate(ending, 1):
            at = at[code[at + k] == ord(c)]
        start[at + 1], start[at + 1 + len(ending)] = False, True
    return start


@lru_cache(1)
def coder_of(path: str) -> Coder:
    """The coder of this process: tasks that run in it one after another share it."""
    return Coder(path)


def _frequent(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(places, their pair's index, pairs, counts)`` of all keys that occur at least ``MIN_USES`` times.

    Counts in hashed buckets bound the keys' counts from above, so only the
    places of well-filled buckets are read again. There a bucket's key is
    counted as it stands; only other keys that share its bucket are sorted.
    """
    bits = min(max(len(key).bit_length() - 1, 10), 24)
    bucket = ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).view(np.int64)
    place = np.flatnonzero((np.bincount(bucket, minlength=1 << bits) >= MIN_USES).take(bucket))
    key, bucket = key[place], bucket[place]
    pairs = np.zeros(1 << bits, np.uint64)
    pairs[bucket] = key  # one of each bucket
    other = np.flatnonzero(pairs.take(bucket) != key)
    more, inverse = np.unique(key[other], return_inverse=True)
    bucket[other] = (1 << bits) + inverse
    count = np.bincount(bucket, minlength=len(pairs) + len(more))
    often = np.flatnonzero(count >= MIN_USES)
    number = np.full(len(count), -1)
    number[often] = np.arange(len(often))
    number = number.take(bucket)
    stay = np.flatnonzero(number >= 0)
    return place[stay], number[stay], np.append(pairs, more)[often], count[often]


def _places(place: np.ndarray, after: np.ndarray, grade: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places to replace and their pair's grade, of ascending places: no two overlap.

    The better pair wins where two overlap; in a run of one symbol every
    second place is taken.
    """
    near = after[place[:-1]] == place[1:]
    good = np.ones(len(place), bool)
    good[:-1] &= ~(near & (grade[:-1] < grade[1:]))
    good[1:] &= ~(near & (grade[:-1] > grade[1:]))
    run = np.flatnonzero(near & (grade[:-1] == grade[1:]))
    if len(run):
        at = np.arange(len(run))
        in_run = at - np.maximum.accumulate(np.where(np.diff(run, prepend=-2) != 1, at, 0))
        good[run[in_run % 2 == 0] + 1] = False
    take = np.flatnonzero(good)
    return place[take], grade[take]


def compress(ids: np.ndarray, doc_sizes: np.ndarray, first_rule: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """``(rules, lengths, symbols, symbols per document)`` of one shard.

    A round replaces the most frequent of all adjacent pairs inside documents
    at once; where chosen pairs overlap the more frequent one wins (ties: the
    larger pair). Symbols keep their places and know the next and the last
    one that is left. Only pairs beside a new symbol are counted anew: they
    hold its number, so none was there before, and other pairs only get rarer.
    """
    n, ends = len(ids), np.cumsum(doc_sizes)
    s, stays = np.append(ids.astype(np.uint32), np.uint32(0)), np.ones(n, bool)
    after, before = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
    after[ends - 1] = before[ends - doc_sizes] = n  # nothing there
    rules, lengths, made = [np.empty((0, 2), np.uint32)], np.empty(0, np.uint32), 0
    pairs, count = np.empty(0, np.uint64), np.empty(0, np.int64)
    place, pair = np.empty(0, np.int64), np.empty(0, np.int32)  # of every pair that is still frequent
    pair_at, fresh = np.full(n + 1, -1, np.int32), np.flatnonzero(after[:n] < n)
    while True:
        at, number, new, uses = _frequent((s[fresh].astype(np.uint64) << np.uint64(32)) | s[after[fresh]])
        at, number = fresh[at], (len(pairs) + number).astype(np.int32)
        pair_at[at] = number
        place, pair = np.append(place, at), np.append(pair, number)
        pairs, count = np.append(pairs, new), np.append(count, uses)
        if not len(place):
            break
        for least in (max(MIN_USES, ROUND_SHARE * count.max()), MIN_USES):  # all, if nothing could be replaced
            often = np.flatnonzero(count >= least)
            often = often[np.lexsort((pairs[often], count[often]))]
            rank = np.zeros(len(count), np.int32)
            rank[often] = np.arange(1, len(often) + 1)
            grade = rank.take(pair)
            hit = np.flatnonzero(grade)
            hit = hit[np.argsort(place[hit], kind="stable")]
            take, which = _places(place[hit], after, grade[hit])
            good = np.bincount(which, minlength=len(often) + 1)[1:] >= MIN_USES
            if good.any():
                break
        if not good.any():
            break
        kept = np.flatnonzero(good[which - 1])
        take, which = take[kept], which[kept] - 1
        chosen = pairs[often[good]]
        new = np.column_stack([chosen >> np.uint64(32), chosen & np.uint64(0xFFFFFFFF)]).astype(np.uint32)
        lengths = np.append(lengths, (symbol_lengths(new[:, 0], lengths, first_rule)
                                      + symbol_lengths(new[:, 1], lengths, first_rule)).astype(np.uint32))
        rules.append(new)
        s[take] = (first_rule + made + np.cumsum(good) - 1)[which]
        gone = after[take]
        stays[gone] = False
        after[take] = right = after[gone]
        before[right] = take
        left = before[take]
        left = left[(left < n) & (s[left] < first_rule + made)]  # others are new themselves
        fresh = np.append(take[right < n], left)
        pair_at[gone] = pair_at[take] = pair_at[left] = -1
        made += len(new)
        pair = pair_at.take(place)
        count = np.bincount(pair + 1, minlength=len(pairs) + 1)[1:]
        count[count < MIN_USES] = 0
        stay = np.flatnonzero(np.append(count > 0, False).take(pair, mode="wrap"))
        place, pair = place[stay], pair[stay]
    return np.concatenate(rules), lengths, s[:n][stays], np.add.reduceat(stays, ends - doc_sizes, dtype=np.int64)


def expand(symbols: np.ndarray, rules: np.ndarray, first_rule: int) -> np.ndarray:
    """Ids of a run of symbols; each pass opens every nonterminal of the outermost level."""
    s = symbols.astype(np.int64)
    while True:
        open_ = s >= first_rule
        if not open_.any():
            return s.astype(np.uint32)
        at = np.cumsum(1 + open_) - 1
        out = np.empty(at[-1] + 1, np.int64)
        out[at] = np.where(open_, rules[np.where(open_, s - first_rule, 0), 1], s)
        out[at[open_] - 1] = rules[s[open_] - first_rule, 0]
        s = out


def symbol_lengths(symbols: np.ndarray, lengths: np.ndarray, first_rule: int) -> np.ndarray:
    """Number of ids behind each symbol."""
    s = symbols.astype(np.int64)
    out = np.ones(len(s), np.int64)
    ruled = s >= first_rule
    out[ruled] = lengths[s[ruled] - first_rule]
    return out


def expand_shard(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, first_rule: int) -> np.ndarray:
    """Ids of all symbols of a shard: every rule is opened once, then copied to where it stands."""
    ids = np.append(np.arange(first_rule, dtype=np.uint32), expand(first_rule + np.arange(len(rules)), rules, first_rule))
    size = np.append(np.ones(first_rule, np.int64), lengths)
    return joined((np.cumsum(size) - size)[symbols], size[symbols], ids)


def decode_range(row: dict, start: int, count: int) -> np.ndarray:
    """``count`` ids from id ``start`` of one shard row, opening only the symbols that cover them."""
    numbers = {k: np.frombuffer(row[k], "<u4") for k in ("rules", "lengths", "symbols")}
    ends = np.cumsum(symbol_lengths(numbers["symbols"], numbers["lengths"], row["first_rule"]))
    lo, hi = np.searchsorted(ends, start, "right"), np.searchsorted(ends, start + count, "left")
    ids = expand(numbers["symbols"][lo:hi + 1], numbers["rules"].reshape(-1, 2), row["first_rule"])
    skip = start - (int(ends[lo - 1]) if lo else 0)
    return ids[skip:skip + count]


def _encoded(vocabulary: str, end_id: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import public_tokenizers

        coder = coder_of(str(public_tokenizers.path(vocabulary)))
        first_rule = max(coder.coder.get_vocab_size(), end_id + 1)
        part, block = TaskContext.get().partitionId(), 0
        held: list[tuple[int | None, np.ndarray]] = []
        total = 0

        def shard() -> pd.DataFrame:
            sizes = np.array([len(x) for _, x in held], np.int64)
            rules, lengths, symbols, doc_symbols = compress(np.concatenate([x for _, x in held]), sizes, first_rule)
            raw = lambda x: np.ascontiguousarray(x).astype("<u4").tobytes()
            return pd.DataFrame([{
                "part": part, "block": block, "n_ids": int(sizes.sum()), "first_rule": first_rule, "rules": raw(rules),
                "lengths": raw(lengths), "symbols": raw(symbols),
                "doc_ids": np.array([d or 0 for d, _ in held], "<i8").tobytes(),
                "is_null": bytes(d is None for d, _ in held), "doc_symbols": raw(doc_symbols)}])

        for b in by_text_size(batches, "text", BATCH):
            coded = coder.encode(b["text"].tolist())
            keys = [None if k is pd.NA else int(k) for k in b["doc_id"].astype("Int64")]
            for key, code in zip(keys, coded):
                held.append((key, np.append(code, np.uint32(end_id))))
                total += len(held[-1][1])
                if total >= SHARD_IDS:
                    yield shard()
                    held, total, block = [], 0, block + 1
        if held:
            yield shard()
    return run


def write_shards(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> None:
    """Encode ``docs(doc_id, text)`` and write shards in ascending doc_id order (null first; equal ids by text hash).

    One shuffle by ranges of doc_id carries the texts; a task reads its range
    in order and holds one shard. Repeated doc_ids are told apart by the text
    hash, so they spread over ranges too.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("_h", F.xxhash64("text"))
    dealt = rows.repartitionByRange(parts, "doc_id", "_h").sortWithinPartitions("doc_id", "_h").drop("_h")
    map_batches(dealt, _encoded(vocabulary, end_id), FILE).write.parquet(path)


def _decoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for row in batch.to_dict("records"):
            n = {k: np.frombuffer(row[k], "<u4") for k in ("rules", "symbols", "lengths", "doc_symbols")}
            keys = np.frombuffer(row["doc_ids"], "<i8")
            sizes = symbol_lengths(n["symbols"], n["lengths"], row["first_rule"])
            cut = np.concatenate([[0], np.cumsum(n["doc_symbols"].astype(np.int64))])
            ends = np.concatenate([[0], np.cumsum(sizes)])[cut]
            ids = expand_shard(n["symbols"], n["rules"].reshape(-1, 2), n["lengths"], row["first_rule"]).astype("<u4", copy=False)
            doc_id = pd.array(keys, "Int64")
            doc_id[np.frombuffer(row["is_null"], np.uint8).astype(bool)] = pd.NA
            yield pd.DataFrame({
                "doc_id": doc_id, "part": row["part"], "block": row["block"], "at": ends[:-1],
                "n_tokens": np.diff(ends),
                "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])]})


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document of the shards, decoded.

    Starts add up in three steps: inside a shard, over the shards of a part,
    over the parts (one row per task of the writer).
    """
    file = spark.read.schema(FILE).parquet(path)
    blocks = file.select("part", "block", "n_ids")
    parts = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before_part = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("a"))
    inside = Window.partitionBy("part").orderBy("block")
    starts = (blocks.select("part", "block", (F.sum("n_ids").over(inside) - F.col("n_ids")).alias("b"))
              .join(checked_broadcast(before_part), "part").select("part", "block", (F.col("a") + F.col("b")).alias("base")))
    docs = map_batches(file.drop("n_ids"), _decoded,
                       "doc_id long, part int, block int, at long, n_tokens long, ids_crc32 long")
    return docs.join(checked_broadcast(starts), ["part", "block"]).select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame) -> DataFrame:
    """Write ``docs(doc_id, text)`` as Re-Pair shards and read every document back.

    Other columns are ignored. A null or empty text is the end id alone; rows
    that share a doc_id are documents of their own; an empty table gives no
    rows. A document is never split, so its ids must fit a task, as its text
    does.
    """
    path = scratch_dir(docs.sparkSession, "repair")
    write_shards(docs, path)
    return read_documents(docs.sparkSession, path)
