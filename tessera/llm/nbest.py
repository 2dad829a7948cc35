"""SentencePiece segmentation with N-best search over the piece lattice.

The forward pass scores the best path from the text's start to every
position (Viterbi). These scores are exact heuristics for the A-star search
that grows paths backwards from the end, so paths come out in order of their
total score. No piece crosses from a word into the next blank, so a lattice
falls apart into units (blanks and the word after them): whole texts are
segmented unit by unit, the distinct units of a batch side by side in numpy,
and A-star runs on the units that can take part in a text's N best; their
segmentations are put into the best ids of the text, combination by combination.

Scores: the vocabulary file's pieces are ranked by frequency; by Zipf's law
a piece of rank r has log-probability -ln(r) - ln(H). A character that is no
piece is spelt by its UTF-8 byte pieces.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import Slots, joined, packed, process_table, release_memory, wide_rows
from tessera.session import ship_package

BEST = 4
LONGEST_UNIT = 32
#: Units, and A-star results of units, that a process keeps: about 40 and 15 MB.
CACHE, KNOWN = 100_000, 20_000
#: Units searched side by side, and bytes of text segmented at a time.
SIDE_BY_SIDE, BATCH = 2048, 1 << 19
BLANK = "▁"
#: Stands for a literal U+2581 in a text, and between units; lone surrogates can't occur in a text itself.
LITERAL, BETWEEN = "\ud800", "\ud801"


def marked(text: str) -> str:
    """Blanks as pieces spell them."""
    return text.replace(BLANK, LITERAL).replace(" ", BLANK)


def default_model() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("piece_bpe_32k.model"))


def _codes(strings: list[str]) -> np.ndarray:
    """Code points, one row per place, one column per string, zero behind its end."""
    n = max(map(len, strings))
    return np.ascontiguousarray(np.array(strings, f"<U{n}").view(np.uint32).reshape(len(strings), n).T).astype(np.uint64)


class Vocabulary:
    """Pieces of a SentencePiece file, their scores, and a hash table for substrings."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.byte_id = {int(model.id_to_piece(i)[3:5], 16): i for i in range(n) if model.is_byte(i)}
        plain = [i for i in range(n) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        harmonic = float(np.log(np.sum(1 / np.arange(1, len(plain) + 1))))
        self.pieces = {model.id_to_piece(i): (i, -float(np.log(rank)) - harmonic) for rank, i in enumerate(plain, 1)}
        self.spell = -float(np.log(len(plain))) - harmonic - 10  # of one byte piece
        self.longest = max(map(len, self.pieces))
        self.prefixes = {p[:k]: self.pieces.get(p[:k]) for p in self.pieces for k in range(1, len(p) + 1)}
        self.raw = [b""] * n
        for p, (i, _) in self.pieces.items():
            self.raw[i] = p.replace(BLANK, " ").encode()
        for b, i in self.byte_id.items():
            self.raw[i] = bytes([b])
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)
        self.raw_size = np.array([len(r) for r in self.raw])
        self.raw_start = np.cumsum(self.raw_size) - self.raw_size
        self.ids = np.array([i for i, _ in self.pieces.values()])
        self.scores = np.array([s for _, s in self.pieces.values()])
        self._tables()

    def _tables(self) -> None:
        keys = self._hashes(list(self.pieces))
        self.keys = np.append(keys, ~np.uint64(0))  # the last entry matches nothing (a text's NUL hashes to 0)
        none = len(keys)
        self.first, self.second = np.full(1 << 20, none, np.int32), np.full(1 << 20, none, np.int32)
        self.first[keys >> np.uint64(44)] = np.arange(none)
        rest = np.flatnonzero(self.first[keys >> np.uint64(44)] != np.arange(none))
        at = (keys[rest] >> np.uint64(20)) & np.uint64((1 << 20) - 1)
        if len(np.unique(keys)) < none or len(np.unique(at)) < len(rest):
            raise ValueError("pieces collide in the hash tables")
        self.second[at] = rest
        # marks hashes of what a piece begins with; a false mark only costs a look into the tables
        self.begins = np.zeros(1 << 22, bool)
        self.begins[self._hashes(list(self.prefixes)) >> np.uint64(42)] = True

    def _hashes(self, strings: list[str]) -> np.ndarray:
        codes, size = _codes(strings), np.array([len(s) for s in strings])
        h = np.zeros(len(strings), np.uint64)
        for k, column in enumerate(codes):
            h = np.where(size > k, self.extend(h, column), h)
        return h

    @staticmethod
    def extend(h, code):
        with np.errstate(over="ignore"):
            h = (h ^ code) * np.uint64(0x9E3779B97F4A7C15)
            return h ^ (h >> np.uint64(29))

    def find(self, h: np.ndarray) -> np.ndarray:
        """Position of each hash among the pieces, -1 for none."""
        at = self.first[h >> np.uint64(44)]
        miss = (self.keys[at] != h).nonzero()[0]
        other = self.second[(h[miss] >> np.uint64(20)) & np.uint64((1 << 20) - 1)]
        at[miss] = np.where(self.keys[other] == h[miss], other, -1)
        return at

    def spelt(self, ids: np.ndarray) -> np.ndarray:
        """The bytes that piece ids spell."""
        return joined(self.raw_start[ids], self.raw_size[ids], self.raw_bytes)

    def edges(self, unit: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For every position the pieces that end there: (start, score, ids)."""
        into: list[list] = [[] for _ in range(len(unit) + 1)]
        for i, c in enumerate(unit):
            if c not in self.pieces:
                spelt = (BLANK if c == LITERAL else c).encode()
                into[i + 1].append((i, self.spell * len(spelt), tuple(self.byte_id[b] for b in spelt)))
            for j in range(i + 1, min(i + self.longest, len(unit)) + 1):
                found = self.prefixes.get(unit[i:j], False)
                if found is False:
                    break
                if found:
                    into[j].append((i, found[1], (found[0],)))
        return into


def best_paths(vocabulary: Vocabulary, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` best segmentations, best first: forward Viterbi, then A-star from the end."""
    into = vocabulary.edges(unit)
    ahead = [0.0] + [0.0] * len(unit)
    for j in range(1, len(into)):
        ahead[j] = max(ahead[i] + s for i, s, _ in into[j])
    heap, order, out = [(-ahead[-1], 0, 0.0, len(unit), None)], 1, []
    while heap and len(out) < n:
        _, _, done, at, tail = heapq.heappop(heap)
        if not at:
            ids: list[int] = []
            while tail:
                ids.extend(tail[0])
                tail = tail[1]
            out.append((done, tuple(ids)))
            continue
        for i, s, piece in into[at]:
            heapq.heappush(heap, (-(done + s + ahead[i]), order, done + s, i, (piece, tail)))
            order += 1
    return out


def _side_by_side(v: Vocabulary, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best score, gap to the second best, and best pieces (with their number) of units
    whose characters are all pieces (best score -inf: they aren't)."""
    codes, size = _codes(units), np.array([len(u) for u in units])
    n, every = len(codes), np.arange(len(units))
    score = np.full((n, min(v.longest, n) + 1, len(units)), -np.inf)
    piece = np.zeros(score.shape, np.int32)
    # the places of units where a piece may begin and go on, the characters left there, and the hash of what it has so far
    char, wide = codes.ravel(), len(units)
    place = np.arange(codes.size)
    left, h = (size - np.arange(n)[:, None]).ravel(), np.zeros(codes.size, np.uint64)
    found = np.zeros(score.shape[:2], bool)
    for length in range(1, score.shape[1]):
        on = (left >= length).nonzero()[0]
        place, left, h = place[on], left[on], v.extend(h[on], char[place[on] + (length - 1) * wide])
        on = v.begins[h >> np.uint64(42)].nonzero()[0]
        place, left, h = place[on], left[on], h[on]
        at = v.find(h)
        hit = (at >= 0).nonzero()[0]
        at, begin = at[hit], place[hit] // wide
        found[:, length] = np.bincount(begin, minlength=n) > 0
        to = place[hit] + (begin * (score.shape[1] - 1) + length) * wide  # in (begin, length, unit)
        score.ravel()[to], piece.ravel()[to] = v.scores[at], v.ids[at]
    after = np.full((n + 1, len(units)), -np.inf)
    after[size, every] = 0
    got = np.empty(len(units))
    for i in range(n - 1, -1, -1):
        for length in np.flatnonzero(found[i]):
            np.maximum(after[i], np.add(score[i, length], after[i + length], out=got), out=after[i])
    ahead = np.full((n + 1, len(units)), -np.inf)
    step = np.zeros((n + 1, len(units)), np.int16)
    ahead[0] = 0
    for j in range(1, n + 1):
        for length in range(1, min(j, score.shape[1] - 1) + 1):
            if not found[j - length, length]:
                continue
            score[j - length, length] += ahead[j - length]  # from here on the score of the best way through this piece's end
            np.copyto(step[j], length, where=score[j - length, length] > ahead[j])
            np.maximum(ahead[j], score[j - length, length], out=ahead[j])
    best = ahead[size, every]
    ids, used = np.zeros((n, len(units)), np.int32), np.zeros(len(units), np.int64)
    at = size.copy()
    at[best == -np.inf] = 0  # a character that is no piece: left to the caller
    while (go := np.flatnonzero(at > 0)).size:
        length = step[at[go], go]
        at[go] -= length
        score[at[go], length, go] = -np.inf  # what is left are the pieces beside the best path
        ids[n - 1 - used[go], go] = piece[at[go], length, go]
        used[go] += 1
    through = np.full(len(units), -np.inf)
    for i in range(n):
        for length in np.flatnonzero(found[i]):
            np.maximum(through, np.add(score[i, length], after[i + length], out=got), out=through)
    with np.errstate(invalid="ignore"):
        return best, best - through, ids.T, used


def _units(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray, np.ndarray]:
    """Units of all texts as they stand (blanks are not marked), one after another, and the end of each text's units;
    the bytes of all texts, each but empty ones with a blank before it, and the end of each text's bytes.

    A run of blanks begins a unit, which goes on to the next blank or line end; a line end is a unit."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    blank = pc.if_else(pc.equal(pc.binary_length(texts), 0), "", " ").cast(pa.large_string())
    texts = pc.binary_join_element_wise(blank, texts, pa.scalar("", pa.large_string()))
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data or b"", np.uint8)[bounds[0]:bounds[-1]]
    bounds = bounds - bounds[0]
    space, line = raw == 32, raw == 10
    starts = line.copy()
    starts[1:] |= np.where(space[1:], ~space[:-1], line[:-1])
    starts[bounds[:-1][np.diff(bounds) > 0]] = True
    at = np.append(np.flatnonzero(starts), len(raw))
    units = pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(raw))
    return units.dictionary_encode(), np.searchsorted(at, bounds[1:]), raw, bounds[1:]


class Segmenter:
    """Segments batches of texts; results of distinct units are kept up to ``CACHE`` units, then the half most used."""

    def __init__(self, vocabulary: Vocabulary, n: int = BEST):
        self.v, self.n = vocabulary, n
        self.known = lru_cache(KNOWN)(self._ways)
        self.slot = Slots()
        self.score, self.gap = np.empty(0), np.empty(0)
        self.count, self.start, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)

    def _trim(self) -> None:
        stay = self.slot.trim(CACHE // 2)
        self.score, self.gap = self.score[stay], self.gap[stay]
        self.start, self.count, self.ids = packed(self.start[stay], self.count[stay], self.ids)

    def _learn(self, units: list[str]) -> None:
        """Adds units to the tables, in order."""
        units = marked(BETWEEN.join(units)).split(BETWEEN)
        size = np.fromiter(map(len, units), np.int64, len(units))
        score, gap = np.full(len(units), -np.inf), np.empty(len(units))
        count, start, ids, total = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64), [self.ids], len(self.ids)
        width = np.where(size <= LONGEST_UNIT, -(-size // 4), 0)
        for w in np.unique(width[width > 0]):
            group = np.flatnonzero(width == w)
            for s in range(0, len(group), SIDE_BY_SIDE):
                part = group[s:s + SIDE_BY_SIDE]
                score[part], gap[part], matrix, used = _side_by_side(self.v, [units[k] for k in part])
                count[part], start[part] = used, total + np.cumsum(used) - used
                ids.append(matrix[np.arange(matrix.shape[1]) >= matrix.shape[1] - used[:, None]])
                total += len(ids[-1])
        for k in np.flatnonzero(score == -np.inf):  # long units, and those with a character that is no piece
            paths = best_paths(self.v, units[k], 2)
            score[k], gap[k] = paths[0][0], paths[0][0] - paths[1][0] if len(paths) > 1 else np.inf
            ids.append(np.array(paths[0][1], np.int32))
            count[k], start[k] = len(ids[-1]), total
            total += len(ids[-1])
        self.score, self.gap = np.append(self.score, score), np.append(self.gap, gap)
        self.count, self.start = np.append(self.count, count), np.append(self.start, start)
        self.ids = np.concatenate(ids)

    def batch(self, texts: list[str] | pa.Array) -> Iterator[tuple[list[float], list[np.ndarray], bool]]:
        """Scores and ids of up to ``n`` best segmentations of every text, best first, and whether all
        spell the text."""
        if len(self.slot) > CACHE:
            self._trim()
        units, last, raw, ends = _units(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts)
        strings, which = units.dictionary.to_pylist(), units.indices.to_numpy()
        own = self.slot.of(strings, np.bincount(which, minlength=len(strings)))
        if fresh := self.slot.taken():
            self._learn(fresh)
        count, score, gap = self.count[own][which], self.score[own][which], self.gap[own][which]
        ids, until = joined(self.start[own][which], count, self.ids), np.append(0, np.cumsum(count))
        del units, own, count
        first = begin = 0
        for end, stop in zip(last.tolist(), ends.tolist()):
            near = first + self._near(gap[first:end])
            a, b = until[first], until[end]
            same = np.array_equal(self.v.spelt(ids[a:b]), raw[begin:stop])
            places = [(int(until[k]), int(until[k + 1])) for k in near]
            ways = [self.known(strings[which[k]], ids[x:y].tobytes()) for k, (x, y) in zip(near, places)]
            total, scores, paths = float(score[first:end].sum()), [], []
            for loss, taken in self._combined(ways):
                parts, at = [], a
                for (x, y), way, k in zip(places, ways, taken):
                    if k:
                        parts += [ids[at:x], np.frombuffer(way[k][1], np.int32)]
                        at = y
                        same = same and way[k][2]
                scores.append(total - loss)
                paths.append(np.concatenate([*parts, ids[at:b]]) if parts else ids[a:b])
            yield scores, paths, same
            first, begin = end, stop

    def _near(self, gap: np.ndarray) -> np.ndarray:
        """Places of the ``n`` - 1 smallest gaps, of equal ones the first, in order."""
        if len(gap) < self.n:
            return np.arange(len(gap))
        if self.n == 1:
            return np.empty(0, np.int64)
        few = np.flatnonzero(gap <= np.partition(gap, self.n - 2)[self.n - 2])
        return np.sort(few[np.argsort(gap[few], kind="stable")[:self.n - 1]])

    def _ways(self, unit: str, best: bytes) -> list[tuple[float, bytes, bool]]:
        """The unit's segmentations, the one with the best ids first: loss, ids, and whether they spell the same bytes."""
        paths, first = best_paths(self.v, marked(unit), self.n), tuple(np.frombuffer(best, np.int32).tolist())
        raw = b"".join(map(self.v.raw.__getitem__, first))
        others = [(max(0.0, paths[0][0] - s), np.array(ids, np.int32).tobytes(), b"".join(map(self.v.raw.__getitem__, ids)) == raw)
                  for s, ids in paths if ids != first]  # of equal scores A-star may put another one first
        return [(0.0, best, True), *others[:self.n - 1]]

    def _combined(self, ways: list[list[tuple[float, bytes, bool]]]) -> list[tuple[float, tuple[int, ...]]]:
        """The best combinations of the units' segmentations, best first: loss, and the one taken of every unit."""
        best: list[tuple[float, tuple[int, ...]]] = [(0.0, ())]
        for way in ways:
            best = sorted((x + w[0], (*taken, k)) for x, taken in best for k, w in enumerate(way))[:self.n]
        return best


def vocabulary_of(path: str) -> Vocabulary:
    """The vocabulary of this process: tasks that run in it one after another share its tables."""
    def read() -> Vocabulary:
        found = Vocabulary(path)
        release_memory()
        return found

    return process_table(("pieces", path), read)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in pieces of about ``BATCH`` bytes of text (at least one row), not copied."""
    size = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(size, size[at] + BATCH, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def _lists(sizes: list[int], values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(np.cumsum([0, *sizes], dtype=np.int32), values)


def _segment(path: str, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segmenter = Segmenter(vocabulary_of(path), n)
        yield from _segmented(segmenter, batches)
        del segmenter
        release_memory()
    return run


def _segmented(segmenter: Segmenter, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _slices(batch):
            found = list(segmenter.batch(part.column("text")))
            paths = [p.astype("<i4", copy=False) for _, ways, _ in found for p in ways]
            sizes = [len(p) for p in paths]
            one = pa.StructArray.from_arrays(
                [pa.array([x for scores, _, _ in found for x in scores], pa.float64()),
                 _lists(sizes, pa.array(np.concatenate(paths))), pa.array(sizes, pa.int64()),
                 pa.array([zlib.crc32(p) for p in paths], pa.int64())], ["score", "ids", "n_pieces", "ids_crc32"])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), _lists([len(w) for _, w, _ in found], one),
                 pa.array([exact for _, _, exact in found], pa.bool_())], ["doc_id", "segmentations", "exact"])


def segmented(docs: DataFrame, n: int = BEST, path: str | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``segmentations`` and ``exact``: decoding the ids of each gives the text.

    ``segmentations`` are the up to ``n`` best, best first, as ``(score, ids,
    n_pieces, ids_crc32)``. Of equal scores any may come first. A null text
    counts as empty; an empty text has one segmentation without pieces and of
    score 0. Equal texts have equal results. Only ``doc_id`` and ``text`` are
    read; an empty table gives no rows. ``path`` names the vocabulary file, which every executor must have.
    """
    ship_package(docs.sparkSession)
    wide_rows(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _segment(path or default_model(), n),
        "doc_id long, segmentations array<struct<score:double,ids:array<int>,n_pieces:long,ids_crc32:long>>, exact boolean")


def best_segmentations(text: str, n: int = BEST, path: str | None = None) -> list[tuple[float, tuple[int, ...]]]:
    """The ``n`` best segmentations of one text over its whole lattice: (score, ids)."""
    return best_paths(Vocabulary(path or default_model()), marked(" " + text) if text else "", n)
