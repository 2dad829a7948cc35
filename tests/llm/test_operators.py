"""Dealt operators against brute force, exact round trips and held-out accuracy, with nulls, ties, repeats, empty tables."""

import base64
import hashlib
import json
import random
import re
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import (decontaminate, htmltext, langid, licenses, nbest, neardup, quality, queries, repair, transcripts, warc)
from tests.conftest import SF_SMALL

DOCS = "doc_id long, text string, lang string, containment double, node string, hash long, n_words int"


def table(spark, name):
    return spark.read.parquet(f"{SF_SMALL}/{name}.parquet")


def docs_of(spark, pairs):
    """Documents with columns that clash with names the operators use."""
    return spark.createDataFrame([(i, t, None, 0.5, "x", 1, 2) for i, t in pairs], DOCS)


def words(text):
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower()) if w]


def shingles(text):
    w = words(text)
    return Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))


@pytest.fixture(scope="module")
def odd(spark):
    """Null id, null and empty text, repeated rows, a very long text."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    return docs_of(spark, [(1, None), (2, ""), (None, "alpha beta"), (3, long), (3, long), (4, "!?"), (4, "été")])


# 1 -----------------------------------------------------------------------------------------------

def test_licenses_match_brute_force(spark):
    docs = table(spark, "documents")
    wanted = {k: set(shingles(v)) for k, v in licenses.TEMPLATES.items()}
    want = set()
    for r in docs.collect():
        have = set(shingles(r.text))
        want |= {(r.doc_id, k, len(s), len(s & have)) for k, s in wanted.items() if len(s & have) >= 0.8 * len(s)}
    got = {(r.doc_id, r.license, r.n_template, r.n_shared) for r in licenses.scan(docs).collect()}
    assert got == want and want


def test_licenses_planted_in_long_texts(spark):
    rng = random.Random(5)
    rows, want = [], set()
    for i, (name, text) in enumerate(sorted(licenses.TEMPLATES.items()) * 3):
        w = text.split()
        if len(w) > 40:
            w[len(w) // 2] = "changed"
        pad = lambda n: " ".join(rng.choice("lorem ipsum dolor sit amet".split()) + str(rng.random()) for _ in range(n))
        rows.append((i, f"{pad(rng.randint(0, 3000))} {' '.join(w)} {pad(rng.randint(0, 900))}"))
        want.add((i, name))
    got = {(r.doc_id, r.license) for r in licenses.scan(docs_of(spark, rows)).collect()}
    assert want <= got


BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer
in the documentation and/or other materials provided with the distribution.
{}THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES"""
CLAUSE_3 = """3. Neither the name of Acme nor the names of its contributors may be used to endorse or promote products derived from
this software without specific prior written permission.
"""


def test_licenses_short_notices_and_bsd(spark):
    rows = [(1, "(c) Acme.\nALL Rights\nreserved"), (2, "all rights"), (3, "reserved. All"), (4, "rights reserved"),
            (5, BSD.format("")), (6, BSD.format(CLAUSE_3)), (7, "all rights are reserved"), (8, "x SPDX-License-Identifier: MIT y")]
    out = licenses.scan(docs_of(spark, rows), notices=licenses.SHORT_NOTICES).collect()
    assert Counter((r.doc_id, r.license) for r in out) == Counter([
        (1, "All-rights-reserved"), (5, "BSD-conditions"), (5, "BSD-2-Clause"), (6, "BSD-conditions"), (6, "BSD-3-Clause"),
        (8, "MIT-SPDX")])
    assert {(r.doc_id, r.first_word) for r in out if r.n_template == 1} == {(1, 2), (8, 1)}
    with pytest.raises(ValueError):
        licenses.scan(docs_of(spark, rows), notices={"long": "five words are too many"})


def test_licenses_of_a_family_are_told_apart(spark):
    names = sorted(n for n in licenses.TEMPLATES if re.match("A?GPL|LGPL|BSD|MIT|ISC|Unl", n))
    text = {n: licenses.TEMPLATES[n].replace("29 June", "29 June 2007").replace("2, June", "2, June 1991") for n in names}
    out = licenses.scan(docs_of(spark, [(i, f"a b c {text[n]} d e f") for i, n in enumerate(names)])).collect()
    assert sorted((r.doc_id, r.license) for r in out) == list(enumerate(names))


def test_license_query_finds_all_kinds_of_notice(spark):
    import __spark_entry__ as entry

    have = {(r.doc_id, r.license) for r in entry.queries()["op1_license_scan"](spark, SF_SMALL).collect()}
    want = {r.doc_id for r in table(spark, "documents").collect() if re.search(r"\ball rights reserved\b", (r.text or "").lower())}
    assert {d for d, name in have if name == "All-rights-reserved"} == want


def test_licenses_edge_rows(spark, odd):
    assert licenses.scan(odd).count() == 0 and licenses.scan(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        licenses.scan(odd, {"short": "four words are few"})


# 2 -----------------------------------------------------------------------------------------------

def test_repair_shards_round_trip(spark, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    code = lambda t: coder.encode(t or "", add_special_tokens=False).ids + [2]
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    want, start = [], 0
    for r in table(spark, "documents").orderBy("doc_id").collect():
        ids = code(r.text)
        want.append((r.doc_id, start, len(ids), crc(ids)))
        start += len(ids)
    assert [tuple(r) for r in repair.round_trip(table(spark, "documents")).orderBy("start").collect()] == want
    rows = repair.round_trip(odd).orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == Counter(
        (r.doc_id, len(code(r.text)), crc(code(r.text))) for r in odd.collect())
    assert [r.start for r in rows] == [0, *np.cumsum([r.n_tokens for r in rows])[:-1]]
    assert repair.round_trip(odd.limit(0)).count() == 0


def test_repair_compresses_and_decodes_any_range():
    rng = np.random.default_rng(1)
    ids = np.concatenate([np.tile(rng.integers(0, 50, 40), 60), rng.integers(0, 9, 3000), np.zeros(777, int)]).astype(np.uint32)
    sizes = np.array([1, 2399, 3000, len(ids) - 5400])
    rules, lengths, symbols, doc_symbols = repair.compress(ids, sizes, 50)
    assert len(symbols) + 2 * len(rules) < len(ids) / 2 and doc_symbols.sum() == len(symbols)
    assert np.array_equal(repair.expand(symbols, rules, 50), ids)
    size = repair.symbol_lengths(symbols, lengths, 50)
    assert np.array_equal(np.add.reduceat(size, np.cumsum(doc_symbols) - doc_symbols), sizes)
    row = {"rules": rules.tobytes(), "lengths": lengths.tobytes(), "symbols": symbols.tobytes(), "first_rule": 50}
    for a, n in [(0, 1), (17, 900), (len(ids) - 3, 3), (5000, 0)]:
        assert np.array_equal(repair.decode_range(row, a, n), ids[a:a + n])


def test_pieces_in_use_are_encoded_once_when_the_table_overflows(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    monkeypatch.setattr(repair, "WORDS", 100)
    learned, learn = Counter(), repair.Coder._learn
    monkeypatch.setattr(repair.Coder, "_learn", lambda self, pieces: (learned.update(pieces), learn(self, pieces))[1])
    plain, coder = Tokenizer.from_file(path), repair.Coder(path)
    common = "the cat naïvely and «the» dog's tail\n"
    for k in range(40):
        text = f"{common}{' '.join(f'rare{chr(97 + k % 26)}{chr(97 + j)}{k}' for j in range(26))} {common}"
        assert coder.encode([text])[0].tolist() == plain.encode(text, add_special_tokens=False).ids
    assert all(learned[w] == 1 for w in (" cat", " naïvely", " dog"))


def test_shard_expands_by_rules_opened_once():
    rng = np.random.default_rng(3)
    for hi, n in ((1, 5000), (3, 900), (40, 20_000), (9, 1)):
        ids = np.tile(rng.integers(0, hi, n), 3).astype(np.uint32)
        sizes = np.array([n, 2 * n - 1, 1]) if n > 1 else np.array([3])
        rules, lengths, symbols, doc_symbols = repair.compress(ids, sizes, 50)
        assert np.array_equal(repair.expand_shard(symbols, rules, lengths, 50), ids)
        assert np.array_equal(repair.expand(symbols, rules, 50), ids) and doc_symbols.sum() == len(symbols)


def plain_rounds(ids, sizes, first_rule):
    """Re-Pair in rounds with all pairs counted in every one."""
    docs, rules = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])], []
    while True:
        count = Counter(p for d in docs for p in zip(d, d[1:]))
        for least in (max(repair.MIN_USES, repair.ROUND_SHARE * max(count.values(), default=0)), repair.MIN_USES):
            ranked = sorted((n, p) for p, n in count.items() if n >= least)
            grade = {p: k for k, (_, p) in enumerate(ranked)}
            uses = Counter()
            taken = []
            for d in docs:
                own, run = [grade.get(p, -1) for p in zip(d, d[1:])], 0
                for i, g in enumerate(own):
                    run = run + 1 if i and g == own[i - 1] else 0
                    if g >= 0 and run % 2 == 0 and g >= max(own[max(i - 1, 0):i + 2]):
                        uses[g] += 1
                        taken.append((id(d), i, g))
            good = [g for g in sorted(uses) if uses[g] >= repair.MIN_USES]
            if good:
                break
        if not good:
            return rules, docs
        number = {g: first_rule + len(rules) + k for k, g in enumerate(good)}
        rules += [ranked[g][1] for g in good]
        at = {(d, i): number[g] for d, i, g in taken if g in number}
        docs = [[at.get((id(d), i), x) for i, x in enumerate(d) if (id(d), i - 1) not in at] for d in docs]


def test_rounds_count_only_pairs_beside_new_symbols(monkeypatch):
    looked_at, frequent = [], repair._frequent
    monkeypatch.setattr(repair, "_frequent", lambda key: (looked_at.append(len(key)), frequent(key))[1])
    rng = np.random.default_rng(8)
    for hi, n in ((1, 300), (2, 400), (6, 900), (30, 3000), (30, 40)):
        looked_at.clear()
        ids = np.resize(rng.integers(0, hi, n // 2), n).astype(np.uint32)
        sizes = np.array([1, n // 3, n - n // 3 - 2, 1])
        rules, _, symbols, doc_symbols = repair.compress(ids, sizes, 50)
        want_rules, want_docs = plain_rounds(ids, sizes, 50)
        assert [tuple(r) for r in rules.tolist()] == want_rules and doc_symbols.tolist() == list(map(len, want_docs))
        assert symbols.tolist() == [x for d in want_docs for x in d]
        assert looked_at[0] == n - 4 and sum(looked_at[1:]) <= 2 * (n - len(symbols))


def test_new_pieces_are_merged_many_at_a_call(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    class Counting:
        def __init__(self, merges):
            self.merges, self.calls = merges, 0

        def encode_batch_fast(self, *args, **kw):
            self.calls += 1
            return self.merges.encode_batch_fast(*args, **kw)

    path, rng = str(public_tokenizers.path("byte_bpe_50k.json")), random.Random(9)
    plain, coder = Tokenizer.from_file(path), repair.Coder(path)
    coder.merges = Counting(coder.merges)
    monkeypatch.setattr(repair, "WORDS", 2000)
    word = lambda: "".join(rng.choice("abcdeéÿſŒ") for _ in range(rng.randint(1, 14)))
    for _ in range(4):
        texts = [" ".join(word() for _ in range(rng.randint(0, 60))) + " — “the” tail…" for _ in range(60)]
        assert [x.tolist() for x in coder.encode(texts)] == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    assert len(coder.count) == len(coder.keys) + len(coder.rows) > 1000 and coder.merges.calls < 20


def test_vocabulary_that_merges_the_character_between_pieces_is_not_used_by_piece(tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        file = json.load(f)
    null = repair.ALPHABET[0]
    file["model"]["vocab"][2 * null] = max(file["model"]["vocab"].values()) + 1
    file["model"]["merges"].append([null, null])
    path = str(tmp_path / "merged.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(file, f)
    plain, coder = Tokenizer.from_file(path), repair.Coder(path)
    texts = ["a\0\0b", "", "two words", "\0" * 9]
    assert not coder.by_piece
    assert [x.tolist() for x in coder.encode(texts)] == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]


# 3 -----------------------------------------------------------------------------------------------

def _brute_force_best(vocabulary, unit):
    best = [(0.0, ())] + [None] * len(unit)
    for end in range(1, len(unit) + 1):
        for at in range(end):
            piece = vocabulary.pieces.get(unit[at:end])
            if piece and best[at]:
                found = (best[at][0] + piece[1], best[at][1] + (piece[0],))
                if best[end] is None or found[0] > best[end][0]:
                    best[end] = found
    return best[-1]


def test_nbest_first_is_viterbi_and_scores_fall():
    vocabulary = nbest.Vocabulary(nbest.default_model())
    for unit in ("▁segmentation", "▁international", "▁aaaaaa", "▁the"):
        paths = nbest.best_paths(vocabulary, unit, 4)
        assert paths[0][0] == pytest.approx(_brute_force_best(vocabulary, unit)[0])
        assert [p[0] for p in paths] == sorted((p[0] for p in paths), reverse=True)
        assert len({tuple(p[1]) for p in paths}) == len(paths)


def _every_path(vocabulary, text):
    """All segmentations of a short text by enumeration, best first."""
    marked = nbest.BLANK + text.replace(nbest.BLANK, nbest.LITERAL).replace(" ", nbest.BLANK)
    into = vocabulary.edges(marked)
    ends = [[(0.0, ())]] + [[] for _ in marked]
    for j in range(1, len(into)):
        ends[j] = [(done + s, ids + piece) for i, s, piece in into[j] for done, ids in ends[i]]
    return sorted(ends[-1], key=lambda p: -p[0])


def test_segmentations_are_the_n_best(spark):
    vocabulary = nbest.Vocabulary(nbest.default_model())
    texts = ["a", "the cat", "aaaa aaaa", "it is in", "on on on a", "é ▁ x", "a\n\nb", "  ab", "日本 x", "aaa", "no way"]
    for n in (1, 4, 6):
        for r in nbest.segmented(docs_of(spark, list(enumerate(texts))), n).collect():
            every = _every_path(vocabulary, texts[r.doc_id])
            scores = {ids: s for s, ids in every}
            got = [tuple(s.ids) for s in r.segmentations]
            assert r.exact and len(set(got)) == len(got) == min(n, len(every))
            assert [s.score for s in r.segmentations] == pytest.approx([s for s, _ in every[:n]])
            assert [scores[ids] for ids in got] == pytest.approx([s for s, _ in every[:n]])
            assert [(s.n_pieces, s.ids_crc32) for s in r.segmentations] == [
                (len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for i in got]
    text = "International organisations discuss segmentation of unusually long words."
    row = nbest.segmented(docs_of(spark, [(1, text)]), 8).first()
    whole = nbest.best_segmentations(text, 8)
    assert [s.score for s in row.segmentations] == pytest.approx([s for s, _ in whole])
    assert {tuple(s.ids) for s in row.segmentations[:4]} <= {ids for _, ids in whole}


def test_segmented_round_trip(spark, odd):
    for docs in (table(spark, "documents"), odd):
        out = nbest.segmented(docs).collect()
        assert len(out) == docs.count() and all(r.exact for r in out)
    assert nbest.segmented(odd.limit(0)).count() == 0


def test_op3_returns_the_ids_of_every_segmentation(spark):
    """The query's own rows, not only digests of them: each alternative spells the text."""
    vocabulary = nbest.Vocabulary(nbest.default_model())
    texts = {r.doc_id: r.text or "" for r in table(spark, "documents").collect()}
    rows = queries.QUERIES["op3_sentencepiece_nbest"](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts) and max(len(r.segmentations) for r in rows) == nbest.BEST
    for r in rows:
        for s in r.segmentations:
            assert b"".join(vocabulary.raw[i] for i in s.ids)[1:].decode() == texts[r.doc_id]
            assert (s.n_pieces, s.ids_crc32) == (len(s.ids), zlib.crc32(np.array(s.ids, "<u4").tobytes()))


def test_units_in_use_are_searched_once_when_the_table_overflows(monkeypatch):
    """Rare units make room for each other; the ones that every text holds stay."""
    monkeypatch.setattr(nbest, "CACHE", 100)
    learned = Counter()
    learn = nbest.Segmenter._learn
    monkeypatch.setattr(nbest.Segmenter, "_learn", lambda self, units: (learned.update(u.strip(f" {nbest.BLANK}") for u in units),
                                                                        learn(self, units))[1])
    vocabulary = nbest.Vocabulary(nbest.default_model())
    common = "the cat and the dog of it"
    texts = [f"{common} {' '.join(f'rare{k}x{j} ▁' for j in range(30))} {common}" for k in range(40)]
    kept = nbest.Segmenter(vocabulary)
    for text in texts:
        (scores, paths, same), = kept.batch([text])
        (fresh_scores, fresh_paths, _), = nbest.Segmenter(vocabulary).batch([text]) if text in texts[::13] else [(scores, paths, same)]
        assert same and scores == fresh_scores and all(map(np.array_equal, paths, fresh_paths))
        assert len(kept.slot) <= 200 and len(kept.score) == len(kept.count) == len(kept.slot)
    assert all(learned[w] <= 1 + len(texts[::13]) for w in common.split())


def test_a_unit_is_looked_up_once_a_batch(monkeypatch):
    """Repeats of a unit cost no look into the table of units; the counts by which it is trimmed hold them."""
    asked = []
    of = nbest.Slots.of
    monkeypatch.setattr(nbest.Slots, "of", lambda self, strings, times=1: (asked.extend(strings), of(self, strings, times))[1])
    segmenter = nbest.Segmenter(nbest.Vocabulary(nbest.default_model()))
    texts = ["the cat and the cat\nthe cat", "the cat " * 50, "", "and\n and"]
    found = list(segmenter.batch(texts))
    assert sorted(asked) == sorted({" the", " cat", " and", "\n", "the", " "})
    assert dict(zip(segmenter.slot, segmenter.slot.uses.tolist())) == {" the": 52, " cat": 53, " and": 3, "\n": 2, "the": 1, " ": 1}
    assert all(same for _, _, same in found) and [len(scores) for scores, _, _ in found] == [4, 4, 1, 4]
    assert list(segmenter.batch(["", ""])) == [([0.0], [pytest.approx([])], True)] * 2


def test_segmented_lines_that_begin_with_nul(spark):
    """The hash of a NUL is that of no characters; it stood for the entry of the tables that matches nothing."""
    texts = ["a\n\0", "a\n\0b c", "\0", "\0\0 x"]
    rows = nbest.segmented(docs_of(spark, list(enumerate(texts)))).collect()
    assert len(rows) == len(texts)
    for r in rows:
        every = _every_path(nbest.Vocabulary(nbest.default_model()), texts[r.doc_id])
        assert r.exact and [s.score for s in r.segmentations] == pytest.approx([s for s, _ in every[:nbest.BEST]])


# 4 -----------------------------------------------------------------------------------------------

def _warc_by_hand(rows):
    digest = lambda r: base64.b32encode(hashlib.sha1((r.html or "").encode()).digest()).decode()
    first = {}
    for r in rows:
        if r.page_id is not None:
            first[digest(r)] = min(first.get(digest(r), r.page_id), r.page_id)
    return Counter((r.page_id, len((r.html or "").encode()), digest(r),
                    *(("response", None) if first.get(digest(r), r.page_id) == r.page_id else ("revisit", first[digest(r)])))
                   for r in rows)


def test_warc_round_trip(spark):
    mark = warc.SEPARATOR
    rows = [(1, "u", None), (2, None, ""), (3, "a b\r\nX: y", f"x{mark}{mark}y\r\n\r\nWA{mark}"), (3, "u", "é" * 150_000 + "\r\n"),
            (None, "n", "é" * 150_000 + "\r\n"), (9, "n", mark), (9, "n", mark), (10, "n", "\r\n\r\n" + mark), (None, "z", "only")]
    pages = spark.createDataFrame([(*r, 5, "s") for r in rows], "page_id long, url string, html string, record int, head string")
    for some in (pages, table(spark, "pages"), pages.limit(0)):
        assert Counter(tuple(r) for r in warc.round_trip(some).collect()) == _warc_by_hand(some.collect())


def test_warc_marks_at_the_edges_of_payloads_and_segments(spark):
    first = "WARC/1.1\r\n"
    edge = lambda k: "x" * (warc.SEGMENT - k)
    texts = [first, first + "a", "a\r\n\r\nWARC/1.1", "WARC/1.1", first * 3, "a\r\n\r\nWA", "RC/1.1\r\n", edge(0) + first + "b",
             *(edge(k) + warc.SEPARATOR + "b" for k in range(0, 15)), edge(12) + "\r\n\r\nWARC/1.1", "€" * 50_000, "€" * 50_000 + first]
    pages = spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").selectExpr("page_id", "'u' AS url", "html")
    assert Counter(tuple(r) for r in warc.round_trip(pages).collect()) == _warc_by_hand(pages.collect())


def test_warc_separator_at_the_readers_buffer_edge(spark, tmp_path):
    """Records one byte longer than the reader's buffer of 64 KiB, each ending in a line end, push the separator over its edge."""
    def written(name, size):
        pages = spark.createDataFrame([(i, "u", f"{i}".ljust(size - 2, "x") + "\r\n") for i in range(1, 10)],
                                      "page_id long, url string, html string")
        warc.write_archives(warc.classified(pages).coalesce(1), str(tmp_path / name))
        return [f for f in (tmp_path / name).iterdir() if f.name.startswith("part-") and f.stat().st_size]

    size = 60_000
    size += 65_537 - written("a", size)[0].stat().st_size // 9
    assert [f.stat().st_size for f in written("b", size)] == [9 * 65_537]
    assert warc.read_archives(spark, str(tmp_path / "b")).count() == 9


def test_warc_segments_are_bounded(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "é" * 300_000)], "page_id long, url string, html string")
    warc.write_archives(warc.classified(pages), str(tmp_path / "w"))
    chunks = warc.read_archives(spark, str(tmp_path / "w")).orderBy("part").collect()
    assert len(chunks) == 10 and max(r.n for r in chunks) <= warc.SEGMENT
    assert [r.warc_type for r in chunks] == ["response"] + ["continuation"] * 9
    assert b"".join(r.data for r in chunks).decode() == "é" * 300_000


# 5 -----------------------------------------------------------------------------------------------

def test_main_text_of_generated_pages(spark):
    import html
    rows = {r.page_id: r.html for r in table(spark, "pages").collect()}
    for r in htmltext.extract(table(spark, "pages")).collect():
        article = re.search(r"<article>(.*)</article>", rows[r.page_id], re.S).group(1).replace("<br>", " ")
        blocks = [" ".join(html.unescape(b).split()) for b in re.split(r"</?(?:p|h1|li|ul|div|b)>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_main_text_by_scores():
    prose = "Some words, and more words, that read like an article and go on for a good while, as articles do."
    page = f"""<body><div class="menu"><a href=/>Home</a></div><div id=x><div><p>{prose}</p><p>A &lt;b&gt; &#233; end.</p></div>
        <div><p>{prose} Again.</p></div><div><a href=1>link, one</a> <a href=2>link, two</a></div></div>
        <div class="comments"><p>{prose * 3}</p></div><form><p>{prose * 3}</p></form><script>var p = "<p>x, y</p>";</script>"""
    assert htmltext.main_blocks(page) == [prose, "A <b> é end.", f"{prose} Again."]
    assert htmltext.main_blocks("") == [] and htmltext.main_blocks("<nav>a</nav>") == []
    assert htmltext.main_blocks("just  text") == ["just text"]


def test_main_text_keeps_the_whole_article():
    long = "Some words, and more words, that read like an article, and go on, for a good while, as articles do, to the end."
    short = "Seventy characters of text that stand in a paragraph of their own here."
    body = f"<div class=body><div class=col>{f'<p>{long}</p>' * 20}</div></div>"
    for outer in ("main", "article", "div"):
        page = f"<{outer}><h1>Title</h1><p>Lead</p>{body}</{outer}><ul><li><a href=1>link</a><li><a href=2>link</a></ul>"
        assert htmltext.main_blocks(page) == ["Title", "Lead", *[long] * 20]
        page = f"<{outer}><section>{f'<p>{long}</p>' * 9}</section><section>{f'<p>{short}</p>' * 5}</section></{outer}>"
        assert htmltext.main_blocks(page) == [*[long] * 9, *[short] * 5]
        page = f"<{outer}><h3>Head</h3><div>{f'<p>{long}</p>' * 9}</div><blockquote>Quote</blockquote><pre>code</pre>bare</{outer}>"
        assert htmltext.main_blocks(page) == ["Head", *[long] * 9, "Quote", "code", "bare"]
        page = f"<{outer}><div>{f'<p>{long}</p>' * 9}</div><ul><li>one</li><li>two</li></ul></{outer}>"
        assert htmltext.main_blocks(page) == [*[long] * 9, "one", "two"]
    page = f"<main><h1>Title</h1><p>Lead</p><article>{f'<p>{long}</p>' * 3}</article></main>"
    assert htmltext.main_blocks(page) == ["Title", "Lead", *[long] * 3]
    assert htmltext.main_blocks(f"<article>Short teaser</article><div>{f'<p>{long}</p>' * 3}</div>")[-3:] == [long] * 3


def test_main_text_weighs_furniture_names():
    prose = "Some words, and more words, that read like an article and go on for a good while, as articles do."
    for name in ("content has-sidebar", "no-comments", "header-fixed", "widget", "menu"):
        page = f"""<body><div>Site</div><div id=page class="{name}"><p>{prose}</p><p>{prose}</p>
            <div class="sidebar"><p>{prose}</p></div></div></body>"""
        assert htmltext.main_blocks(page)[-2:] == [prose, prose], name
    assert htmltext.main_blocks(f"<ul><li class=ad>{prose}<li>one, two<li>three</ul><p class=promo>buy<p>{prose}<p>{prose}") == [
        "one, two", "three", prose, prose]
    assert htmltext.main_blocks(f"<div><p class=share>x</div><div><p>{prose}</div>") == [prose]
    assert htmltext.main_blocks(f"<div><p hidden>x</div><div><p>{prose}</div>") == [prose]
    for comment in ("<article class=comment>", "<div class=commentlist>", "<div id=cookieBanner>", "<div class=relatedPosts>"):
        end = f"</{comment[1:].split()[0]}>"
        page = f"<div><article><p>{prose}</p></article>{comment}<p>{prose} {prose} {prose}</p>{end}<p>End, text.</p></div>"
        assert [b for b in htmltext.main_blocks(page) if b != "End, text."] == [prose], comment
    page = f'<article class="post comments-open category-promo"><header><h1>Title</h1></header><p>{prose}</p></article>'
    assert htmltext.main_blocks(page) == ["Title", prose]


def test_main_text_in_forms_and_beside_articles():
    prose = "A long paragraph with several words, commas, and enough text to be counted as prose of the article itself."
    body = f"<h1>Title</h1><p>{prose}</p><p>{prose}</p>"
    controls = "<label>Name</label><input name=a><select><option>one</select><textarea>typed</textarea><button>Send</button>"
    assert htmltext.main_blocks(f"<body><form id=aspnet>{body}{controls}</form></body>") == ["Title", prose, prose]
    assert htmltext.main_blocks(f"<body><nav>x</nav><form><div><main>{body}</main></div></form><p>Foot.</p></body>") == ["Title", prose, prose]
    comment = f"<form><p>Leave a reply</p>{controls}</form>"
    assert htmltext.main_blocks(f"<body><article>{body}{comment}</article></body>") == ["Title", prose, prose]
    assert htmltext.main_blocks(f"<body><form>Search {controls}</form><div>{body}</div></body>") == ["Title", prose, prose]
    two = f"<main><article><h2>One</h2><p>{prose}</p></article><article><h2>Two</h2><p>{prose}</p><p>{prose}</p></article></main>"
    assert htmltext.main_blocks(two) == ["One", prose, "Two", prose, prose]
    teaser = '<article><h2><a href="/x">Another page</a></h2><p><a href="/x">Read it</a></p></article>'
    assert htmltext.main_blocks(f"<main><article>{body}</article>{teaser}</main>") == ["Title", prose, prose]
    assert htmltext.main_blocks(f"<body><div>{body}</div><div><p>A short last paragraph.</p></div></body>")[-1] == "A short last paragraph."
    for away in (f'<div style="color:red; display: none">{prose}</div>', f'<p style="visibility:hidden">{prose}</p>',
                 f'<div class="discussion"><p>{prose}</p></div>', f'<section id="discussion"><p>{prose}</p></section>'):
        assert htmltext.main_blocks(f"<body><article>{body}</article>{away}</body>") == ["Title", prose, prose], away
    paper = f'<article>{body}<section id="discussion"><h2>Discussion</h2><p>{prose}</p></section></article>'
    assert htmltext.main_blocks(paper) == ["Title", prose, prose, "Discussion", prose]


def test_main_text_edge_rows(spark):
    pages = spark.createDataFrame([(None, None, None, "t"), (1, "u", "", "t"), (1, "u", "<p>a</p>" * 50_000, "t")],
                                  "page_id long, url string, html string, text string")
    assert sorted(r.n_chars for r in htmltext.extract(pages).collect()) == [0, 0, 149_998]
    assert htmltext.extract(pages.limit(0)).count() == 0


# 6 -----------------------------------------------------------------------------------------------

def test_language_held_out_accuracy_and_edges(spark, odd):
    docs = table(spark, "documents")
    out = langid.identify(docs).join(docs.select("doc_id", "lang", "text"), "doc_id")
    held = [r for r in out.collect() if r.held_out and r.lang and re.search(r"[^\W\d_]", r.text or "")]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.9 * len(held) > 0
    model = langid.fit(docs)
    rows = langid.predict(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert sorted(r.lang_pred for r in rows).count("und") == 3
    assert langid.predict(odd.limit(0), model).count() == 0


# 7 -----------------------------------------------------------------------------------------------

def _quality_by_hand(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = {}
    for i in range(len(w) - 7):
        at.setdefault(tuple(w[i:i + 8]), []).append(i)
    repeated = {p for places in at.values() if len(places) > 1 for i in places for p in range(i, i + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated),
            len(w) < 20 or 100 * len(repeated) > 30 * len(w))


def test_quality_statistics(spark, odd):
    for docs in (table(spark, "documents"), odd, docs_of(spark, [(1, "a b\x0b" * 40 + "\nx\nx\n \n# $")])):
        want = Counter((r.doc_id, *_quality_by_hand(r.text)) for r in docs.collect())
        out = quality.rule_report(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                               "n_repeat_words", "base_failed", "kept").collect()
        assert Counter(tuple(r)[:7] for r in out) == want
        assert not any(r.kept and r.base_failed for r in out)
        kept = quality.apply_rules(docs)
        assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in out)
    assert quality.rule_report(odd.limit(0)).count() == 0 and quality.apply_rules(odd.limit(0)).count() == 0


def _cascade_by_hand(text, order):
    n, chars, symbols, dup, repeated, _ = _quality_by_hand(text)
    capitals = sum(unicodedata.category(c) == "Lu" for c in text or "")
    fails = {"too_short": n < 20, "repeats": 100 * repeated > 30 * n, "symbols": 4 * symbols > n,
             "capitals": 2 * capitals > chars, "duplicate_lines": 100 * dup > 50 * len((text or "").split("\n")),
             "word_length": chars < 2 * n or chars > 40 * n}
    for place, name in enumerate(order, 1):
        if fails[name]:
            return name, place, False
    return None, len(order), True


def test_quality_cascade(spark, odd, monkeypatch):
    shouted = docs_of(spark, [(i, t) for i, t in enumerate(["LOUD WORDS " * 15, "# " * 30 + "word " * 3, "fine words of a text\n" * 9,
                                                            "a b c d e f g h i j k l m n o p q r s t u v w x y z", None, ""])])
    orders = [list(quality.RULES), list(reversed(quality.RULES))]
    for docs in (table(spark, "documents"), odd, shouted):
        measured = quality.ordered_rules(docs, sample_rows=200)
        assert {r.name for r, _, _ in measured} == {r.name for r in quality.RULES}
        assert all(cost >= 1 and 0 <= share <= 1 for _, cost, share in measured)
        assert [s / c for _, c, s in measured] == sorted((s / c for _, c, s in measured), reverse=True)
        verdicts = []
        for order in orders:
            monkeypatch.setattr(quality, "ordered_rules", lambda *a, order=order, **k: [(r, 1.0, 0.0) for r in order])
            rows = quality.rule_report(docs).select("doc_id", "first_failed", "n_evaluated", "kept").collect()
            names = [r.name for r in order]
            assert Counter(map(tuple, rows)) == Counter((r.doc_id, *_cascade_by_hand(r.text, names)) for r in docs.collect())
            verdicts.append(Counter((r.doc_id, r.kept) for r in rows))
            monkeypatch.undo()
        assert verdicts[0] == verdicts[1]


def test_quality_sample_shares(spark):
    docs = docs_of(spark, [(i, "short" if i % 4 == 0 else f"word{i} " * 5 + " ".join(f"w{i}x{k}" for k in range(30))) for i in range(400)])
    found = {r.name: share for r, _, share in quality.ordered_rules(docs, sample_rows=400)}
    assert found["too_short"] == 0.25 and found["symbols"] == 0.0


# 8 -----------------------------------------------------------------------------------------------

def test_transcripts_recover_roles(spark):
    turns = table(spark, "conversations")
    out = {(r.conv_id, r.turn): r for r in transcripts.recovered(turns).collect()}
    rows = turns.collect()
    right = sum((r.conv_id, r.turn) in out and out[r.conv_id, r.turn].role == r.role for r in rows)
    assert right >= 0.95 * len(rows)
    same = [out[r.conv_id, r.turn] for r in rows if (r.conv_id, r.turn) in out and out[r.conv_id, r.turn].text == r.text.strip()]
    assert len(same) >= 0.95 * len(rows)
    assert all(r.rendered == f"<|{r.role}|>\n{r.text}\n<|end|>" for r in same)


def test_online_viterbi_equals_whole_search(spark):
    model = transcripts.learn(transcripts.as_transcript(table(spark, "conversations")))
    rng = random.Random(3)
    lines = [(rng.choice(["User: hi", "Assistant: yes", "more text", "is it so?", "System: be"]), rng.random() < 0.4)
             for _ in range(1500)]
    search = transcripts._Viterbi(model)
    got = [s for line, blank in lines for s, _, _ in search.step(line, blank)]
    got += [s for s, _, _ in search.finish()]
    emit = [sum(model[k][:, v] for k, v in zip(transcripts.FEATURES, transcripts.observe(*x)[0])) for x in lines]
    score, back = model["start"] + emit[0], []
    for e in emit[1:]:
        paths = score[:, None] + model["move"]
        back.append(paths.argmax(axis=0))
        score = paths.max(axis=0) + e
        score = score - score.max()
    want = [int(score.argmax())]
    for b in reversed(back):
        want.append(int(b[want[-1]]))
    assert got == want[::-1]


def test_transcripts_edge_rows(spark):
    turns = spark.createDataFrame([(1, 0, "user", "hi", "x"), (1, 1, "assistant", None, "x"), (None, 0, None, "lone", "x"),
                                   (2, None, "zz", "", "x"), (4, 0, "user", "a b", "x"), (4, 0, "user", "a b", "x")],
                                  "conv_id long, turn long, role string, text string, rendered string")
    out = transcripts.recovered(turns).collect()
    assert {r.conv_id for r in out} == {1, None, 4}
    assert transcripts.recovered(turns.limit(0)).count() == 0


# 9 -----------------------------------------------------------------------------------------------

def test_decontamination_matches_brute_force(spark, odd):
    docs, items = table(spark, "documents"), table(spark, "benchmark")
    tests = {r.item_id: set(shingles(r.text)) for r in items.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for s in [set(shingles(r.text))] for i, t in tests.items()
            if t and len(s & t) >= 0.8 * len(t)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, items).collect()} == want and want
    clean = decontaminate.clean_documents(docs, items)
    assert clean.columns == docs.columns and clean.count() == docs.count() - len({d for d, _ in want})
    assert decontaminate.clean_documents(odd, items).count() == odd.count()
    assert decontaminate.clean_documents(odd, items.limit(0)).count() == odd.count()
    assert decontaminate.contaminated(odd.limit(0), items).count() == 0


# 10 ----------------------------------------------------------------------------------------------

def test_near_duplicates_of_planted_copies(spark, odd):
    rng = random.Random(9)
    text = [" ".join(f"t{rng.randint(0, 5000)}" for _ in range(300)) for _ in range(12)]
    rows = []
    for c, t in enumerate(text):
        rows.append((10 * c, t))
        for k in range(1, 1 + c % 4):
            w = t.split()
            w[rng.randrange(300)] = f"edit{k}"
            rows.append((10 * c + k, " ".join(w)))
        rows.append((10 * c + 9, t))
    out = {r.doc_id: r for r in neardup.near_duplicate_classes(docs_of(spark, rows)).collect()}
    assert {d: r.class_id for d, r in out.items()} == {d: d // 10 * 10 for d, _ in rows}
    assert all(r.class_size == 2 + d // 10 % 4 for d, r in out.items())
    kept = neardup.one_of_each(docs_of(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == [10 * c for c in range(12)]
    assert neardup.near_duplicate_classes(odd).count() == odd.count()
    assert neardup.near_duplicate_classes(odd.limit(0)).count() == 0


def near_copies(n, edits, seed):
    rng = random.Random(seed)
    base = [f"t{rng.randint(0, 5000)}" for _ in range(180)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.choice(edits)):
            w[rng.randrange(180)] = f"edit{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("block", [neardup.BLOCK, 16])
def test_near_duplicate_classes_match_brute_force(spark, monkeypatch, block):
    """Groups whose pairs lie on both sides of the threshold, so that few members are linked to a centre."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    texts = [t for k, edits in enumerate([(1, 2, 3), (3, 4, 5), (5, 7, 9)]) for t in near_copies(80, edits, k)]
    texts += [r.text for r in table(spark, "documents").limit(60).collect()]
    rows = list(enumerate(texts))
    docs = docs_of(spark, rows)
    idf = neardup.idf_levels(docs)
    s, count, owner = neardup.weighted_sets([t or "" for t in texts])
    w = neardup.weights(s, count, idf)
    sets = [dict(zip(s[owner == i].tolist(), w[owner == i].tolist())) for i in range(len(texts))]
    label, similar = list(range(len(texts))), set()
    for a in range(len(texts)):
        for b in range(a):
            both = sum(min(x, sets[b][k]) for k, x in sets[a].items() if k in sets[b])
            if both and both / (sum(sets[a].values()) + sum(sets[b].values()) - both) >= neardup.THRESHOLD:
                similar.add((b, a))
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = [new if x == old else x for x in label]
    labelled, links, _ = neardup.classes_by_text(docs)
    got = {r.doc_id: r.class_id for r in labelled.collect()}
    node = {r.node: r.doc_id for r in labelled.where("node IS NOT NULL").collect()}
    assert all(tuple(sorted((node[r.a], node[r.b]))) in similar or texts[node[r.a]] == texts[node[r.b]] for r in links.collect())
    assert all(label[i] == label[got[i]] for i in got)
    assert sum(got[a] == got[b] for a, b in similar) >= 0.98 * len(similar) and len(similar) > 1000


def test_one_of_each_with_shared_and_missing_ids(spark):
    """Near copies under one id, or without ids: still one of each class stays."""
    a, b = near_copies(2, [1], 1), near_copies(3, [1], 2)
    rows = [(1, a[0]), (1, a[1]), (None, b[0]), (None, b[1]), (None, b[2]), (7, None), (7, "?")]
    kept = [(r.doc_id, r.text) for r in neardup.one_of_each(docs_of(spark, rows)).collect()]
    assert len(kept) == 4 and sum(i == 1 for i, _ in kept) == 1 and sum(t in b for _, t in kept) == 1
    both = rows + [(5, b[0]), (5, b[0])]
    kept = [(r.doc_id, r.text) for r in neardup.one_of_each(docs_of(spark, both)).collect()]
    assert len(kept) == 4 and (5, b[0]) in kept


# pipeline ----------------------------------------------------------------------------------------

def test_pipeline_stages_keep_columns_and_take_effect(spark):
    import corpus_pipeline as pipeline

    docs = table(spark, "documents")
    whole = docs.columns
    for name, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF_SMALL)
        assert after.columns == whole, name
        assert after.count() <= docs.count()
        docs = after
    last = pipeline.run(spark, SF_SMALL)
    assert {r.doc_id for r in last.collect()} == {r.doc_id for r in docs.collect()}
    assert last.where("not exact").count() == 0


def test_registered_queries():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(k.startswith(f"op{n}_") for k in names) for n in range(1, 11))
    assert set(entry.oracle_sql()) <= set(names)


def test_ids_by_piece_are_those_of_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["<|endoftext|> a", "  two  spaces \n\n x", "it's 'tis don't 've we'll 's", "tab\t\tx \r\n y ", "12a34 5é…", "", "'", "''s",
             "naïve – “quote” …  ", "日本語 text", " nbsp x ", "a\x1cb\x0bc", "x  'll  ", "\n \n", "ſ Œ œ ß", "$%&  #", "Ⅷ ½ ²"]
    rng = random.Random(4)
    texts += ["".join(rng.choice("ab é's \n\t12.,'‘😀　") for _ in range(60)) for _ in range(300)]
    plain, coder = Tokenizer.from_file(path), repair.Coder(path)
    for part in (texts[:9], texts[9:], texts):
        assert [x.tolist() for x in coder.encode(part)] == [x.ids for x in plain.encode_batch(part, add_special_tokens=False)]


def test_plain_texts_are_cut_as_the_tokenizer_cuts_them():
    import public_tokenizers
    from tokenizers import Tokenizer

    path, rng = str(public_tokenizers.path("byte_bpe_50k.json")), random.Random(6)
    texts = ["", "'", "'s", "re", "e'll", "a'", " \n x", "", "x \n\n", "''ve 've", "'st're'm"]
    for letters in ("ab é's \n\t12.,'‘", "'strevmld ", "  \n\r\tx1.' ", "ñß «»a'"):
        texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(500)]
    assert all(map(repair._PLAIN.fullmatch, texts))
    plain, coder = Tokenizer.from_file(path), repair.Coder(path)
    want = [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in coder.encode(texts)] == want
    assert [coder.encode([t])[0].tolist() for t in texts[:50]] == want[:50]


def test_archive_with_a_changed_byte_is_refused(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "short payload"), (2, "u", "x" * 200_000)], "page_id long, url string, html string")
    for name, old, new in (("short", "short payload", "short paylaod"), ("long", "x" * 70_000, "x" * 69_999 + "y")):
        path = str(tmp_path / name)
        rows = warc.classified(pages)
        warc.write_archives(rows.withColumn("html", F.replace("html", F.lit(old), F.lit(new))), path)
        with pytest.raises(Exception, match="does not match its header"):
            warc.read_records(spark, path).collect()


def test_decontamination_by_row_and_short_items(spark):
    """A clean row stays though another one under its id, or also without one, holds an item; short items count."""
    item, clean = "one two three four five six seven eight", "nothing of that kind is in this text at all"
    rows = [(7, f"x {item} y"), (7, clean), (None, f"{item} z"), (None, clean), (8, clean), (9, "Short item"), (10, "a short item"),
            (11, None), (12, "")]
    items = spark.createDataFrame([(1, item, 0), (2, "short, item!", 0), (3, None, 0), (4, "", 0)], "item_id long, text string, hash int")
    docs = docs_of(spark, rows)
    kept = decontaminate.clean_documents(docs, items)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted(
        (i or 0, t or "") for i, t in rows if t in (clean, "a short item", None, ""))
    found = {(r.doc_id, r.item_id, r.n_item) for r in decontaminate.contaminated(docs, items).collect()}
    assert found == {(7, 1, 4), (None, 1, 4), (9, 2, 1)}
