"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (decontaminate, htmltext, langid, lexical, licenses, nbest, neardup, quality, repair, simhash, transcripts,
                         trie, warc)
from tessera.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return add


@query("op6_language_id")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out third."""
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op7_quality_rules", r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY 1),
s AS (
  SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
          - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))))::BIGINT
           AS n_dup_lines,
         coalesce(r.n, 0)::BIGINT AS n_repeat_words,
         length(regexp_replace(text, '\P{Lu}', '', 'g')) AS n_capitals, len(string_split(text, chr(10))) AS n_lines
  FROM d LEFT JOIN repeats r USING (doc_id)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT 4 * n_symbols > n_words AND NOT 2 * n_capitals > word_chars
       AND NOT 100 * n_dup_lines > 50 * n_lines AND NOT (word_chars < 2 * n_words OR word_chars > 40 * n_words) AS kept
FROM b
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of the quality rules for every document."""
    return quality.rule_report(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op9_decontaminate", r"""
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents
  UNION ALL
  SELECT 'i', item_id, regexp_extract_all(lower(text), '[0-9a-z\x{80}-\x{10FFFF}]+') FROM benchmark),
grams AS (SELECT DISTINCT side, id, array_to_string(w[i:i + 4], ' ') AS g
          FROM (SELECT side, id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0)),
items AS (SELECT id, count(*) AS n FROM grams WHERE side = 'i' GROUP BY 1),
shared AS (SELECT d.id AS doc_id, i.id AS item_id, count(*) AS k
           FROM grams d JOIN grams i ON d.side = 'd' AND i.side = 'i' AND d.g = i.g GROUP BY 1, 2)
SELECT doc_id, item_id, n AS n_item, k AS n_shared, round(k / n, 6) AS containment
FROM shared JOIN items ON items.id = item_id WHERE k >= 0.8 * n
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least 0.8 of a test item's five-word shingles."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_near_duplicates")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    return neardup.near_duplicate_classes(table(spark, sf_dir, "documents"))


@query("op3_sentencepiece_nbest")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score, ids, number of pieces and digest of the four best segmentations of every document, and their round trip."""
    return nbest.segmented(table(spark, sf_dir, "documents"))


@query("op2_repair_shards")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start, length and checksum of every document's ids, read back from Re-Pair shards."""
    return repair.round_trip(table(spark, sf_dir, "documents"))


@query("op4_warc_records")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record type and payload digest of every page, read back from WARC archives."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@query("op5_main_text")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


@query("op1_license_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License templates and short notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"), notices=licenses.SHORT_NOTICES)


@query("op8_transcript_turns")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns recovered from raw transcripts of all conversations, rendered."""
    return transcripts.recovered(table(spark, sf_dir, "conversations"))


@query("op12_simhash_components")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint of every document and its component under at most three differing bits."""
    return simhash.components(table(spark, sf_dir, "documents"))


@query("op13_conversation_trie", r"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
cs AS (SELECT DISTINCT c, c - c % 5 AS b, xor(4294967295::BIGINT, list_reduce(
         list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT),
         lambda u, ch: list_reduce(range(8), lambda v, k: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END,
                                   xor(u, ch)), 4294967295::BIGINT)) % 9 AS h FROM t),
turns AS (SELECT cs.c, 0 AS side, pos, r, x FROM cs JOIN t ON t.c = cs.b AND pos < h
          UNION ALL SELECT cs.c, 1, pos, r, x FROM cs JOIN t ON t.c = cs.c AND pos >= h),
seq AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY side, pos) AS d, octet_length(encode(x)) AS b,
               md5(octet_length(encode(r)) || ':' || r || x) AS g FROM turns),
pre AS (SELECT c, d, b, string_agg(g, '') OVER (PARTITION BY c ORDER BY d) AS k FROM seq UNION ALL SELECT c, 0, 0, '' FROM cs),
lengths AS (SELECT c, max(d) AS n FROM pre GROUP BY c),
nodes AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(b) AS saved,
                 coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends
          FROM pre JOIN lengths USING (c) GROUP BY k, d),
children AS (SELECT left(k, 32 * (d - 1)) AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
valued AS (SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (k)),
totals AS (SELECT left(k, 32 * e) AS k, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
           FROM (SELECT *, unnest(range(d + 1)) AS e FROM valued) GROUP BY 1)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, n_leaves, saved_tokens,
       sha256(v.ends) AS ends_sha256
FROM valued v JOIN totals ON totals.k = v.k LEFT JOIN nodes p ON v.d > 0 AND p.k = left(v.k, 32 * (v.d - 1))
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all rebuilt conversations with subtree totals."""
    return trie.rollup(table(spark, sf_dir, "conversations")).drop("key", "parent")


@query("op11_ranked_search", r"""
WITH lowered AS (
  SELECT 'd' AS side, row_number() OVER () AS r, doc_id AS id,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents
  UNION ALL
  SELECT 'i', item_id, item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
counted AS (SELECT side, r, id, t, count(*) AS tf
            FROM (SELECT side, r, id, unnest(regexp_extract_all(x, '[0-9a-z\x{80}-\x{10FFFF}]+')) AS t FROM lowered)
            GROUP BY side, r, id, t),
sizes AS (SELECT r, sum(tf)::BIGINT AS n FROM counted WHERE side = 'd' GROUP BY r),
corpus AS (SELECT count(*) AS nd, sum(n)::BIGINT AS l FROM sizes),
wanted AS (SELECT id AS item_id, t, tf AS times FROM counted WHERE side = 'i'),
held AS (SELECT r, id AS doc_id, t, tf FROM counted WHERE side = 'd' AND t IN (SELECT t FROM wanted)),
weights AS (SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM held, corpus GROUP BY t, nd),
scores AS (SELECT item_id, h.r, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * nd) // l))))::BIGINT AS score
           FROM wanted JOIN held h USING (t) JOIN weights USING (t) JOIN sizes ON sizes.r = h.r, corpus GROUP BY item_id, h.r, doc_id)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents for every test item, with exact scores."""
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
