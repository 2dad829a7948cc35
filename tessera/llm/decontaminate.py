"""Benchmark decontamination: size-partitioned MinHash containment search, all in Spark expressions.

Test items are short, documents long, so the Jaccard similarity of a pair is
tiny even if the document holds the whole item, and MinHash bands would
need thousands of hashes per document. The containment form used here keeps
MinHash on the short side: items are partitioned by size (powers of two),
and an item is represented by its smallest shingle hashes, as many as its
size class needs so that a document holding ``threshold`` of the item must
hold at least one of them. Retrieval has therefore no misses. Documents are
probed with all their shingle hashes (an equi-join against the items'
minima), and candidates are verified by the exact containment of shingle
texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.quality import let
from tessera.llm.shared import written
from tessera.llm.shingles import SIZE, words_column
from tessera.operators.joins import checked_broadcast

THRESHOLD = 0.8
#: Items whose shingles may be broadcast as texts, some two KB each.
FEW_ITEMS = 20_000


def shingle_hashes(words: Column) -> Column:
    """64-bit hashes of the five-word shingles, repeats included; of one to four words the hash of all, of none nothing."""
    shifted = lambda a, b, step: F.zip_with(a, F.slice(b, step + 1, F.size(b)), lambda x, y: F.xxhash64(x, y))
    five = lambda h: F.slice(shifted(let(shifted(h, h, 1), lambda p: shifted(p, p, 2)), h, 4),
                             1, F.greatest(F.size(h) - (SIZE - 1), F.lit(0)))
    return let(words, lambda h: F.when(F.size(h).between(1, SIZE - 1), F.array(F.xxhash64(F.array_join(h, " "))))
               .otherwise(five(h)))


def shingle_texts(words: Column) -> Column:
    """Distinct five-word shingles as texts; one to four words are one shingle, none has none."""
    return let(words, lambda held: F.array_distinct(F.transform(
        F.when(F.size(held) > 0, F.sequence(F.lit(1), F.greatest(F.size(held) - (SIZE - 1), F.lit(1))))
        .otherwise(F.array().cast("array<int>")), lambda i: F.array_join(F.slice(held, i, SIZE), " "))))


def minima(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(hash, item_id)``: the smallest shingle hashes of each item.

    With ``q`` shingles, of which ``ceil(threshold * q)`` must be found, any
    ``q - ceil(threshold * q) + 1`` of them include a found one. The number
    is taken at the upper bound of the item's size class.
    """
    hashed = items.select("item_id", F.array_sort(F.array_distinct(shingle_hashes(words_column(F.col("text")))))
                          .alias("h")).where(F.size("h") > 0)
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.size("h"))))
    enough = (upper - F.ceil(F.lit(threshold) * upper) + 1).cast("int")
    return hashed.select("item_id", F.explode(F.slice("h", 1, F.least(enough, F.size("h")))).alias("hash"))


def contaminated_rows(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, text_hash, item_id, n_item, n_shared)`` of every row and item that match.

    A row is told from others by its doc_id and the hash of its text.
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    items = items.select("item_id", "text").distinct()
    keys = checked_broadcast(minima(items, threshold).distinct())
    probes = docs.select("doc_id", "text_hash", F.explode(shingle_hashes(words_column(F.col("text")))).alias("hash"))
    found = written(probes.join(keys, "hash").select("doc_id", "text_hash", "item_id").distinct(), "candidates")

    row = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_hash") == F.col("t"))
    pairs = found.select(F.col("doc_id").alias("d"), F.col("text_hash").alias("t"), F.col("item_id").alias("i"))
    rows = checked_broadcast(pairs.select("d", "t").distinct())
    held = docs.join(rows, row, "left_semi").select(
        "doc_id", "text_hash", shingle_texts(words_column(F.col("text"))).alias("held"))
    wanted = checked_broadcast(items.select("item_id", shingle_texts(words_column(F.col("text"))).alias("wanted")), FEW_ITEMS)
    both = (held.join(checked_broadcast(pairs), row)
            .join(wanted, F.col("i").eqNullSafe(F.col("item_id")))
            .select("doc_id", "text_hash", "item_id", F.size("wanted").cast("long").alias("n_item"),
                    F.size(F.array_intersect("wanted", "held")).cast("long").alias("n_shared")))
    return both.where(F.col("n_shared") >= F.lit(threshold) * F.col("n_item")).where("n_item > 0")


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs ``(doc_id, item_id, n_item, n_shared, containment)`` with at least ``threshold`` of the item in the document.

    ``docs(doc_id, text)``, ``items(item_id, text)``; other columns are
    ignored. Texts are lower-cased and cut at anything but letters, digits
    and non-ASCII characters. An item, and a document, of one to four words
    has one shingle, all its words: such an item is found in documents that
    hold just these words. Null and empty texts match nothing. Rows that
    share a doc_id are judged one by one and reported once, with the largest
    share; a null doc_id or item_id is a value like any other. Empty tables
    give no rows.
    """
    return (contaminated_rows(docs, items, threshold)
            .groupBy("doc_id", "item_id").agg(F.max_by(F.struct("n_item", "n_shared"), F.col("n_shared") / F.col("n_item"))
                                              .alias("_m"))
            .select("doc_id", "item_id", "_m.n_item", "_m.n_shared",
                    F.round(F.col("_m.n_shared") / F.col("_m.n_item"), 6).alias("containment")))


def clean_documents(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose own text holds a test item; all columns stay."""
    dirty = written(contaminated_rows(docs, items, threshold)
                    .select(F.col("doc_id").alias("_dirty"), F.col("text_hash").alias("_hash")).distinct(), "dirty")
    return docs.join(checked_broadcast(dirty), docs["doc_id"].eqNullSafe(F.col("_dirty"))
                     & (F.xxhash64(docs["text"]) == F.col("_hash")), "left_anti")
