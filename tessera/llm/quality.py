"""Quality rules as a short-circuit cascade of Spark expressions (no Python in the tasks).

Every rule is a statistic of the text and a condition on it. Cost and
selectivity are estimated on a sample of the whole table; the cascade is one
CASE expression that tests the rules in the order of rejections per cost, and
Spark evaluates a later branch only for texts that passed the earlier ones.
The order changes the cost, never the verdict.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import written

SPACE = r"[\x20\x09-\x0D]+"
WINDOW = 8


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text."""
    return F.array_remove(F.split(text, SPACE), "")


def repeated_words(word_list: Column, window: int = WINDOW) -> Column:
    """Number of words inside a ``window``-word window that occurs twice or more in the text.

    Windows are compared by 64-bit hashes, built by doubling (pairs of words,
    pairs of pairs, ...). A text without a repeated window stops there; else
    equal neighbours in sorted order give the repeated start positions, and
    the gaps between those the words they cover.
    """
    if window & (window - 1):
        raise ValueError("the window is a power of two")

    def doubled(h: Column, step: int) -> Column:
        if step == window:
            return F.slice(h, 1, F.greatest(F.size(h) - (window - 1), F.lit(0)))
        return let(F.zip_with(h, F.slice(h, step + 1, F.size(h)), lambda a, b: F.xxhash64(a, b)),
                   lambda g: doubled(g, 2 * step))

    def covered(pos: Column) -> Column:
        gaps = F.zip_with(F.slice(pos, 1, F.size(pos) - 1), F.slice(pos, 2, F.size(pos)),
                          lambda a, b: F.least(F.lit(window), b - a))
        return F.aggregate(gaps, F.lit(window), lambda total, x: total + x)

    def starts(s: Column) -> Column:
        same = lambda e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
        twice = F.filter(s, lambda e, k: same(e, k - 1) | same(e, k + 1))
        return F.array_sort(F.transform(twice, lambda e: e["i"]))

    def count(grams: Column) -> Column:
        ranked = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0)).otherwise(
            let(ranked, lambda s: let(starts(s), covered)))

    return let(word_list, lambda w: let(doubled(w, 1), count))


def duplicate_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
               lambda lines: F.size(lines) - F.size(F.array_distinct(lines)))


#: Statistics by name: expressions of a text and its words.
STATISTICS: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda text, w: F.size(w),
    "word_chars": lambda text, w: F.length(F.array_join(w, "")),
    "n_symbols": lambda text, w: F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", "")),
    "n_dup_lines": lambda text, w: duplicate_lines(text),
    "n_repeat_words": lambda text, w: repeated_words(w),
    "n_capitals": lambda text, w: F.length(F.regexp_replace(text, r"\P{Lu}+", "")),
    "n_lines": lambda text, w: F.size(F.split(text, "\n")),
}


@dataclass(frozen=True)
class Rule:
    """``fails`` gets the statistics it names and says whether the text is rejected."""

    name: str
    needs: tuple[str, ...]
    fails: Callable[..., Column]


BASE = (
    Rule("too_short", ("n_words",), lambda n: n < 20),
    Rule("repeats", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 30 * n),
)
RULES = (
    *BASE,
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 4 * s > n),
    Rule("capitals", ("n_capitals", "word_chars"), lambda u, c: 2 * u > c),
    Rule("duplicate_lines", ("n_dup_lines", "n_lines"), lambda d, n: 100 * d > 50 * n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 40 * n)),
)


def whole_text() -> Column:
    """The text; a null text is empty."""
    return F.coalesce("text", F.lit(""))


def _condition(rule: Rule, text: Column, word_list: Column, counted: Collection[str] = ()) -> Column:
    """The rule on a text and its words; statistics named in ``counted`` are columns already."""
    return rule.fails(*[F.col(s) if s in counted else STATISTICS[s](text, word_list) for s in rule.needs])


def ordered_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 512, repeats: int = 3,
                  seed: int = 7) -> list[tuple[Rule, float, float]]:
    """``(rule, mean cost in nanoseconds, share rejected)`` by falling rejections per cost.

    The sample holds ``sample_rows`` rows in expectation, each row of the
    table with the same chance, and is written with its words in the shared
    folder. One job judges every sampled row by every rule, ``repeats`` times
    with the JVM's clock read before and after; the shortest time of a row
    counts, so pauses and waiting tasks don't. An empty sample leaves the
    order as given. The driver gets one row per rule.
    """
    share = min(1.0, sample_rows / max(docs.count(), 1))
    text = F.col("text")
    sample = written(docs.select(whole_text().alias("text")).sample(fraction=share, seed=seed)
                     .select("text", words(text).alias("words")), "quality-sample")
    now = F.expr("java_method('java.lang.System', 'nanoTime')")
    judged = None
    for number, rule in enumerate(rules):
        one = sample.select(F.xxhash64("text").alias("row"), "text", "words",
                            F.explode(F.sequence(F.lit(1), F.lit(repeats)))).select(
            F.lit(number).alias("rule"), "row",
            F.struct(now.alias("began"), _condition(rule, text, F.col("words")).alias("failed"), now.alias("ended")).alias("t"))
        judged = one if judged is None else judged.unionByName(one)
    rows = judged.groupBy("rule", "row").agg(
        F.min(F.col("t.ended").cast("long") - F.col("t.began").cast("long")).alias("cost"),
        F.bool_or("t.failed").alias("failed"), (F.count(F.lit(1)) / repeats).alias("n"))
    found = {r.rule: (max(float(r.cost), 1.0), float(r.rejected)) for r in rows.groupBy("rule").agg(
        (F.sum(F.col("cost") * F.col("n")) / F.sum("n")).alias("cost"),
        (F.sum(F.when(F.col("failed"), F.col("n")).otherwise(0.0)) / F.sum("n")).alias("rejected")).collect()}
    out = [(rule, *found.get(number, (1.0, 0.0))) for number, rule in enumerate(rules)]
    return sorted(out, key=lambda x: (-x[2] / x[1], x[1]))


def first_failure(rules: Sequence[Rule], condition: Callable[[Rule], Column]) -> Column:
    """Place (from 1) of the first rule that rejects the text, null if none does; later rules aren't evaluated."""
    chain = None
    for place, rule in enumerate(rules, 1):
        test = condition(rule)
        chain = F.when(test, place) if chain is None else chain.when(test, place)
    return chain


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES, **sampling) -> DataFrame:
    """``docs`` that no rule rejects, all columns kept.

    A null or empty text has no word and is rejected by ``too_short``. Rows
    are judged one by one, so repeated rows share a verdict and nothing
    depends on doc_id. Columns named like a statistic don't disturb: only
    ``text`` is read. An empty table stays empty.
    """
    order = [r for r, _, _ in ordered_rules(docs, rules, **sampling)]
    failed = let(whole_text(), lambda text: let(
        words(text), lambda w: first_failure(order, lambda rule: _condition(rule, text, w))))
    return docs.where(failed.isNull())


#: Statistics that the report returns for every document; the others are counted only where the cascade asks for them.
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def rule_report(docs: DataFrame, rules: Sequence[Rule] = RULES, **sampling) -> DataFrame:
    """One row per document: ``doc_id``, the reported statistics, ``base_failed`` and the verdict of the cascade.

    The cascade runs as in ``apply_rules``: ``first_failed`` names the rule
    that ended it (null if none did), ``n_evaluated`` counts the rules it
    tested, ``kept`` is true where it came to its end. Null and empty texts,
    repeated rows and empty tables as there; a null doc_id stays null.
    """
    order = [r for r, _, _ in ordered_rules(docs, rules, **sampling)]
    text, word_list = F.col("text"), F.col("words")
    cut = docs.select("doc_id", whole_text().alias("text")).withColumn("words", words(text))
    counted = cut.select("*", *[STATISTICS[s](text, word_list).cast("long").alias(s) for s in REPORTED])
    place = first_failure(order, lambda rule: _condition(rule, text, word_list, REPORTED))
    judged = counted.select("doc_id", *REPORTED, place.alias("place"))
    failed = BASE[0].fails(*map(F.col, BASE[0].needs))
    for rule in BASE[1:]:
        failed = failed | rule.fails(*map(F.col, rule.needs))
    names = F.array(*[F.lit(r.name) for r in order])
    return judged.select(
        "doc_id", *REPORTED, failed.alias("base_failed"), F.get(names, F.col("place") - 1).alias("first_failed"),
        F.coalesce("place", F.lit(len(order))).alias("n_evaluated"), (~failed & F.col("place").isNull()).alias("kept"))
