"""Registered title-study queries with their oracles."""

from __future__ import annotations

from tessera.catalog.fixture_sql import r_up
from tessera.catalog.registry import register
from tessera.plans import titles as TI
from tessera.sources import bindings as B

# Title types of the binding standing for the study's tvEpisode, short, tvMovie.
EPISODE, SHORT, TV_MOVIE = "src3", "src5", "src7"
WORDS = r"CAST(len(regexp_extract_all(primaryTitle, '\S+')) AS INTEGER)"


@register("q_title_types", """
SELECT titleType, count(*) AS "count", (SELECT count(*) FROM (SELECT DISTINCT titleType FROM titles)) AS n_types
FROM titles WHERE titleType IS NOT NULL GROUP BY 1""")
def q_title_types(spark, sf):
    return TI.title_types(B.titles(spark, sf))


@register("q_title_slice", "SELECT titleType, primaryTitle, startYear, runtimeMinutes FROM titles")
def q_title_slice(spark, sf):
    return TI.title_slice(B.titles(spark, sf))


@register("q_title_episodes", f"SELECT * FROM titles WHERE titleType = '{EPISODE}'")
def q_title_episodes(spark, sf):
    return TI.titles_of_type(B.titles(spark, sf), EPISODE)


@register("q_adult_share", """
SELECT isAdult, count(*) AS "count", (SELECT avg(isAdult) FROM titles) AS mean_isAdult
FROM titles WHERE isAdult IS NOT NULL GROUP BY 1""")
def q_adult_share(spark, sf):
    return TI.adult_share(B.titles(spark, sf))


@register("q_short_runtime", f"SELECT {r_up('avg(runtimeMinutes)', 6)} AS mean_runtime FROM titles "
          f"WHERE titleType = '{SHORT}'")
def q_short_runtime(spark, sf):
    return TI.mean_runtime(B.titles(spark, sf), SHORT, digits=6)


@register("q_short_long_titles", f"""
SELECT *, {WORDS} AS words_in_title FROM titles
WHERE titleType = '{TV_MOVIE}' AND {WORDS} >= 3 AND runtimeMinutes < 75""")
def q_short_long_titles(spark, sf):
    return TI.typed_titles_by_words(B.titles(spark, sf), TV_MOVIE)


@register("q_short_long_titles_asis", f"""
SELECT *, {WORDS} AS words_in_title FROM titles
WHERE titleType = '{TV_MOVIE}' AND {WORDS} > 3 AND runtimeMinutes < 75""")
def q_short_long_titles_asis(spark, sf):
    return TI.typed_titles_by_words(B.titles(spark, sf), TV_MOVIE, as_is=True)
