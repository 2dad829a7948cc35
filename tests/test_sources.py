"""Delimited ingestion on small written files."""

from pyspark.sql import functions as F

from tessera.sources.io import read_delimited, scratch_path, write_text_table


def test_na_and_blanks_round_trip(spark):
    df = spark.createDataFrame([(1, "  padded ", None), (2, "a,b", 3.5), (3, 'say "hi"\nnext', -0.25)],
                               "id int, txt string, x double")
    path = scratch_path(spark, "t-csv")
    write_text_table(df, path)
    back = read_delimited(spark, path, "id int, txt string, x double", quoted_multiline=True)
    assert sorted(back.collect()) == sorted(df.collect())


def test_strings_then_try_cast(spark):
    df = spark.createDataFrame([("1", "12"), ("2", "NA"), ("3", "oops")], "id string, d string")
    path = scratch_path(spark, "t-str")
    write_text_table(df, path, null_value="")
    text = read_delimited(spark, path, "id string, d string")
    got = {r["id"]: r["d"] for r in text.select("id", F.col("d").try_cast("int").alias("d")).collect()}
    assert got == {"1": 12, "2": None, "3": None}


def test_semicolon_decimal_comma(spark):
    df = spark.createDataFrame([(1, "1,5"), (2, "-0,25"), (3, "x")], "k int, v string")
    path = scratch_path(spark, "t-dec")
    write_text_table(df, path, sep=";")
    back = read_delimited(spark, path, "k int, v double", sep=";", decimal_comma_columns=("v",))
    assert {r["k"]: r["v"] for r in back.collect()} == {1: 1.5, 2: -0.25, 3: None}


def test_tab_separated_and_inference(spark):
    df = spark.createDataFrame([(1, "a\tb", 2.5), (2, "c", None)], "id int, t string, v double")
    path = scratch_path(spark, "t-tsv")
    write_text_table(df, path, sep="\t")
    back = read_delimited(spark, path, sep="\t", infer=True, quoted_multiline=True)
    assert dict(back.dtypes) == {"id": "int", "t": "string", "v": "double"}
    assert sorted(back.collect()) == sorted(df.collect())
