"""Typed ingestion.

The studies read comma, semicolon and tab separated text, with a header, with
``NA`` as the missing marker, sometimes with quoted multi-line text and with
decimal commas. Reading with an explicit schema avoids the inference pass over
the whole file (one full extra scan at 100 TB) and the string-comparison traps
of untyped columns (T1, T2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False,
               refresh: bool = False) -> DataFrame:
    """One Parquet test table; filters and projections reach the scan.

    The given tables are read-only, so the relation (file listing and Parquet
    footer) is resolved once per application and path; ``refresh=True`` lists
    the files again.

    ``spread=True`` is for fact tables: when the files give fewer input splits
    than the cluster's default parallelism (one file with one row group, as
    in the small test data), the rows are spread round-robin so the stages
    after the scan use every core. On large inputs the scan already has more
    splits than cores and nothing is added.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    rkey = (spark.sparkContext.applicationId, path)
    if refresh or rkey not in _RELATIONS:
        _RELATIONS[rkey] = spark.read.parquet(path)
    df = _RELATIONS[rkey]
    if spread:
        want = spark.sparkContext.defaultParallelism
        key = (spark.sparkContext.applicationId, path)
        if key not in _SPLITS:
            _SPLITS[key] = df.rdd.getNumPartitions()
        if _SPLITS[key] < want:
            df = df.repartition(want)
    return df


_SPLITS: dict[tuple[str, str], int] = {}
_RELATIONS: dict[tuple[str, str], DataFrame] = {}


def read_delimited(spark: SparkSession, path: str, schema: StructType | str | None = None,
                   sep: str = ",", header: bool = True, null_value: str = "NA",
                   quoted_multiline: bool = False, decimal_comma_columns: tuple[str, ...] = (),
                   infer: bool = False, timestamp_format: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    """Delimited text with header.

    ``schema`` is the normal case. ``infer=True`` samples the file for types
    (the reference's ``inferSchema``), which costs an extra pass. Columns named
    in ``decimal_comma_columns`` are read as text and converted from ``1,5`` to
    ``1.5`` with ``try_cast`` so a bad value becomes null instead of failing
    the job.
    """
    reader = (spark.read.option("header", header).option("sep", sep)
              .option("nullValue", null_value).option("mode", "PERMISSIVE")
              .option("timestampFormat", timestamp_format).option("timestampNTZFormat", timestamp_format))
    if quoted_multiline:
        reader = reader.option("quote", '"').option("escape", '"').option("multiLine", True)
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if decimal_comma_columns:
        # read those columns as strings, convert afterwards
        if isinstance(schema, StructType):
            schema = StructType([
                StructField(f.name, f.dataType if f.name not in decimal_comma_columns else StringType(), True)
                for f in schema.fields])
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    df = reader.csv(path)
    if infer and schema is None:
        # inferred timestamps stay wall-clock values, as written in the text,
        # whatever the session time zone
        from pyspark.sql.types import TimestampType
        df = df.withColumns({f.name: F.col(f"`{f.name}`").cast("timestamp_ntz")
                             for f in df.schema.fields if isinstance(f.dataType, TimestampType)})
    if decimal_comma_columns:
        df = df.withColumns({c: F.regexp_replace(F.col(c), ",", ".").try_cast(DoubleType())
                             for c in decimal_comma_columns})
    return df


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names shared storage every executor
    can reach; a machine-local temporary folder would not survive the loss of
    that machine.
    """
    import uuid

    from tessera.session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/tessera-scratch/{name}-{uuid.uuid4().hex}"


def write_text_table(df: DataFrame, path: str, sep: str = ",", null_value: str = "NA",
                     quote_all_text: bool = False) -> None:
    """Delimited text with header, timestamps as ``yyyy-MM-dd HH:mm:ss``, ``NA`` for null."""
    w = (df.write.mode("overwrite").option("header", True).option("sep", sep)
         .option("nullValue", null_value).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
         .option("timestampFormat", "yyyy-MM-dd HH:mm:ss").option("escape", '"')
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if quote_all_text:
        w = w.option("quoteAll", True)
    w.csv(path)
