"""Plumbing used by several operators: written tables in the shared folder, row batches."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tessera.session import ensure_checkpoint_dir, ship_package

#: Bytes of a batch that stand in memory as Python objects at a time.
SLICE = 1 << 22
#: Rows of an Arrow batch where rows hold whole texts: some MB, on both sides of the socket.
WIDE_ROWS = 1000


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path below the folder named by ``spark.checkpoint.dir`` (shared by all executors)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage, survives lost executors."""
    ship_package(df.sparkSession)
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_text_size(batches: Iterator[pd.DataFrame], column: str, limit: int = 1 << 20) -> Iterator[pd.DataFrame]:
    """Cut row batches so that each holds about ``limit`` characters of ``column`` (at least one row)."""
    for batch in batches:
        sizes = batch[column].str.len().fillna(0).to_numpy(dtype="int64")
        start, total = 0, 0
        for i, n in enumerate(sizes):
            if i > start and total + n > limit:
                yield batch.iloc[start:i]
                start, total = i, 0
            total += int(n)
        if start < len(batch):
            yield batch.iloc[start:]


def map_batches(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``mapInPandas`` with the package shipped to the executors first."""
    ship_package(df.sparkSession)
    return df.mapInPandas(fn, schema)


def release_memory() -> None:
    """Hand memory that a finished task freed back to the system; workers live on from task to task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


class Slots(dict):
    """Numbers of distinct strings in order of appearance, and how often each was asked for."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []
        self.uses = np.empty(0, np.int64)

    def __missing__(self, string) -> int:
        self[string] = slot = len(self)
        self.fresh.append(string)
        return slot

    def of(self, strings: list, times: np.ndarray | int = 1) -> np.ndarray:
        """The strings' numbers, asked for so many times; new strings get the next ones."""
        slots = np.fromiter(map(self.__getitem__, strings), np.int64, len(strings))
        if len(self) > len(self.uses):
            self.uses = np.append(self.uses, np.zeros(max(len(self.uses), len(self)), np.int64))
        np.add.at(self.uses, slots, times)
        return slots

    def taken(self) -> list:
        """The strings that are new since the last call, in order."""
        fresh, self.fresh = self.fresh, []
        return fresh

    def trim(self, n: int) -> np.ndarray:
        """Keep the ``n`` strings asked for most, renumbered in their order: the numbers they had. Counts are halved."""
        stay = np.sort(np.argsort(-self.uses[:len(self)], kind="stable")[:n])
        strings = list(self)
        self.clear()
        self.update(zip((strings[k] for k in stay.tolist()), range(n)))
        self.uses = self.uses[stay] // 2
        return stay


def joined(start: np.ndarray, count: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The runs of ``count`` values from each ``start``, one after another."""
    end = np.cumsum(count)
    return values[np.repeat(start - (end - count), count) + np.arange(end[-1] if len(end) else 0)]


def packed(start: np.ndarray, count: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(start, count, values)`` with the runs' values only, in order."""
    return np.cumsum(count) - count, count, joined(start, count, values)


_TABLES: dict[tuple, object] = {}


def process_table(key: tuple, build: Callable[[], object]) -> object:
    """A table that tasks of one operator share in this process; it takes the place of any other operator's."""
    if key not in _TABLES:
        drop_tables()
        _TABLES[key] = build()
    return _TABLES[key]


def drop_tables() -> None:
    """Forget what earlier operators' tasks left in this process, before a task that has its own needs."""
    if _TABLES:
        _TABLES.clear()
        release_memory()


def wide_rows(spark: SparkSession) -> None:
    """Smaller Arrow batches in this session from now on, unless it has a number of its own."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":  # the default
        spark.conf.set(key, str(WIDE_ROWS))


def map_slices(df: DataFrame, fn: Callable, schema: str, size: int = SLICE) -> DataFrame:
    """``map_batches`` for wide rows: ``fn`` sees frames of about ``size`` bytes, so that Spark's batches of
    10,000 rows never stand in memory as Python strings. Columns of plain types and arrays only."""
    ship_package(df.sparkSession)
    wide_rows(df.sparkSession)
    target = to_arrow_schema(StructType.fromDDL(schema))

    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = max(1, int(batch.num_rows * size / max(batch.nbytes, 1)))
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows).to_pandas()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_tables()
        try:
            for out in fn(frames(batches)):
                yield pa.RecordBatch.from_pandas(out, schema=target, preserve_index=False)
        finally:
            release_memory()

    return df.mapInArrow(run, schema)
