"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tessera.session import work_path

#: Most rows of a lookup table (a few dozen bytes each) that may be broadcast; a count is checked first.
BROADCAST_ROWS = 50_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship_by_value(module: str) -> None:
    """Pickle a module's functions by value, so that workers need no package install."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship_by_value(__name__)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared checkpoint folder."""
    return work_path(spark, f"llm-{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def running_offsets(df: DataFrame, part: str, *sums: str) -> DataFrame:
    """Per value of ``part`` (a partition number, so few rows) the sums of all smaller ones.

    ``df`` holds one row per partition; the window therefore reads as many
    rows as there are partitions, never data rows.
    """
    from pyspark.sql import Window

    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return df.select(part, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in sums])


#: Rows of texts that a worker holds as Python objects at a time, and their bytes.
SLICE_ROWS = 500
SLICE_BYTES = 8 << 20


def _cuts(batch: pa.RecordBatch, rows: int, size: int) -> Iterator[tuple[int, int]]:
    """(first, length) of slices of ``batch`` of at most ``rows`` rows and about ``size`` bytes of text; one row at least."""
    heavy = sum((np.diff(_offsets(c)) for c in batch.columns if pa.types.is_string(c.type) or pa.types.is_large_string(c.type)),
                np.zeros(batch.num_rows, np.int64))
    first, held = 0, 0
    for i, own in enumerate(heavy.tolist()):
        if i > first and (i - first >= rows or held + own > size):
            yield first, i - first
            first, held = i, 0
        held += own
    if first < batch.num_rows:
        yield first, batch.num_rows - first


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)


def map_slices(df: DataFrame, function: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str | T.StructType,
               rows: int = SLICE_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """``mapInPandas`` in small frames: a worker holds one Arrow batch (bounded by Spark in bytes) and the objects of
    a slice bounded by ``rows`` and ``SLICE_BYTES``.

    Columns of ``carry`` stay in Arrow: ``function`` does not see them, gives
    one row for each of its own, in order, and they are put before its columns.
    """
    out = to_arrow_schema(T.StructType.fromDDL(schema) if isinstance(schema, str) else schema)
    made = pa.schema([f for f in out if f.name not in carry])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried: list[pa.RecordBatch] = []

        def slices() -> Iterator[pd.DataFrame]:
            for batch in batches:
                for first, length in _cuts(batch, rows, SLICE_BYTES):
                    part = batch.slice(first, length)
                    if carry:
                        carried.append(part.select(list(carry)))
                    yield part.drop_columns(list(carry)).to_pandas(integer_object_nulls=True)

        for frame in function(slices()):
            if len(frame):
                result = pa.RecordBatch.from_pandas(frame, schema=made, preserve_index=False)
                if carry:
                    before = carried.pop(0)
                    result = pa.RecordBatch.from_arrays([*before.columns, *result.columns], schema=pa.schema(
                        [*before.schema, *made]))
                yield result

    return df.mapInArrow(run, schema)
