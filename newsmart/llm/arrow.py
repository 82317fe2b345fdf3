"""Columns computed from a text column, batch by batch, in Arrow; and tables staged between jobs."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from newsmart.session import shared_dir


#: Bytes of text that a task works on at once; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch's rows in order, in parts of about SLICE_BYTES of the column."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        done = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + SLICE_BYTES, side="right")))
        yield batch.slice(at, stop - at)
        at = stop
    if not batch.num_rows:
        yield batch


def add_columns(
    df: DataFrame, text: str, fields: list[T.StructField], compute: Callable[[pa.RecordBatch], list[pa.Array]]
) -> DataFrame:
    """df with the fields appended; compute gets a batch and returns one array for each field.

    A column of df that has the name of a field is replaced. Spark's batches are taken in slices of about
    SLICE_BYTES of `text`, so that what a task makes of them stays small.
    """
    df[text]
    names = {f.name.lower() for f in fields}
    kept = [c for c in df.columns if c.lower() not in names]
    schema = T.StructType([df.schema[c] for c in kept] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            at = [whole.schema.get_field_index(c) for c in kept]
            for batch in slices(whole, text):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in at] + list(compute(batch)), names=kept + [f.name for f in fields]
                )
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of df has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


class Stage:
    """Tables of one call of an operator, in a folder of their own below spark.checkpoint.dir."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark = spark
        self.folder = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def save(self, df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
        """df written as Parquet and read back, so that what follows doesn't depend on its lineage.

        The shuffle files of the job are given up once the table is there.
        """
        schema, setting = df.schema, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(setting, "false")
        self.spark.conf.set(setting, "true")
        try:
            df.write.option("compression", codec).parquet(self.path(name))
        finally:
            self.spark.conf.set(setting, before)
        return self.spark.read.schema(schema).parquet(self.path(name))
