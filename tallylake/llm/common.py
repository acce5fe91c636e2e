"""Helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from tallylake.session import scratch_dir
from tallylake.sources.paths import delete_at_exit


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Pages and row groups that a reader and a writer hold little of, and the reader's buffers.
_SMALL_WRITES = {"parquet.block.size": str(4 << 20), "parquet.page.size": str(128 << 10)}
_SMALL_READS = {"parquet.read.allocation.size": str(256 << 10)}


def staged(
    df: DataFrame, label: str, codec: str | None = None, small_pages: bool = False
) -> DataFrame:
    """``df`` written to the shared scratch folder and read again.

    This cuts the lineage: a lost executor, or a second reader, reads the files.  They stay as
    long as a plan may read them, which is to the end of the application.  ``codec``
    compresses them, by default the session's.  ``small_pages`` is for tables of whole texts, whose
    usual pages and buffers are objects so large that the heap grows with them.
    """
    path = scratch_dir(df.sparkSession, label)
    writer = df.write if codec is None else df.write.option("compression", codec)
    reader = df.sparkSession.read.schema(df.schema)
    if small_pages:
        writer, reader = writer.options(**_SMALL_WRITES), reader.options(**_SMALL_READS)
    writer.parquet(path)
    delete_at_exit(df.sparkSession, path)
    return reader.parquet(path)


def row_numbers() -> Iterator[int]:
    """Numbers that no other task of the stage gives out; fixed once they are written."""
    context = TaskContext.get()
    number = (context.partitionId() if context else 0) << 40
    while True:
        yield number
        number += 1


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int
) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of at most ``limit`` text bytes, or of one long row."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = size = 0
        for row, length in enumerate(lengths):
            if row > start and size + length > limit:
                yield batch.slice(start, row - start)
                start, size = row, 0
            size += length
        if start < batch.num_rows:
            yield batch.slice(start)
