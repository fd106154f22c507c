"""Row-wise Python stages over Arrow batches.

How many rows the JVM puts in a batch is the session's choice (``maxRecordsPerBatch`` and
``maxBytesPerBatch`` of ``spark.sql.execution.arrow``); nothing here changes a session's settings.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T


#: Rows go to Python in slices of about this many bytes of text, so that a batch of very long
#: texts does not hold many of them at once in several forms.
SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of at most ``limit`` bytes, or one row."""
    if batch.nbytes <= limit or batch.num_rows <= 1:
        yield batch
        return
    half = batch.num_rows // 2
    rows = max(1, min(half, int(batch.num_rows * limit / batch.nbytes)))
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def map_rows(df: DataFrame, make: Callable[[], Callable], schema: T.StructType) -> DataFrame:
    """Apply a function of one row's values; it returns a list of output tuples.

    ``make`` builds the function once per task. ``df`` holds only the columns that it takes.
    """
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        fn = make()
        for whole in batches:
            for batch in slices(whole):
                out: list[tuple] = []
                for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    out.extend(fn(*row))
                columns = list(zip(*out, strict=True)) if out else [()] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
                )

    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    """Apply a function of an Arrow batch; columns that it does not touch are never converted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for whole in batches:
            for batch in slices(whole):
                yield fn(batch)

    return df.mapInArrow(run, schema)


def place_of(df: DataFrame, column: str) -> int:
    """Position of the first column of that name; other columns may share the name in other case."""
    return df.columns.index(column)
