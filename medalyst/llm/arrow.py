"""Arrow batches into and out of numpy code, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SLICE_BYTES = 4 << 20
BATCH_BYTES = 8 << 20         # of one batch between the JVM and Python; texts and sets vary too much in size to count rows


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` with batches of bounded size; the session keeps that bound."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of ``batch`` in which ``column`` holds about ``size`` bytes, or one row."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for start, end in zip(edges, edges[1:], strict=False):
        if end > start:
            yield batch.slice(start, end - start)


def with_outputs(df: DataFrame, column: str, outputs: str, compute: Callable[[list], Sequence[Sequence]],
                 drop: Sequence[str] = (), size: int = SLICE_BYTES, done: Callable[[], None] | None = None) -> DataFrame:
    """``df`` with the columns of the schema text ``outputs``, which ``compute`` makes from a list of ``column``'s values.

    ``done`` runs when a task ends, to let go of what ``compute`` has kept: Python workers serve many tasks.
    """
    added = StructType.fromDDL(outputs)
    kept = [name for name in df.columns if name not in drop]
    types = [field.type for field in to_arrow_schema(added)]
    names = [*kept, *added.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in slices(batch, column, size):
                    made = compute(part.column(column).to_pylist())
                    arrays = [pa.array(values, kind) for values, kind in zip(made, types, strict=True)]
                    yield pa.RecordBatch.from_arrays([*[part.column(name) for name in kept], *arrays], names=names)
        finally:
            if done:
                done()

    return map_batches(df, run, StructType([*[df.schema[name] for name in kept], *added.fields]))
