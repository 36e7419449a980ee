"""Helpers for Arrow-batched operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


#: Rows that are Python objects at a time; Arrow's own batches are larger.
SLICE = 512


def map_batches(df: DataFrame, f: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema, rows: int = SLICE) -> DataFrame:
    """Apply ``f`` to slices of the Arrow batches of at most ``rows`` rows; slices without rows make no output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                if (out := f(batch.slice(at, rows))) is not None:
                    yield out

    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> list[str]:
    """The column's values, null as the empty text."""
    return [x or "" for x in column.to_pylist()]
