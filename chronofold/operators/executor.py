"""Whole islands in Arrow batches.

Rows are dealt by island, sorted, and handed to a kernel in batches that hold whole islands only: thousands of small ones at a
time, as columns, so no island costs a call, a frame or a task of its own. A batch is cut at the first island's end beyond
``rows``; an island that is longer is held alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from chronofold.operators.intervals import RUN

#: A kernel gets the rows of whole islands and where each island begins, and returns rows of the output.
Kernel = Callable[[pa.RecordBatch, np.ndarray], pa.RecordBatch]


def _changes(batch: pa.RecordBatch, keys: Sequence[str]) -> np.ndarray:
    """Places at which a row's keys differ from those of the row before it; nulls are equal."""
    differs = np.zeros(max(batch.num_rows - 1, 0), dtype=bool)
    for k in keys:
        c = batch.column(k)
        same = pc.fill_null(pc.equal(c[1:], c[:-1]), False).to_numpy(zero_copy_only=False)
        both = pc.and_(pc.is_null(c[1:]), pc.is_null(c[:-1])).to_numpy(zero_copy_only=False)
        differs |= ~(same | both)
    return np.flatnonzero(differs) + 1


def map_islands(df: DataFrame, kernel: Kernel, out: StructType | str, order: Sequence[str], by: Sequence[str] = RUN, island: str = "island", rows: int = 10_000) -> DataFrame:
    """kernel over df's islands, of one run each, with the rows of an island in order."""
    keys = [*by, island]

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            starts = np.concatenate([[0], _changes(batch, keys)])
            yield kernel(batch, starts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size, enough = 0, rows
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < enough:
                continue
            table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            cuts = _changes(table, keys)
            if not len(cuts):
                held, enough = [table], 2 * size  # one island so far: look again when as many rows have come on top
                continue
            yield from whole([table.slice(0, int(cuts[-1]))])
            held = [table.slice(int(cuts[-1]))]
            size, enough = held[0].num_rows, max(rows, 2 * held[0].num_rows)
        if held:
            yield from whole([pa.Table.from_batches(held).combine_chunks().to_batches()[0]])

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, out)


def floats(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """A column as floats, NaN for null."""
    return batch.column(column).cast(pa.float64()).to_numpy(zero_copy_only=False)


def lists(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """(values, offsets) of a list column without Python objects: row i has values[offsets[i]:offsets[i + 1]]; null lists are empty."""
    c = batch.column(column)
    sizes = pc.fill_null(pc.list_value_length(c), 0).to_numpy(zero_copy_only=False)
    values = c.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return values, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
