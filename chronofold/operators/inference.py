"""Model inference per row, with the model as a plain function over numpy arrays."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, StructType

Predict = Callable[[np.ndarray], np.ndarray]


def _padded(predict: Predict, x: np.ndarray, batch: int) -> np.ndarray:
    """predict on blocks of exactly ``batch`` rows, the last one padded (compiled models want one shape)."""
    parts = []
    for at in range(0, len(x), batch):
        block = x[at : at + batch]
        full = np.vstack([block, np.zeros((batch - len(block), x.shape[1]))]) if len(block) < batch else block
        parts.append(np.asarray(predict(full))[: len(block)])
    return np.concatenate(parts) if parts else np.empty((0, 2))


def positions(df: DataFrame, predict: Predict | None, pattern: str = "area_per_channel", area: str = "area", min_area: float = 10.0, names: tuple[str, ...] = ("x", "y"),
              add_log_area: bool = False, batch: int = 1024) -> DataFrame:
    """df with predicted columns: patterns are scaled by their maximum (or by their sum, with the log of the area appended). Rows at or below
    min_area, empty patterns and a missing model give NaN and never reach the model."""
    schema = StructType(list(df.schema.fields))
    for n in names:
        schema = schema.add(n, DoubleType())

    def run(batches):
        for b in batches:
            out = np.full((b.num_rows, len(names)), np.nan)
            areas = b.column(area).cast(pa.float64()).to_numpy(zero_copy_only=False)
            rows = [np.asarray(p or [], float) for p in b.column(pattern).to_pylist()]
            ok = np.array([i for i, (p, a) in enumerate(zip(rows, areas)) if a > min_area and p.size and p.max() > 0], dtype=int)
            if predict is not None and len(ok):
                x = np.stack([rows[i] for i in ok])
                if add_log_area:
                    x = np.hstack([x / x.sum(1, keepdims=True), np.log(areas[ok])[:, None]])
                else:
                    x = x / x.max(1, keepdims=True)
                out[ok] = _padded(predict, x, batch).reshape(len(ok), len(names))
            yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(out[:, i]) for i in range(len(names))]], names=[*b.schema.names, *names])

    return df.mapInArrow(run, schema)
