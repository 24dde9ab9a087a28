"""Vectors as whole numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_MOST = float(1 << 53)


def scaled(vector, scale: int) -> np.ndarray | None:
    """``floor(scale * x)`` of each entry as a long; None for null, for a null
    or non-finite entry, and for one of 2^53 or more after scaling."""
    if vector is None:
        return None
    x = np.floor(scale * np.asarray(vector, np.float64))
    return x.astype(np.int64) if (np.abs(x) < _MOST).all() else None


def scaled_rows(df: DataFrame, scale: int) -> DataFrame:
    """``df`` with its vector ``v`` as ``dim`` and ``x``, a binary of longs; rows
    whose vector cannot be scaled are left out. The other columns are longs."""
    kept = [c for c in df.columns if c != "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [scaled(v, scale) for v in batch.column("v").to_pandas()]
            good = pa.array([x is not None for x in rows], pa.bool_())
            rows = [x for x in rows if x is not None]
            columns = {c: batch.column(c).filter(good) for c in kept}
            columns["dim"] = pa.array([len(x) for x in rows], pa.int32())
            columns["x"] = pa.array([x.astype("<i8").tobytes() for x in rows], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    fields = [f"{c} long" for c in kept]
    return df.mapInArrow(run, ", ".join([*fields, "dim int", "x binary"]))
