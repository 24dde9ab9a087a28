"""Whitening of vectors by shifted CholeskyQR.

Vectors are scaled to whole numbers; the fit list is each distinct one once.
With its sums every row is centred before anything is multiplied. A pass over
the list gives the Gram matrix of the rows, its Cholesky factor R turns the
rows, by a triangular solve, into better conditioned ones, and so on until
their Gram matrix is the identity. The first factor is shifted, so that it
exists whatever the condition. The factors composed are R of a QR of all rows;
its singular vectors are the components, its singular values their spread.

A pass moves one matrix of the width of a vector per task. No row goes to the
driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import ref
from tidelog.llm.vectors import scaled_rows
from tidelog.session import stored

COMPONENTS = 4
SCALE = 256
#: Passes at most; three are enough for rows of full rank.
PASSES = 6
_EPS = float(np.finfo(np.float64).eps)


@dataclass(frozen=True)
class Whitening:
    """What the fit list says. ``vectors`` has a column per component."""

    n: int
    sums: list[int]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float

    @property
    def dim(self) -> int:
        return len(self.sums)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - sums / n`` of whole numbers: the whole part of a mean is taken
    off exactly, the rest in double precision."""
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def solved(rows: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """``rows`` times the inverse of an upper triangular matrix."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ upper[:j, j]) / upper[j, j]
    return out


def _matrix(raws: pd.Series, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raws), "<i8").reshape(-1, dim)


def summed(fit: DataFrame, dim: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all rows of the fit list of ``of(rows)``, a matrix."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            if len(batch):
                one = of(_matrix(batch["x"], dim))
                total = one if total is None else total + one
        if total is not None:
            yield pd.DataFrame({"i": range(len(total)), "v": [row.tobytes() for row in total]})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(raw, np.float64) for raw in group["v"]], axis=0)
        return pd.DataFrame({"i": group["i"].iloc[:1], "v": [total.tobytes()]})

    parts = fit.mapInPandas(partial, "i int, v binary")
    rows = parts.groupBy("i").applyInPandas(add, "i int, v binary").collect()
    return np.array([np.frombuffer(r["v"], np.float64) for r in sorted(rows, key=lambda r: r["i"])])


def exact_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Rows of the fit list and the sum of each dimension, without rounding."""

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, total = 0, [0] * dim
        for batch in batches:
            x = _matrix(batch["x"], dim)
            n += len(x)
            # halves, so that no column of a batch leaves 64 bits
            high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
            total = [t + (int(h) << 32) + int(w) for t, h, w in zip(total, high, low, strict=True)]
        yield pd.DataFrame({"i": range(-1, dim), "s": [str(n), *map(str, total)]})

    parts = fit.mapInPandas(partial, "i int, s string")
    rows = parts.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    found = {r["i"]: int(r["s"]) for r in rows}
    return found.get(-1, 0), [found.get(i, 0) for i in range(dim)]


def _factor(gram: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper Cholesky factor, shifted first if asked or if there is none."""
    d = len(gram)
    shift = 11.0 * (n * d + d * (d + 1)) * _EPS / 2 * float(np.trace(gram))
    for k in range(60):
        more = 0.0 if not shifted and k == 0 else shift * 4.0 ** max(k - 1, 0)
        try:
            return np.linalg.cholesky(gram + more * np.eye(d)).T
        except np.linalg.LinAlgError:
            continue
    raise np.linalg.LinAlgError("the Gram matrix has no factor")


def fit_whitening(fit: DataFrame, dim: int, components: int) -> Whitening | None:
    """Fit on ``x``, a binary of ``dim`` longs per row; None if there are no
    rows or they are all equal."""
    n, sums = exact_sums(fit, dim)
    if n == 0:
        return None
    chain: list[np.ndarray] = []
    product = np.eye(dim)
    trace = 0.0

    def gram() -> np.ndarray:
        factors = list(chain)

        def of(x: np.ndarray) -> np.ndarray:
            rows = centred(x, n, sums)
            for upper in factors:
                rows = solved(rows, upper)
            return rows.T @ rows

        return summed(fit, dim, of)

    while True:
        now = gram()
        if not chain:
            trace = float(np.trace(now)) / n
            if trace == 0.0:
                return None
        elif np.abs(now - np.eye(dim)).max() <= 50 * dim * _EPS or len(chain) == PASSES:
            break
        chain.append(_factor(now, n, shifted=not chain))
        product = chain[-1] @ product
    # what is left to the identity (all of it for dimensions without spread) goes into R
    level, turn = np.linalg.eigh(now)
    _, spread, right = np.linalg.svd((turn * np.sqrt(np.maximum(level, 0.0))) @ turn.T @ product)
    values = spread**2 / n
    count = min(components, int((values > dim * 16 * _EPS * values[0]).sum()))
    vectors = right[:count].T

    def moments(x: np.ndarray) -> np.ndarray:
        rows = centred(x, n, sums) @ vectors / np.sqrt(values[:count])
        return np.vstack((rows.T @ rows, rows.sum(axis=0)))

    found = summed(fit, dim, moments)
    mean = found[-1] / n
    error = np.abs(found[:-1] / n - np.outer(mean, mean) - np.eye(count)).max()
    return Whitening(n, sums, trace, values[:count], vectors, float(error))


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """``sum((n * x - sums) ** 2)`` of each row, exact; None beyond a long."""
    rough = (centred(x, n, sums) ** 2).sum(axis=1) * float(n) ** 2
    fits = rough < 9.0e18  # then no term and no partial sum leaves 64 bits
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    t = n * (x[fits] - whole) - rest
    out: list[int | None] = [None] * len(x)
    for at, value in zip(np.flatnonzero(fits), (t * t).sum(axis=1), strict=True):
        out[at] = int(value)
    for at in np.flatnonzero(~fits):
        value = sum((n * int(v) - s) ** 2 for v, s in zip(x[at], sums, strict=True))
        out[at] = value if value < 1 << 63 else None
    return out


RESULT = (
    "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def whiten(
    df: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
) -> DataFrame:
    """A row per vector and component, columns as in ``RESULT``.

    Null vectors, vectors with a null or non-finite entry (or one of 2^53 or
    more after scaling) and vectors of another length than most rows have (of
    equally many the longest) take no part. Null ids do, and repeated rows are
    rows of the result but one of the fit list. Components without spread are
    left out: of equal rows, a single row and an empty table there are none,
    and so no rows. Equal spreads come in any order. A ``deviation`` beyond a
    long is null. Other columns are not read.
    """
    spark = df.sparkSession
    rows = stored(scaled_rows(df.select(ref(id_col).cast("long").alias("id"), ref(vec_col).alias("v")), scale), "vectors")
    dims = rows.groupBy("dim").count().orderBy(F.desc("count"), F.desc("dim")).first()
    model = None
    if dims is not None and dims["dim"] > 0:
        dim = dims["dim"]
        rows = rows.where(F.col("dim") == dim)
        fit = stored(rows.select("x").distinct(), "fit")
        model = fit_whitening(fit, dim, components)
    if model is None:
        return spark.createDataFrame([], RESULT)

    def turned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = len(model.values)
        for batch in batches:
            x = _matrix(batch["x"], model.dim)
            white = centred(x, model.n, model.sums) @ model.vectors / np.sqrt(model.values)
            yield pd.DataFrame(
                {
                    "id": batch["id"].astype("Int64").repeat(count),
                    "component": np.tile(np.arange(1, count + 1), len(x)),
                    "n": model.n,
                    "deviation": pd.array(deviations(x, model.n, model.sums), "Int64").repeat(count),
                    "whitened": white.reshape(-1),
                    "explained": np.tile(model.values / model.trace, len(x)),
                    "identity_error": model.identity_error,
                }
            )

    return rows.select("id", "x").mapInPandas(turned, RESULT)
