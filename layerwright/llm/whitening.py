"""Embedding whitening with refined principal components.

Vectors become integers. Their sums and the covariance's products are integers too, added up in tasks and then by
Spark; they are exact, whatever the order, while a product sum stays below 2^53. The driver holds one matrix of
dimension x dimension. Its eigenvectors in float32 are a start only: Ogita-Aishima iterations, which are matrix products in
extended precision, correct them, and eigenvalues too near to each other for that are told apart by a solve in their
own small subspace.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwright.session import stage, stage_counted

SCALE = 256
# A task adds up what it reads, so there are as many partial matrices as tasks; no more than this many, whatever the input.
PARTIALS = 2048
ROUNDS = 30
NEAR = 20
_WIDE = np.longdouble


def usable(vector: Column) -> Column:
    """True where a vector is there and all its entries are finite numbers."""

    def bad(entry: Column) -> Column:
        wide = entry.cast("double")
        return entry.isNull() | F.isnan(wide) | (F.abs(wide) == float("inf"))

    return F.coalesce(vector.isNotNull() & ~F.exists(vector, bad), F.lit(False))


def refine_eigenvectors(matrix: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    Starts from float32. A round is one Ogita-Aishima correction; eigenvalues too close for its error bound form a
    cluster, whose invariant subspace is right but whose vectors are not, so the matrix is solved again inside it.
    """
    a = matrix.astype(_WIDE)
    scale = np.abs(a).max() if a.size else _WIDE(0)
    if scale == 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(_WIDE)
    unit = np.eye(len(a), dtype=_WIDE)
    norm = np.linalg.norm(a.astype(float), 2)
    last = np.inf
    for _ in range(rounds):
        r = unit - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        error = float(np.linalg.norm(s - np.diag(values)) + norm * np.linalg.norm(r))
        # Beyond double precision, and no round makes it better any more.
        if error < 1e-17 or (error < 1e-14 and error >= last / 2):
            break
        last = error
        # A correction is error / gap and leaves its square behind, which has to be small beside the gap itself.
        reach = (NEAR * error) ** (2 / 3)
        gap = values[None, :] - values[:, None]
        near = np.abs(gap) <= reach
        step = np.where(near, r / 2, (s + values[None, :] * r) / np.where(near, 1, gap))
        x = x + x @ step
        order = np.argsort(-values, kind="stable")
        x, values = x[:, order], values[order]
        ends = np.flatnonzero(np.append(-np.diff(values) > reach, True)) + 1
        for start, end in zip(np.append(0, ends[:-1]), ends):
            if end - start > 1:
                x[:, start:end] = _sub_solve(a, x[:, start:end])
    x = x / np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return (values[order] * scale).astype(float), x[:, order].astype(float)


def _sub_solve(a: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``basis`` turned to the eigenvectors of ``a`` within its span. What is left after the mean is taken off is small, so its own digits count."""
    inner = basis.T @ (a @ basis)
    inner = (inner + inner.T) / 2 - np.eye(len(inner), dtype=_WIDE) * np.trace(inner) / len(inner)
    size = np.abs(inner).max()
    if size == 0:
        return basis
    turn = np.linalg.eigh((inner / size).astype(float))[1][:, ::-1].astype(_WIDE)
    return basis @ turn


@dataclass
class Whitening:
    """What ``fit`` found: ``n`` distinct vectors, their sums, and the leading components."""

    n: int
    sums: list[int]
    components: np.ndarray  # a column each
    variances: np.ndarray
    explained: list[float | None]
    identity_error: float | None


def _matrix(batch: pa.RecordBatch, name: str, width: int) -> np.ndarray:
    column = batch.column(name)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _summed(df: DataFrame, shape: tuple[int, int], part: Callable[[pa.RecordBatch], np.ndarray]) -> np.ndarray:
    """The sum of ``part`` over all batches: a matrix a task, then summed entry by entry."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total = total + part(batch)
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(shape[0]), pa.int32()), "v": pa.array(total.tolist(), pa.list_(pa.float64()))})

    entries = df.coalesce(PARTIALS).mapInArrow(add, "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    out = np.zeros(shape)
    for row in entries.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[row.i, row.j] = row.v
    return out


def _sums(fit: DataFrame, width: int) -> list[int]:
    """Per dimension the sum over the fit list, exact beyond 64 bits."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            x = _matrix(batch, "x", width)
            if len(x) and max(abs(int(x.min())), abs(int(x.max()))) * len(x) >= 1 << 62:
                x = x.astype(object)
            total = [a + int(b) for a, b in zip(total, x.sum(axis=0))]
        yield pa.RecordBatch.from_pydict({"j": pa.array(range(width), pa.int32()), "s": pa.array([str(s) for s in total])})

    rows = fit.coalesce(PARTIALS).mapInArrow(add, "j int, s string")
    found = {r.j: int(r.s) for r in rows.groupBy("j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    return [found[j] for j in range(width)]


def _spread(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: in 64 bits if they suffice, else as Python's integers."""
    largest = max((abs(s) for s in sums), default=0)
    if len(x) and n * max(abs(int(x.min())), abs(int(x.max()))) + largest >= 1 << 62:
        return x.astype(object) * n - np.array(sums, dtype=object)
    return x * n - np.array(sums, dtype=np.int64)


def fit(x: DataFrame, n: int, width: int, components: int = 4) -> Whitening:
    """``x``: the fit list, one column ``x`` of ``n`` distinct long arrays of ``width`` entries."""
    sums = _sums(x, width)
    centre = [round(s / n) for s in sums]
    away = np.array([(s - n * c) / n for s, c in zip(sums, centre)], dtype=_WIDE)

    def products(batch: pa.RecordBatch) -> np.ndarray:
        y = _matrix(batch, "x", width).astype(float) - np.array(centre, dtype=float)
        return y.T @ y

    covariance = _summed(x, (width, width), products).astype(_WIDE) / n - np.outer(away, away)
    values, vectors = refine_eigenvectors(covariance)
    trace = float(np.trace(covariance))
    kept = min(components, width)
    # Below this a variance is what rounding left of zero: there is nothing to whiten along such a component.
    floor = width * np.finfo(float).eps * max(values[0], 0.0)
    variances = np.where(values[:kept] > floor, values[:kept], 0.0)
    found = Whitening(
        n, sums, vectors[:, :kept], variances, [float(v) / trace if trace > 0 else None for v in variances], None
    )
    alive = np.flatnonzero(variances > 0)
    if len(alive):

        def squares(batch: pa.RecordBatch) -> np.ndarray:
            w = _project(_matrix(batch, "x", width), found)[:, alive]
            return w.T @ w

        found.identity_error = float(np.abs(_summed(x, (len(alive), len(alive)), squares) / n - np.eye(len(alive))).max())
    return found


def _project(x: np.ndarray, found: Whitening) -> np.ndarray:
    """Whitened rows: what is centred exactly, divided once, and projected. NaN along components without variance."""
    centred = (_spread(x, found.n, found.sums) / found.n).astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(found.variances > 0, (centred @ found.components) / np.sqrt(found.variances), np.nan)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    spread = _spread(x, n, sums)
    if spread.size and spread.dtype != object and max(abs(int(spread.min())), abs(int(spread.max()))) >= 1 << 28:
        spread = spread.astype(object)
    total = (spread * spread).sum(axis=1)
    return [int(t) if t < 1 << 63 else None for t in total]


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4) -> DataFrame:
    """Every usable row along the leading components of the distinct vectors.

    Returns the id, component (from 1), n, deviation, whitened, explained, identity_error, one row for each usable row
    and component. An entry c becomes floor(256 c). Vectors that are null or hold a null or non-finite entry are
    dropped, and so are those whose length is not the commonest one (of equally common ones the largest); empty vectors have
    no component and so no row. Null and repeated ids and repeated rows are kept as they are, and repeated vectors
    count once for the fit. Along a component without variance ``whitened`` is null and ``explained`` 0, or null if no component has any;
    ``identity_error`` covers the other components. A ``deviation`` beyond 64 bits is null. Further columns are not read.
    """
    vector = F.col(f"`{vector_col}`")
    given = df.select(F.col(f"`{id_col}`").alias(id_col), vector.alias("vector")).filter(usable(F.col("vector")))
    rows = stage(
        given.select(id_col, F.transform("vector", lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("x")), "whiten-rows"
    )
    schema = f"`{id_col}` {rows.schema[id_col].dataType.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    sizes = rows.groupBy(F.size("x").alias("width")).count()
    commonest = sizes.orderBy(F.desc("count"), F.desc("width")).first()
    if commonest is None or commonest.width == 0:
        return df.sparkSession.createDataFrame([], schema)
    width = commonest.width
    rows = rows.filter(F.size("x") == width)
    distinct, n = stage_counted(rows.select("x").distinct(), "whiten-fit")
    found = fit(distinct, n, width, components)
    kept = min(components, width)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch, "x", width)
            size = len(x) * kept
            repeat = np.repeat(np.arange(len(x)), kept)
            deviation = pa.array(_deviation(x, found.n, found.sums), pa.int64()).take(pa.array(repeat))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(id_col).take(pa.array(repeat)),
                    pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(size, found.n, dtype=np.int64)),
                    deviation,
                    pa.array(_project(x, found).ravel(), pa.float64(), from_pandas=True),
                    pa.array(found.explained * len(x), pa.float64()),
                    pa.array([found.identity_error] * size, pa.float64()),
                ],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(project, schema)
