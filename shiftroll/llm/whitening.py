"""Embedding whitening by Chebyshev-filtered subspace iteration.

Every entry c of a vector becomes the integer x = floor(1024 c) + 100000.  The
covariance V of these is never formed.  A block Q of a few vectors more than
the components wanted goes through distributed passes that return V Q: every
task centres its rows and adds up its part of the product, Spark adds up the
parts by cell.  A polynomial in V, built by the Chebyshev recurrence out of such
passes, damps the part of the spectrum below the block's last Ritz value; QR
and Rayleigh-Ritz then give the next block.  The iteration ends when the
residuals ``|V u - e u|`` of the wanted pairs are down to rounding.  A block that
cannot be told from the rest of the spectrum (a cluster of equal eigenvalues
wider than the block) is widened; one as wide as the vectors is exact.

The driver holds the block, the column sums and one product: dimensions x block
numbers, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftroll.session import materialise

SCALE, SHIFT = 1024, 100_000  # fixed values
COMPONENTS = 8
GUARD = 24  # vectors of the block beyond the components
DEGREE = 10  # of the filter
SLOW = 4  # rounds without a tenth of the residual before the block is widened
MOST_ROUNDS = 200
SEED = 20241105
BATCH_ROWS = 4096
LONG_MAX = float(2**63) * (1 - 1e-9)

OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


@dataclass(frozen=True)
class Fit:
    """Rows, column sums, the components (as columns), their eigenvalues, the trace, and how they were certified."""

    n: int
    sums: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    passes: int

    @property
    def dimension(self) -> int:
        return len(self.sums)


def _matrix(column: pa.ListArray) -> np.ndarray:
    """The lists of an Arrow column, all equally long, as rows."""
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x less the mean; the whole part of the mean is taken off exactly."""
    whole = sums // n
    return (x - whole) - (sums - n * whole) / n


def integer_rows(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x of the rows whose vector is whole: not NULL, not empty, every entry finite."""
    entry = F.col(vector_col)
    whole = F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    x = F.transform(entry, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    kept = embeddings.filter(entry.isNotNull() & (F.size(entry) > 0)).filter(whole)
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x"))


def _sum_by_cell(rows: DataFrame, columns: list[str], work: Callable[[np.ndarray], np.ndarray], cells: int) -> np.ndarray:
    """Add up over all rows the array that ``work`` makes of a block of them; ``cells`` numbers reach the driver."""

    def partial(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                total += work(_matrix(batch.slice(start, BATCH_ROWS).column(0))).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(total)], ["cell", "value"])

    parts = rows.select(*columns).mapInArrow(partial, "cell int, value double")
    found = parts.groupBy("cell").agg(F.sum("value").alias("value")).toArrow()
    out = np.zeros(cells)
    out[np.asarray(found.column("cell"))] = np.asarray(found.column("value"))
    return out


class _Passes:
    """The product with the covariance, one distributed pass a call."""

    def __init__(self, rows: DataFrame, n: int, sums: np.ndarray):
        self.rows, self.n, self.sums, self.count = rows, n, sums, 0
        self.trace = 0.0

    def __call__(self, q: np.ndarray) -> np.ndarray:
        n, sums = self.n, self.sums

        def product(x: np.ndarray) -> np.ndarray:
            c = _centred(x, n, sums)
            return np.append((c.T @ (c @ q)).ravel(), np.einsum("ij,ij->", c, c))

        found = _sum_by_cell(self.rows, ["x"], product, q.size + 1) / n
        self.count += 1
        self.trace = float(found[-1])
        return found[:-1].reshape(q.shape)


def _filtered(times_v: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, low: float, high: float, degree: int) -> np.ndarray:
    """A Chebyshev polynomial of V times q: at most 1 on [0, low], 1 in size at ``high`` after scaling."""
    half = low / 2
    sigma = half / (high - half)
    twice = 2 / sigma
    before, now = q, (vq - half * q) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (twice - sigma)
        before, now = now, (times_v(now) - half * now) * (2 * following / half) - before * (sigma * following)
        sigma = following
    return now


def _wider(q: np.ndarray, width: int, rng: np.random.Generator) -> np.ndarray:
    more = rng.standard_normal((len(q), width - q.shape[1]))
    return np.linalg.qr(np.hstack([q, more]))[0]


def fit(rows: DataFrame, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE) -> Fit | None:
    """The leading components of ``rows`` (x arrays of one length); None without rows."""
    sums = {r["pos"]: (r["s"], r["n"]) for r in rows.select(F.posexplode("x")).groupBy("pos").agg(F.sum("col").alias("s"), F.count(F.lit(1)).alias("n")).collect()}
    if not sums:
        return None
    d, n = len(sums), sums[0][1]
    total = np.array([sums[i][0] for i in range(d)], dtype=np.int64)
    times_v, rng = _Passes(rows, n, total), np.random.default_rng(SEED)
    wanted, width = min(components, d), min(d, components + guard)
    q = _wider(np.zeros((d, 0)), width, rng)
    best, slow = np.inf, 0
    for _ in range(MOST_ROUNDS):
        vq = times_v(q)
        values, turn = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(float(values[0]), 0.0)
        residual = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max())
        limit = 32 * np.finfo(float).eps * np.sqrt(d) * top
        if residual <= limit or width == d:
            break
        slow = 0 if residual < best / 10 else slow + 1
        best = min(best, residual)
        if slow == SLOW:
            if residual <= 64 * limit:  # rounding of very many rows
                break
            width, slow, best = min(d, 2 * width), 0, np.inf
            q = _wider(q, width, rng)
            continue
        low = max(float(values[-1]), 1e-8 * top)
        q = np.linalg.qr(_filtered(times_v, q, vq, low, top, degree))[0]
    else:
        raise RuntimeError(f"components not certified: residual {residual:.3g} of {top:.3g}")
    vectors, values = q[:, :wanted], values[:wanted]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)])
    return Fit(n, total, vectors * signs, np.maximum(values, 0.0), times_v.trace, residual, times_v.count)


def _projection(f: Fit) -> tuple[np.ndarray, np.ndarray]:
    """Components over the root of their eigenvalue, and which of them have any variance."""
    alive = f.values > 64 * np.finfo(float).eps * f.dimension * max(f.trace, 1e-300)
    return f.vectors / np.sqrt(np.where(alive, f.values, 1.0)), alive


def identity_error(rows: DataFrame, f: Fit) -> float | None:
    """Largest entry of the whitened covariance less the identity, measured over all rows."""
    project, alive = _projection(f)
    project, k, n, sums = project[:, alive], int(alive.sum()), f.n, f.sums
    if not k:
        return None

    def moments(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, sums) @ project
        return np.append((w.T @ w).ravel(), w.sum(axis=0))

    found = _sum_by_cell(rows, ["x"], moments, k * k + k) / n
    mean = found[k * k :]
    return float(np.abs(found[: k * k].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whitened(embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row for each whole vector and component; other columns are left out.

    Vectors that are NULL, empty, or hold a NULL or non-finite entry take no
    part.  Nor do those of another length than the most frequent one (of equally
    frequent lengths the larger).  Repeated rows are rows of their own, a NULL
    id stays NULL.  An empty table gives no rows.  A component without variance
    (one row, equal vectors, more components than dimensions have variance) has
    a NULL whitened value, and identity_error is that of the others.  A
    deviation beyond the range of a long is NULL.
    """
    rows = materialise(integer_rows(embeddings, id_col, vector_col))
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if lengths is None:
        return rows.sparkSession.createDataFrame([], OUT)
    rows = rows.filter(F.size("x") == lengths["d"])
    f = fit(rows, components)
    error = identity_error(rows, f)
    project, alive = _projection(f)
    share = f.values / f.trace if f.trace > 0 else np.zeros(len(f.values))
    n, sums, k = f.n, f.sums, len(f.values)

    def score(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(start, BATCH_ROWS)
                x = _matrix(batch.column(1))
                away = n * x - sums
                large = np.square(away.astype(float)).sum(axis=1) >= LONG_MAX
                deviation = pa.array((away * away).sum(axis=1), mask=large)
                w = _centred(x, n, sums) @ project
                m = len(x)
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(each)),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n, dtype=np.int64)),
                        deviation.take(pa.array(each)),
                        pa.array(w.ravel(), mask=np.tile(~alive, m)),
                        pa.array(np.tile(share, m)),
                        pa.array([error] * (m * k), type=pa.float64()),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(score, OUT)
