"""Whitening of embeddings: leading covariance eigenvectors by Jacobi-Davidson, matrix-free on Spark."""

from __future__ import annotations

from collections.abc import Callable, Generator, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bugsieve.llm.common import saved

#: Components returned, and eigenpairs found beyond them so that none of the leading ones is missed.
COMPONENTS, GUARDS = 4, 2
#: An entry is scaled by so much before its floor is taken.
SCALE = 256
#: Steps of one inner MINRES solve, the residual ratio that ends it, and vectors of the search
#: space before it is cut back to the best ones.
INNER_STEPS, INNER_TOLERANCE, BASIS = 6, 0.2, 64
#: Rounds of the outer iteration at most; a start uses some ten.
ROUNDS = 200
#: Vectors of one block of the fit list.
BLOCK_ROWS = 8_192

_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


@dataclass
class Fit:
    """What whitening needs of the fit list."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a column each
    trace: float
    identity_error: float
    residuals: np.ndarray
    products: int  # passes over the fit list

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def _parts(total: DataFrame) -> dict[int, float]:
    """Sums by cell of the numbers that tasks have added up: as many rows as a result has cells."""
    return {r.cell: r.value for r in total.groupBy("cell").agg(F.sum("value").alias("value")).collect()}


def _over_blocks(
    blocks: DataFrame, work: Callable[[np.ndarray], np.ndarray], size: int, dtype: str, whole: bool = False
) -> list:
    """The sum of ``work`` over all blocks of vectors, added up in tasks and then by cell."""
    kind = "long" if whole else "double"
    number = np.int64 if whole else np.float64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=number)
        for batch in batches:
            for data, dim in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                total += work(np.frombuffer(data.as_buffer(), dtype=dtype).reshape(-1, dim)).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], ["cell", "value"])

    found = _parts(blocks.select("data", "dim").mapInArrow(run, f"cell int, value {kind}"))
    return [found.get(i, 0) for i in range(size)]


def _minres(b: np.ndarray, steps: int, tolerance: float) -> Generator[np.ndarray, np.ndarray, np.ndarray]:
    """Solve B x = b for a symmetric B. Yields the vectors that B is to be applied to."""
    beta = norm = float(np.linalg.norm(b))
    x, v, v_before = np.zeros_like(b), b / norm, np.zeros_like(b)
    w, w_before = np.zeros_like(b), np.zeros_like(b)
    c, s, c_before, s_before, eta = 1.0, 0.0, 1.0, 0.0, norm
    beta = 0.0
    for _ in range(steps):
        p = yield v
        alpha = float(v @ p)
        p = p - alpha * v - beta * v_before
        after = float(np.linalg.norm(p))
        delta = c * alpha - c_before * s * beta
        r1 = float(np.hypot(delta, after))
        r2, r3 = s * alpha + c_before * c * beta, s_before * beta
        if r1 <= 1e-300:
            break
        c_before, s_before, c, s = c, s, delta / r1, after / r1
        w_before, w = w, (v - r3 * w_before - r2 * w) / r1
        x = x + c * eta * w
        eta = -s * eta
        if abs(eta) <= tolerance * norm or after <= 1e-14 * max(1.0, abs(alpha)):
            break
        v_before, v, beta = v, p / after, after
    return x


def _orthonormal(t: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """The columns of t made orthogonal to the given columns and to each other, less what vanishes."""
    out = np.zeros((len(t), 0))
    for j in range(t.shape[1]):
        v = t[:, j]
        length = np.linalg.norm(v)
        if not np.isfinite(length) or length == 0:
            continue
        v = v / length
        for _ in range(3):
            for a in (*against, out):
                v = v - a @ (a.T @ v)
            left = np.linalg.norm(v)
            if left < 1e-10:
                break
            v = v / left
        else:
            out = np.c_[out, v]
    return out


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, guards: int = GUARDS, seed: int = 11
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric positive semidefinite operator, their
    vectors and residual norms; ``product`` applies the operator to some columns at once.

    Each round takes the Ritz pairs of the search space (Rayleigh-Ritz), locks those whose residual
    is down to rounding (4 * dim * machine epsilon * the largest value), and solves for each of the
    others the correction equation (I - XX')(A - theta)(I - XX') t = -r, X the locked and the
    current Ritz vectors, by some MINRES steps; the solves run side by side, so that a step costs
    one pass for all. The space grows by the solutions. A few guard pairs are
    brought to a looser bound, so that a leading pair is not passed over.
    """
    pairs = min(dim, wanted + guards)
    wanted = min(dim, wanted)
    rng = np.random.Generator(np.random.PCG64(seed))
    locked, locked_values, locked_residuals = np.zeros((dim, 0)), [], []
    basis = _orthonormal(rng.standard_normal((dim, min(dim, 2 * pairs))))
    image = product(basis)
    for _ in range(ROUNDS):
        small = basis.T @ image
        theta, y = np.linalg.eigh((small + small.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        basis, image = basis @ y, image @ y
        largest = max([*locked_values, *theta[:1], 0.0])
        if largest <= 0:  # no variance at all
            return np.zeros(wanted), np.eye(dim)[:, :wanted], np.zeros(wanted)
        rest = image - basis * theta
        if locked.shape[1]:
            rest = rest - locked @ (locked.T @ rest)
        norms = np.linalg.norm(rest, axis=0)
        exact, loose = 4 * dim * np.finfo(float).eps * largest, 1e-7 * largest
        done = 0  # locked in falling order only
        while done < len(theta) and locked.shape[1] + done < wanted and norms[done] <= exact:
            done += 1
        locked = np.c_[locked, basis[:, :done]]
        locked_values += theta[:done].tolist()
        locked_residuals += norms[:done].tolist()
        basis, image, theta, rest, norms = basis[:, done:], image[:, done:], theta[done:], rest[:, done:], norms[done:]
        open_pairs = max(0, pairs - locked.shape[1])
        near = min(open_pairs, len(theta))
        strict = wanted - locked.shape[1]
        if strict <= 0 and (norms[:near] <= loose).all():
            break
        if basis.shape[1] > BASIS:
            keep = max(2 * pairs, BASIS // 2)
            basis, image = basis[:, :keep], image[:, :keep]
        lanes = [j for j in range(near) if norms[j] > (exact if j < strict else loose)]
        x = np.c_[locked, basis[:, :near]]

        def inside(v: np.ndarray, x: np.ndarray = x) -> np.ndarray:
            return v - x @ (x.T @ v)

        solves = {j: _minres(-inside(rest[:, j]), INNER_STEPS, INNER_TOLERANCE) for j in lanes if norms[j] > 0}
        asked = {j: next(s) for j, s in solves.items()}
        found = []
        while asked:
            at = list(asked)
            given = inside(np.column_stack([asked[j] for j in at]))
            back = inside(product(given) - given * theta[at])
            asked = {}
            for k, j in enumerate(at):
                try:
                    asked[j] = solves[j].send(back[:, k])
                except StopIteration as end:
                    found.append(inside(end.value))
        more = np.column_stack(found) if found else np.zeros((dim, 0))
        # Something new even where a correction vanishes, unless the space is full already.
        more = _orthonormal(np.c_[more, rng.standard_normal((dim, 1))], locked, basis)
        if more.shape[1]:
            basis, image = np.c_[basis, more], np.c_[image, product(more)]
        else:  # all of the space is searched: its own products anew, without what rotations added
            basis = _orthonormal(basis, locked)
            image = product(basis)
    else:
        raise RuntimeError(f"eigenvectors did not converge in {ROUNDS} rounds")
    order = np.argsort(-np.array(locked_values), kind="stable")
    return np.array(locked_values)[order], locked[:, order], np.array(locked_residuals)[order]


def _quantised(vectors: Column, scale: int, kind: str) -> Column:
    return F.transform(vectors, lambda c: F.floor(F.lit(float(scale)) * c.cast("double")).cast(kind))


def _usable(vectors: Column) -> Column:
    """No null vector, none that holds null or non-finite entries, none without entries."""
    bad = F.exists(vectors, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    return F.coalesce((F.size(vectors) > 0) & ~bad, F.lit(False))


def _narrowest(greatest: float) -> tuple[str, str]:
    for spark_type, numpy_type, limit in (("short", "<i2", 2**15), ("int", "<i4", 2**31), ("long", "<i8", 2**53)):
        if greatest < limit - 1:
            return spark_type, numpy_type
    raise ValueError("embedding entries beyond 2**53 after scaling have no exact integer form")


def _block_table(fit_list: DataFrame, dtype: str) -> DataFrame:
    """(data, dim, size): the vectors packed by blocks as a table, which every pass reads."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                data = part.column(0).flatten().to_numpy(zero_copy_only=False).astype(dtype)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([data.tobytes()]), pa.array([len(data) // part.num_rows], type=pa.int32()),
                     pa.array([part.num_rows], type=pa.int64())], ["data", "dim", "size"],
                )

    return saved(fit_list.mapInArrow(run, "data binary, dim int, size long"), "whitening")


def fit_whitening(
    embeddings: DataFrame, vector_col: str = "embedding", components: int = COMPONENTS, scale: int = SCALE
) -> tuple[Fit, int] | None:
    """The fit and the vectors' length; None where no vector can be used."""
    vectors = F.col(f"`{vector_col}`")
    usable = embeddings.where(_usable(vectors)).select(vectors.alias("v"))
    dim, greatest = usable.agg(
        F.max(F.size("v")), F.max(F.array_max(F.transform("v", lambda c: F.abs(c.cast("double") * scale))))
    ).first()
    if dim is None:
        return None
    spark_type, dtype = _narrowest(greatest + 1)
    fit_list = usable.where(F.size("v") == dim).select(_quantised(F.col("v"), scale, spark_type).alias("x")).distinct()
    blocks = _block_table(fit_list, dtype)
    n = blocks.agg(F.sum("size")).first()[0]
    sums = [int(s) for s in _over_blocks(blocks, lambda x: x.sum(axis=0, dtype=np.int64), dim, dtype, whole=True)]
    mean = np.array([s / n for s in sums])
    passes = 0

    def product(columns: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def work(x: np.ndarray) -> np.ndarray:
            y = x - mean
            return y.T @ (y @ columns)

        return np.array(_over_blocks(blocks, work, columns.size, dtype)).reshape(columns.shape) / n

    trace = sum(_over_blocks(blocks, lambda x: ((x - mean) ** 2).sum(axis=0), dim, dtype)) / n
    values, vectors_, residuals = jacobi_davidson(product, dim, components)
    real = values > 16 * dim * np.finfo(float).eps * max(values.max(initial=0.0), 0.0)
    values, vectors_, residuals = values[real], vectors_[:, real], residuals[real]
    error = 0.0
    if len(values):
        k, basis = len(values), vectors_ / np.sqrt(values)

        def moments(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ basis
            return np.vstack([w.T @ w, w.sum(axis=0)])

        found = np.array(_over_blocks(blocks, moments, (k + 1) * k, dtype)).reshape(k + 1, k) / n
        error = float(np.abs(found[:k] - np.outer(found[k], found[k]) - np.eye(k)).max())
    return Fit(n, sums, values, vectors_, float(trace), error, residuals, passes), dim


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """The sum over dimensions of (n * x - S) ** 2, exactly; None where a long cannot hold it."""
    low = np.array([s & 0xFFFFF for s in sums], dtype=np.int64)
    high = np.array([s >> 20 for s in sums], dtype=np.int64)
    if np.abs(x).max(initial=0) < 2**20:
        squares = (x * x).sum(axis=1).tolist()
        crossed = [a + (b << 20) for a, b in zip((x @ low).tolist(), (x @ high).tolist(), strict=True)]
    else:
        rows = x.tolist()
        squares = [sum(a * a for a in row) for row in rows]
        crossed = [sum(a * s for a, s in zip(row, sums, strict=True)) for row in rows]
    own = sum(s * s for s in sums)
    found = [n * n * q - 2 * n * c + own for q, c in zip(squares, crossed, strict=True)]
    return [f if f < 2**63 else None for f in found]


def whiten(
    embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    components: int = COMPONENTS, scale: int = SCALE,
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each usable row and
    leading component.

    Entries c become x = floor(scale * c). The fit list holds each distinct x once; its mean and
    covariance (divisor n, centred before multiplying) define the components, found by
    ``jacobi_davidson`` with distributed products; no covariance matrix is built. The fit list is
    packed in a table of the shared folder, from which every pass reads, so a lost executor costs
    the tasks it had. Rows whose vector is null, has null or non-finite entries, or is shorter than the
    longest vectors of the table, give nothing; a null id stays null; repeated rows give repeated
    results, but count once in the fit; other columns are ignored; an empty table, or one without
    variance, gives no rows, and components without variance are left out. Equal eigenvalues have
    some orthonormal basis of their space. ``deviation`` is null where a long cannot hold it.
    """
    fitted = fit_whitening(embeddings, vector_col, components, scale)
    given = F.col(f"`{id_col}`").cast("long").alias("vec_id")
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], _OUT)
    fit, dim = fitted
    vectors = F.col(f"`{vector_col}`")
    rows = embeddings.where(_usable(vectors) & (F.size(vectors) == dim)).select(
        given, _quantised(vectors, scale, "long").alias("x")
    )
    n, sums, mean, error, k = fit.n, fit.sums, fit.mean, fit.identity_error, len(fit.values)
    basis, explained = fit.vectors / np.sqrt(fit.values), fit.values / fit.trace

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.num_rows
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(m, dim)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, dtype=np.int64)),
                    pa.array([d for d in _deviations(x, n, sums) for _ in range(k)], type=pa.int64()),
                    pa.array(((x - mean) @ basis).ravel()),
                    pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(run, _OUT)
