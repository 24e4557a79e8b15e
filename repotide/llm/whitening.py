"""Whitening of embeddings on their leading principal components.

An entry c stands for the whole number x = floor(64 c) + 1,000,000, so sums are exact. Three
passes over the vectors feed the driver with figures whose number depends on the dimension alone:
the sums S of the n vectors, then the products of centred entries (the upper triangle of the
covariance V times n), and, once the components are known, the products of the whitened entries,
which measure how far their covariance is from the identity. Each task adds up its own vectors
before anything moves. A last pass projects each vector where it is read, with the broadcast
model; no vector is ever shuffled.

The eigenvectors of V come from Householder reflections to tridiagonal form, bisection by Sturm
counts for the leading eigenvalues, and inverse iteration with orthogonalisation inside clusters
of close eigenvalues; all of it is numpy on a matrix of dimension x dimension. Components are
numbered by falling eigenvalue; of the two signs the one is taken that makes the entry of largest
absolute value positive.

Vectors that are null or hold null or non-finite entries are dropped. If vectors have several
lengths, the most common one counts (the larger of equally common ones) and others are dropped.
An entry beyond 2**40 / 64 in absolute value counts as that bound. Repeated vectors and ids count
as often as they occur; a null id is kept. A component without variance (an eigenvalue of at most
dimension * 2**-52 of the largest) has null as its whitened value. `deviation` is null where the
exact sum exceeds a long. An empty table, or one of dropped vectors only, gives no rows. Columns
other than the key and the vector are not read.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from repotide.scratch import write_table

#: Scale and shift of an entry, and the number of components.
SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
#: Largest scaled entry.
BOUND = 1 << 40
EPS = float(np.finfo(np.float64).eps)
#: Eigenvalues closer than this share of the norm form a cluster.
CLUSTER = 1e-3


@dataclass(frozen=True)
class Model:
    """What a projection needs; eigenvalues and components belong to the scaled entries."""

    n: int
    dims: int
    sums: list
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray

    @property
    def proper(self):
        """Which components have any variance."""
        top = self.eigenvalues.max(initial=0.0)
        return self.eigenvalues > max(top, 0.0) * self.dims * EPS

    @property
    def explained(self):
        """Share of the variance on each component."""
        return np.maximum(self.eigenvalues, 0.0) / self.trace if self.trace > 0 else np.zeros(len(self.eigenvalues))


def scaled(column):
    """[(row numbers, their scaled entries as longs)] for each length of a column of lists."""
    lists = column.cast(pa.large_list(pa.float64()))
    offsets = lists.offsets.to_numpy()
    entries = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null entries become NaN
    sizes = np.diff(offsets)
    present = ~lists.is_null().to_numpy(zero_copy_only=False)
    out = []
    for dims in np.unique(sizes[present]).tolist():
        rows = np.flatnonzero(present & (sizes == dims))
        block = entries[offsets[rows][:, None] + np.arange(dims)]
        finite = np.isfinite(block).all(axis=1)
        block = np.clip(np.floor(SCALE * block[finite]), -BOUND, BOUND)
        out.append((rows[finite], block.astype(np.int64) + SHIFT))
    return out


def _over_vectors(df, column, each, finish, ddl):
    """mapInArrow that hands `each` the blocks of a task and yields what `finish` makes of it."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ddl)
    arrow = to_arrow_schema(schema)

    def run(batches):
        state = {}
        for batch in batches:
            for _, block in scaled(batch.column(0)):
                each(state, block)
        rows = finish(state)
        if rows:
            arrays = [pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.select(column).mapInArrow(run, schema)


def sums_of(df, column):
    """(n, dims, exact sums) of the vectors of the most common length; None without vectors."""

    def each(state, block):
        n, total = state.get(block.shape[1], (0, 0))
        state[block.shape[1]] = (n + len(block), total + block.sum(axis=0))

    def finish(state):
        return [(dims, n, total.tolist()) for dims, (n, total) in state.items() if n]

    partial = write_table(_over_vectors(df, column, each, finish, "dims int, n long, total array<long>"), "vector-sums")
    most = partial.groupBy("dims").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    if most is None:
        return None
    own = partial.where(F.col("dims") == most.dims).select(F.posexplode("total").alias("at", "x"))
    rows = own.groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()  # one row a dimension
    sums = [0] * most.dims
    for r in rows:
        sums[r["at"]] = int(r["x"])
    return most.n, most.dims, sums


class Centred:
    """Entries less their mean: S / n is split into whole part and rest, so that nothing of a
    large common part is lost."""

    def __init__(self, n, sums):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def __call__(self, block):
        return (block - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, block):
        """Exact sum of (n x - S)**2 of each row, or None beyond a long."""
        away = block - self.whole
        most = (int(np.abs(away).max(initial=0)) + 1) * self.n
        if most * most * max(1, block.shape[1]) < 1 << 63:
            return ((self.n * away - self.rest) ** 2).sum(axis=1).tolist()
        rest = self.rest.tolist()
        exact = (sum((self.n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in away.tolist())
        return [x if x < 1 << 63 else None for x in exact]


def covariance_of(df, column, dims, values, width, n):
    """Covariance (divisor n) of values(block), which has `width` columns with means near 0."""

    def each(state, block):
        if block.shape[1] == dims:
            y = values(block)
            total, products = state.get(0, (0.0, 0.0))
            state[0] = (total + y.sum(axis=0), products + y.T @ y)

    def finish(state):
        if 0 not in state:
            return []
        total, products = state[0]
        return [(i, [float(total[i]), *products[i, i:].tolist()]) for i in range(width)]

    rows = _over_vectors(df, column, each, finish, "i int, cells array<double>")
    cells = rows.select("i", F.posexplode("cells").alias("at", "x")).groupBy("i", "at").agg(F.sum("x").alias("x"))
    matrix, means = np.zeros((width, width)), np.zeros(width)
    for r in cells.collect():  # dims * (dims + 3) / 2 rows
        if r["at"] == 0:
            means[r["i"]] = r["x"] / n
        else:
            j = r["i"] + r["at"] - 1
            matrix[r["i"], j] = matrix[j, r["i"]] = r["x"] / n
    return matrix - np.outer(means, means)


def tridiagonal(matrix):
    """(diagonal, off-diagonal, Q) with matrix = Q T Q', by Householder reflections."""
    a = np.array(matrix, np.float64)
    size = len(a)
    q = np.eye(size)
    for k in range(size - 2):
        x = a[k + 1 :, k].copy()
        if not x[1:].any():
            continue
        norm = np.linalg.norm(x)
        v = x.copy()
        v[0] += np.copysign(norm, x[0])
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = -np.copysign(norm, x[0])
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def norm_of(diagonal, off):
    """Largest row sum of absolute values of the tridiagonal matrix."""
    padded = np.concatenate(([0.0], np.abs(off), [0.0]))
    return float((np.abs(diagonal) + padded[:-1] + padded[1:]).max())


def sturm_counts(diagonal, off, at):
    """Number of eigenvalues below each of the points `at`."""
    tiny = np.finfo(np.float64).tiny / EPS
    floor = max(tiny, EPS * EPS * norm_of(diagonal, off))
    count = np.zeros(len(at), int)
    pivot = np.ones(len(at))
    for k, d in enumerate(diagonal):
        pivot = d - at - (off[k - 1] ** 2 / pivot if k else 0.0)
        pivot = np.where(np.abs(pivot) < floor, -floor, pivot)
        count += pivot < 0
    return count


def leading_eigenvalues(diagonal, off, k):
    """The k largest eigenvalues, falling, each by bisection down to neighbouring doubles."""
    size, norm = len(diagonal), norm_of(diagonal, off)
    low = np.full(k, -norm * (1 + 4 * EPS))
    high = np.full(k, norm * (1 + 4 * EPS))
    below = size - 1 - np.arange(k)  # eigenvalues below the one sought
    for _ in range(1100):
        middle = low + (high - low) / 2
        if not ((middle > low) & (middle < high) & (high - low > EPS * EPS * norm)).any():
            break
        up = sturm_counts(diagonal, off, middle) <= below
        low, high = np.where(up, middle, low), np.where(up, high, middle)
    return low + (high - low) / 2


def solve_shifted(diagonal, off, shifts, right):
    """Solve (T - shift I) x = right for each column, by elimination with row exchanges."""
    size, floor = len(diagonal), EPS * norm_of(diagonal, off)
    x = right.copy()
    one = np.ones(len(shifts))
    upper = np.zeros((3, size, len(shifts)))  # of each finished row: diagonal and the next two
    a, b = diagonal[0] - shifts, (off[0] * one if size > 1 else 0 * one)
    for k in range(size - 1):
        c, d = off[k] * one, diagonal[k + 1] - shifts
        e = off[k + 1] * one if k + 2 < size else 0 * one
        swap = np.abs(c) > np.abs(a)
        pivot = np.where(swap, c, a)
        pivot = np.where(np.abs(pivot) < floor, floor, pivot)
        upper[0, k], upper[1, k], upper[2, k] = pivot, np.where(swap, d, b), np.where(swap, e, 0)
        factor = np.where(swap, a, c) / pivot
        first, second = np.where(swap, x[k + 1], x[k]), np.where(swap, x[k], x[k + 1])
        x[k], x[k + 1] = first, second - factor * first
        a, b = np.where(swap, b, d) - factor * upper[1, k], np.where(swap, 0, e) - factor * upper[2, k]
    upper[0, size - 1] = np.where(np.abs(a) < floor, floor, a)
    for k in range(size - 1, -1, -1):
        rest = x[k]
        if k + 1 < size:
            rest = rest - upper[1, k] * x[k + 1]
        if k + 2 < size:
            rest = rest - upper[2, k] * x[k + 2]
        x[k] = rest / upper[0, k]
        scale = np.abs(x[k:]).max(axis=0)
        x[k:] = np.where(scale > 1e100, x[k:] / np.where(scale > 0, scale, 1), x[k:])
        x[:k] = np.where(scale > 1e100, x[:k] / np.where(scale > 0, scale, 1), x[:k])
    return x


def orthogonal(vectors, clusters):
    """Unit columns, orthogonal to all earlier ones of the same cluster."""
    out = vectors / np.linalg.norm(vectors, axis=0)
    for k in range(out.shape[1]):
        same = np.flatnonzero(clusters[:k] == clusters[k])
        for _ in range(2):  # once more removes what rounding left
            out[:, k] -= out[:, same] @ (out[:, same].T @ out[:, k])
            out[:, k] /= np.linalg.norm(out[:, k])
    return out


def eigenpairs(matrix, k):
    """The k largest eigenvalues, falling, and their unit eigenvectors as columns."""
    diagonal, off, q = tridiagonal(matrix)
    size, norm = len(diagonal), norm_of(diagonal, off)
    if norm == 0:
        return np.zeros(k), np.eye(size)[:, :k]
    values = leading_eigenvalues(diagonal, off, k)
    clusters = np.cumsum(np.append(0, (values[:-1] - values[1:]) > CLUSTER * norm))
    # Equal shifts would give equal directions, so close ones are moved apart a little.
    shifts = values.copy()
    for i in range(1, k):
        shifts[i] = min(shifts[i], shifts[i - 1] - 10 * EPS * norm)
    vectors = orthogonal(np.random.default_rng(0).standard_normal((size, k)), clusters)
    for _ in range(5):
        vectors = orthogonal(solve_shifted(diagonal, off, shifts, vectors), clusters)
    vectors = q @ vectors
    top = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.where(vectors[top, np.arange(k)] < 0, -1.0, 1.0)


def fit(df, column="embedding", k=COMPONENTS):
    """The model of all vectors of a table, or None if there are none."""
    found = sums_of(df, column)
    if found is None:
        return None
    n, dims, sums = found
    if dims == 0:
        return Model(n, 0, [], 0.0, np.zeros(0), np.zeros((0, 0)))
    matrix = covariance_of(df, column, dims, Centred(n, sums), dims, n)
    values, vectors = eigenpairs(matrix, min(k, dims))
    return Model(n, dims, sums, float(np.trace(matrix)), values, vectors)


def _projection(model):
    """Function from scaled entries to whitened ones; NaN on components without variance."""
    centred = Centred(model.n, model.sums)
    with np.errstate(divide="ignore", invalid="ignore"):
        weights = np.where(model.proper, model.components / np.sqrt(model.eigenvalues), np.nan)
    return centred, lambda block: centred(block) @ weights


def identity_error(df, model, column="embedding"):
    """Largest absolute entry of the whitened vectors' covariance less the identity."""
    proper = np.flatnonzero(model.proper)
    if not len(proper):
        return 0.0
    shared = df.sparkSession.sparkContext.broadcast(model)
    values = lambda block: _projection(shared.value)[1](block)[:, proper]
    found = covariance_of(df, column, model.dims, values, len(proper), model.n)
    return float(np.abs(found - np.eye(len(proper))).max())


def projected(df, model, column="embedding", keep=("vec_id",)):
    """The kept columns of each vector of the model's length, its exact deviation and its
    whitened values, in the task that reads it."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    kinds = dict(df.dtypes)
    kept = "".join(f"`{c}` {kinds[c]}, " for c in keep)
    schema = StructType.fromDDL(f"{kept}deviation long, whitened array<double>")
    arrow = to_arrow_schema(schema)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        centred, project = _projection(shared.value)
        for batch in batches:
            for rows, block in scaled(batch.column(0)):
                if block.shape[1] != shared.value.dims or not len(rows):
                    continue
                own = batch.take(pa.array(rows))
                made = project(block)
                flat = pa.array(made.ravel(), mask=np.isnan(made).ravel())
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(made) + 1) * made.shape[1], pa.int32()), flat)
                columns = [own.column(k + 1).cast(arrow[k].type) for k in range(len(keep))]
                arrays = [*columns, pa.array(centred.deviations(block), pa.int64()), values.cast(arrow[-1].type)]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.select(F.col(column), *keep).mapInArrow(run, schema)


RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(df, column="embedding", key="vec_id", k=COMPONENTS):
    """One row per vector and component."""
    spark = df.sparkSession
    model = fit(df, column, k)
    if model is None:
        return spark.createDataFrame([], f"`{key}` {dict(df.dtypes)[key]}, {RESULT}")
    error = identity_error(df, model, column)
    rows = projected(df, model, column, (key,)).select(key, "deviation", F.posexplode("whitened").alias("at", "whitened"))
    shares = F.array(*[F.lit(float(x)) for x in model.explained]) if model.dims else F.array().cast("array<double>")
    return rows.select(
        key,
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
