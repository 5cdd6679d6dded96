"""Whitening of embeddings by spectral divide and conquer.

Sums and centred products of the distinct vectors are whole numbers, so they are added
up exactly and do not depend on how Spark deals the rows.  The covariance, a matrix as
wide as a vector whatever the number of rows, is split on the driver: the polar factor
of the shifted covariance is the sign of its eigenvalues around the shift, which gives
projectors on two invariant subspaces, and so on until subspaces have one dimension.
Polar factors come from dynamically weighted Halley iterations on QR factors (QDWH).
The components are broadcast and every row is projected where it lies.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from sheafline.llm.common import written

COMPONENTS = 4
SCALE = 256
EPS = np.finfo(np.float64).eps
# A few more than the iterations QDWH needs for the worst condition in doubles.
MOST_ITERATIONS = 12
MOST_SHIFTS = 20
SEED = 31
EXACT_DOUBLE = 1 << 53
EXACT_LONG = 1 << 62
# Bits of a digit in which sums travel; over a million tasks can add up theirs.
LIMB = 40


def polar_factor(a):
    """The unitary polar factor of a symmetric matrix.

    Each step maps a singular value x to x (a + b x^2) / (1 + c x^2), with weights
    that raise the lower bound ``low`` of all singular values as fast as possible.
    """
    n = len(a)
    x = a / np.linalg.norm(a)
    # 1 / |inverse| bounds the least singular value from below; R of a QR factorisation has the same.
    r = np.linalg.qr(x, mode="r")
    diagonal = np.abs(np.diag(r))
    low = EPS if diagonal.min() < EPS else max(EPS, 0.9 / np.linalg.norm(np.linalg.inv(r)))
    for _ in range(MOST_ITERATIONS):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d))))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))[0]
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(1.0, low * (wa + wb * square) / (1 + wc * square))
        if moved < np.cbrt(EPS) and abs(1 - low) < 10 * EPS:
            break
    return x


def split_basis(a, shift, random):
    """Orthonormal bases of the invariant subspaces above and below ``shift``; None if the shift does not part them."""
    n = len(a)
    projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
    rank = round(float(np.trace(projector)))
    if not 0 < rank < n:
        return None
    above = np.linalg.qr(projector @ random.standard_normal((n, rank)))[0]
    above = np.linalg.qr(projector @ above)[0]
    whole = np.linalg.qr(above, mode="complete")[0]
    above, below = whole[:, :rank], whole[:, rank:]
    left = np.abs(below.T @ a @ above).max()
    return (above, below) if left <= 100 * n * EPS * np.linalg.norm(a) else None


def spectrum(a):
    """(eigenvalues, unit eigenvectors as columns) of a symmetric matrix, by falling eigenvalue."""
    if not len(a):
        return np.zeros(0), np.zeros((0, 0))
    random = np.random.default_rng(SEED)
    scale, found, todo = np.linalg.norm(a), [], [(a, np.eye(len(a)))]
    while todo:
        block, basis = todo.pop()
        n = len(block)
        middle = np.trace(block) / n
        if np.linalg.norm(block - middle * np.eye(n)) <= 4 * n * EPS * scale:
            found += list(basis.T)
            continue
        # The median balances the halves; the mean always has eigenvalues on both sides.
        shifts = [float(np.median(np.diag(block))), middle]
        spread = np.linalg.norm(block - middle * np.eye(n)) / n
        shifts += [middle + spread * random.uniform(-1, 1) for _ in range(MOST_SHIFTS)]
        halves = next((h for s in shifts if (h := split_basis(block, s, random)) is not None), None)
        if halves is None:
            raise ArithmeticError("no shift parts the spectrum")
        for half in halves:
            part = half.T @ block @ half
            todo.append(((part + part.T) / 2, basis @ half))
    vectors = np.array(found).T
    vectors = vectors / np.linalg.norm(vectors, axis=0)
    # Rayleigh quotients on the undivided matrix take back the rounding of the levels.
    values = (vectors * (a @ vectors)).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _whole(vectors):
    return np.array(vectors.tolist(), dtype=np.int64).reshape(len(vectors), -1)


def _size(x):
    """Largest entry in size, as a Python number; -2**63 has no long of its own."""
    return max(abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))


def exact_sum(total, part):
    """``total + part`` of whole numbers; as Python numbers where longs may be too short."""
    if total is None:
        return part
    if object not in (total.dtype, part.dtype) and _size(total) + _size(part) < EXACT_LONG:
        return total + part
    return total.astype(object) + part.astype(object)


def _shipped(total):
    """Whole numbers as (place, limb, digit) in base 2**LIMB; sums of digits stay within longs."""
    rest, limb, parts = total.ravel(), 0, []
    while len(at := np.flatnonzero(rest)):
        # All above the lowest limb of a small negative number is -1, which ends the digits.
        last = (rest >> LIMB == 0) | (rest >> LIMB == -1)
        digit = np.where(last, rest, rest & ((1 << LIMB) - 1))
        parts.append(pd.DataFrame({"place": at, "limb": limb, "digit": digit[at].astype(np.int64)}))
        rest, limb = np.where(last, 0, rest >> LIMB), limb + 1
    return pd.concat(parts) if parts else pd.DataFrame({"place": [], "limb": [], "digit": []}, dtype="int64")


def _added(rows, function, size):
    """Sums over all tasks of what ``function`` makes of a block of vectors, as Python numbers."""

    def partial(frames):
        total = None
        for frame in frames:
            if len(frame):
                total = exact_sum(total, function(_whole(frame["x"])))
        if total is not None:
            yield _shipped(total)

    digits = rows.select("x").mapInPandas(partial, "place int, limb int, digit long")
    total = [0] * size
    for row in digits.groupBy("place", "limb").agg(F.sum("digit").alias("digit")).collect():
        total[row["place"]] += row["digit"] << (LIMB * row["limb"])
    return total


def column_sums(x):
    """Exact sums of the columns of whole vectors."""
    return x.sum(0) if _size(x) * max(1, len(x)) < EXACT_LONG else x.astype(object).sum(0)


def exact_gram(z):
    """``z.T @ z`` of whole numbers, exactly."""
    bound = _size(z) ** 2 * max(1, len(z))
    if bound < EXACT_DOUBLE:
        return (z.astype(np.float64).T @ z.astype(np.float64)).astype(np.int64)
    z = z if bound < EXACT_LONG else z.astype(object)
    return z.T @ z


def covariance(fit):
    """(number, sums, covariance) of the vectors ``x`` of ``fit``; sums are Python numbers.

    Vectors are centred on the whole number below the mean before they are multiplied;
    what remains of the mean is taken off exactly, and each entry is rounded once.
    """
    n = fit.count()
    if n == 0:
        return 0, [], np.zeros((0, 0))
    d = fit.select(F.size("x").alias("d")).first()["d"]
    sums = _added(fit, column_sums, d)
    centre = [s // n for s in sums]

    def centred(x):
        low, high = min(centre, default=0), max(centre, default=0)
        near = _size(x) + max(abs(low), abs(high)) < EXACT_LONG
        return exact_gram(x - np.array(centre, dtype=np.int64 if near else object))

    gram = _added(fit, centred, d * d)
    rest = [s - n * c for s, c in zip(sums, centre)]
    matrix = [[float(Fraction(n * gram[i * d + j] - rest[i] * rest[j], n * n)) for j in range(d)] for i in range(d)]
    return n, sums, np.array(matrix).reshape(d, d)


class Projection:
    """What every task needs to whiten vectors: number, sums and scaled components."""

    def __init__(self, n, sums, basis):
        self.n, self.sums, self.basis = n, sums, basis
        self.most = max((abs(s) for s in sums), default=0)

    def __call__(self, x):
        """(deviations as exact whole numbers, projections of x - sums / n) of whole vectors."""
        reach = self.n * _size(x) + self.most
        kind = np.int64 if reach < EXACT_LONG else object
        moved = self.n * x.astype(kind) - np.array(self.sums, dtype=kind)
        squares = moved if reach * reach * max(1, len(self.sums)) < EXACT_LONG else moved.astype(object)
        return (squares * squares).sum(1), moved.astype(np.float64) / self.n @ self.basis


def scaled_rows(vectors, vec_id, vector):
    """(id, x) of the usable rows, x as longs, all of the most frequent length."""
    c = F.col(vector)
    finite = F.forall(c, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    x = F.transform(c, lambda v: F.floor(F.lit(float(SCALE)) * v.cast("double")).cast("long"))
    rows = vectors.select(F.col(vec_id).alias("id"), F.when(finite & (F.size(c) > 0), x).alias("x")).where("x IS NOT NULL")
    rows = written(rows, "scaled")
    lengths = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("x") == lengths[0]["d"]) if lengths else rows


def whiten(vectors, vec_id="vec_id", vector="embedding", components=COMPONENTS):
    """(id, component, n, deviation, whitened, explained, identity_error) per row and leading component.

    The model is fitted on each distinct vector once.  Rows whose vector is null, empty or
    holds null or non-finite components are dropped, and so are vectors of another than the
    most frequent length (of equally frequent ones the longest).  Repeated rows are
    whitened each; ``id`` may be null.  A component without variance, above rounding, has
    null ``whitened`` values; ``explained`` is null if nothing varies, ``identity_error`` if
    no component does.  A ``deviation`` beyond the range of a long is null.  An empty
    table gives an empty result; other columns are not read.  Values floor(256 c) beyond the
    range of a long are cut to it.
    """
    spark = vectors.sparkSession
    rows = scaled_rows(vectors, vec_id, vector)
    fit = written(rows.select("x").distinct(), "fit")
    n, sums, matrix = covariance(fit)
    values, basis = spectrum(matrix)
    taken = min(components, len(values))
    real = values[:taken] > len(values) * EPS * values.max(initial=0.0)
    trace = float(np.trace(matrix))
    scales = np.where(real, 1 / np.sqrt(np.where(real, values[:taken], 1.0)), 0.0)
    sent = spark.sparkContext.broadcast(Projection(n, sums, basis[:, :taken] * scales))

    # The model is held against its own fit list: the covariance of what comes out.
    def moments(frames):
        total = np.zeros((taken + 1, taken + 1))
        for frame in frames:
            if len(frame):
                out = np.column_stack([sent.value(_whole(frame["x"]))[1], np.ones(len(frame))])
                total += out.T @ out
        yield pd.DataFrame({"place": np.arange(total.size), "total": total.ravel()})

    error = None
    if real.any():
        found = fit.mapInPandas(moments, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
        total = np.zeros((taken + 1) ** 2)
        for row in found.collect():
            total[row["place"]] = row["total"]
        total = total.reshape(taken + 1, taken + 1) / n
        got = total[:taken, :taken] - np.outer(total[:taken, taken], total[:taken, taken])
        error = float(np.abs(got - np.eye(taken))[np.ix_(real, real)].max())

    @F.pandas_udf("deviation long, whitened array<double>")
    def project(x: pd.Series) -> pd.DataFrame:
        deviation, white = sent.value(_whole(x))
        exact = [int(v) if int(v) < 1 << 63 else None for v in deviation]
        return pd.DataFrame({"deviation": pd.array(exact, dtype="Int64"), "whitened": list(white)})

    def by_component(numbers):
        each = F.array(*[F.lit(None if v is None else float(v)).cast("double") for v in numbers])
        return F.element_at(each.cast("array<double>"), F.col("component"))

    done = rows.select("id", project("x").alias("out")).select(
        "id", "out.deviation", F.posexplode("out.whitened").alias("component", "whitened")
    )
    return done.withColumn("component", F.col("component") + 1).select(
        "id",
        "component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        # Scaled by 0 where a component has no variance.
        F.when(by_component(real) == 1, F.col("whitened")).alias("whitened"),
        by_component([v / trace if trace > 0 else None for v in values[:taken]]).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
