"""Embedding whitening by a bidiagonal qd solver.

Each task reduces its centred rows block by block to a triangular factor, and the factors are
reduced to one by the same step, a few at a time. That factor, as large as the dimensions and not
the data, is made bidiagonal by Householder reflections; dqds finds the singular values, each to
high relative accuracy, and twisted factorisations give the directions. Rows are then projected
where they lie.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterline.llm.common import settle

COMPONENTS = 32
# Fixed values of the integer form: floor(SCALE * entry) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
# Entries from here on have no integer form in 64 bits.
LARGEST = 2.0**55
FAN_IN = 16
_EPS = np.finfo(np.float64).eps


# --- the solver ------------------------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r = U B Vᵀ, by Householder reflections."""
    a = np.array(r, np.float64)
    n = a.shape[1]
    v = np.eye(n)
    for k in range(n):
        _reflect(a[k:, k:], a[k:, k])
        if k + 2 < n:
            row = a[k, k + 1 :].copy()
            _reflect(a[k:, k + 1 :].T, row)
            _reflect(v[:, k + 1 :].T, row)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _reflect(part: np.ndarray, x: np.ndarray) -> None:
    """Apply to ``part``, from the left, the reflection that leaves x only its first entry."""
    scale = np.abs(x).max(initial=0.0)
    if not scale:
        return
    u = x / scale
    u[0] += math.copysign(np.linalg.norm(u), u[0])
    u /= np.linalg.norm(u)
    part -= np.outer(2 * u, u @ part)


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Eigenvalues, falling, of BᵀB from the squares of B's diagonal and superdiagonal."""
    found: list[float] = []
    todo = [(np.array(q, float).tolist(), np.array(e, float).tolist(), 0.0)]
    while todo:
        q, e, shift = todo.pop()
        low = math.inf
        failed = 0
        if len(q) > 1 and q[0] < q[-1]:
            # Small values come off the end faster if they are there to begin with.
            q, e = q[::-1], e[::-1]
        while q:
            small = _EPS * _EPS
            if len(q) == 1 or e[-1] <= small * (shift + q[-1]):
                found.append(q.pop() + shift)
                if e:
                    e.pop()
                low = math.inf
                continue
            cut = next((i for i in range(len(e) - 2, -1, -1) if e[i] <= small * (shift + q[i])), None)
            if cut is not None:
                todo.append((q[: cut + 1], e[:cut], shift))
                q, e, low = q[cut + 1 :], e[cut + 1 :], math.inf
                continue
            step = 0.0 if failed > 2 else _shift(q, e, low) * 0.25**failed
            nq, ne, least = _dqds_step(q, e, step)
            if least is None:
                failed += 1
                continue
            q, e, low, failed, shift = nq, ne, least, 0, shift + step
    return np.array(sorted(found, reverse=True))


def _shift(q: list[float], e: list[float], low: float) -> float:
    """An estimate of the least eigenvalue: of the last two rows', never above ``low``."""
    a = q[-2] + (e[-2] if len(e) > 1 else 0.0)
    b, c = q[-2] * e[-1], q[-1] + e[-1]
    half = (a - c) / 2
    least = c + half - math.copysign(math.hypot(half, math.sqrt(b)), 1.0)
    return max(0.0, min(least, low) * (1 - 1e-3) if least < low else low * 0.5)


def _dqds_step(q: list[float], e: list[float], shift: float):
    """One differential qd step; the least d is None if the shift was too large."""
    nq, ne = [0.0] * len(q), [0.0] * len(e)
    d = q[0] - shift
    least = d
    for i in range(len(e)):
        if d < 0:
            return q, e, None
        nq[i] = d + e[i]
        ratio = q[i + 1] / nq[i] if nq[i] > 0 else 0.0
        ne[i] = e[i] * ratio
        d = d * ratio - shift if nq[i] > 0 else q[i + 1] - shift
        least = min(least, d)
    if d < 0:
        return q, e, None
    nq[-1] = d
    return nq, ne, least


def _end_at_zeros(a: np.ndarray, b: np.ndarray) -> None:
    """Turn the rest of B's rows so that nothing follows a zero of the diagonal, in place.

    Rotations of rows leave the right vectors alone.
    """
    for i in range(len(b)):
        if abs(a[i]) > _EPS:
            continue
        a[i], over, b[i] = 0.0, b[i], 0.0
        for k in range(i + 1, len(a)):
            size = math.hypot(a[k], over)
            if not size:
                break
            cosine, sine = a[k] / size, over / size
            a[k] = size
            if k < len(b):
                over, b[k] = -sine * b[k], cosine * b[k]


class Twisted:
    """The twisted factorisations of BᵀB - value, for an eigenvalue ``value``.

    B has the diagonal ``a``, without zeros but at its end, and the superdiagonal ``b``, so
    BᵀB = L D Lᵀ with D = a² and l = b / a. L₊D₊L₊ᵀ and U₋D₋U₋ᵀ of L D Lᵀ - value meet at any twist; ``gamma`` says
    how nearly the matrix is singular there.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float):
        n = len(a)
        d, l = a * a, b / a[:-1]
        s, p = np.empty(n), np.empty(n)
        self.pivots = np.empty(n)
        self.down, self.up = np.empty(n - 1), np.empty(n - 1)
        s[0] = -value
        for i in range(n - 1):
            self.pivots[i] = d[i] + s[i] or _EPS * value
            self.down[i] = d[i] * l[i] / self.pivots[i]
            s[i + 1] = self.down[i] * l[i] * s[i] - value
        self.pivots[-1] = d[-1] + s[-1] or _EPS * value
        p[-1] = d[-1] - value
        for i in range(n - 2, -1, -1):
            ratio = d[i] / (d[i] * l[i] * l[i] + p[i + 1] or _EPS * value)
            self.up[i] = l[i] * ratio
            p[i] = p[i + 1] * ratio - value
        self.gamma = np.abs(s + p + value)

    def vector(self) -> np.ndarray:
        """The eigenvector, from the twist of the least gamma."""
        at = int(np.nanargmin(self.gamma))
        z = np.zeros(len(self.gamma))
        z[at] = 1.0
        with np.errstate(over="ignore", invalid="ignore"):
            for i in range(at - 1, -1, -1):
                z[i] = -self.down[i] * z[i + 1]
            for i in range(at, len(self.up)):
                z[i + 1] = -self.up[i] * z[i]
        z = np.nan_to_num(z, posinf=0.0, neginf=0.0)
        return z / np.linalg.norm(z)

    def other_vector(self, known: np.ndarray) -> np.ndarray:
        """One more eigenvector of (nearly) the same value, orthogonal to the columns ``known``.

        Inverse iteration, from the place of small gamma in which the known ones have least.
        """
        left = np.maximum(1 - np.square(known).sum(axis=1), _EPS)
        z = np.zeros(len(left))
        z[int(np.nanargmin(self.gamma / left**2))] = 1.0
        for _ in range(4):
            z = _apart(z, known)
            z = _apart(self._solve(z / np.linalg.norm(z)), known)
            z /= np.linalg.norm(z)
        return z

    def _solve(self, x: np.ndarray) -> np.ndarray:
        y = x.copy()
        for i in range(1, len(y)):
            y[i] -= self.down[i - 1] * y[i - 1]
        y /= self.pivots
        for i in range(len(y) - 2, -1, -1):
            y[i] -= self.down[i] * y[i + 1]
        return y / np.abs(y).max()


def _apart(z: np.ndarray, known: np.ndarray) -> np.ndarray:
    for _ in range(2):
        z = z - known @ (known.T @ z)
    return z


def right_vectors(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest singular values of r, falling, and their right vectors as columns.

    Values that are zero to working precision are left out. Where the bidiagonal form falls apart
    its parts are solved one by one, so that their vectors are orthogonal; vectors of close values
    of one part are made orthogonal to each other.
    """
    a, b, v = bidiagonal(r)
    norm = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if not norm:
        return np.empty(0), np.empty((len(a), 0))
    # Scaled, so that squares neither overflow nor vanish.
    a, b = a / norm, b / norm
    b = np.where(np.abs(b) <= _EPS, 0.0, b)
    _end_at_zeros(a, b)
    cuts = [0, *(np.flatnonzero(b == 0) + 1).tolist(), len(a)]
    pairs = []
    for first, last in itertools.pairwise(cuts):
        for value in dqds(a[first:last] ** 2, b[first : last - 1] ** 2).tolist():
            pairs.append((value, first, last))
    pairs.sort(key=lambda x: (-x[0], x[1]))
    least = len(a) * _EPS * math.sqrt(pairs[0][0])
    pairs = [x for x in pairs if math.sqrt(max(x[0], 0.0)) > least][:count]
    z = np.zeros((len(a), len(pairs)))
    for i, (value, first, last) in enumerate(pairs):
        part = slice(first, last)
        close = [j for j in range(i) if pairs[j][1] == first and pairs[j][0] <= value * (1 + 1e-3)]
        known = z[part, close]
        form = Twisted(a[part], b[first : last - 1], value)
        own = _apart(form.vector(), known)
        if np.linalg.norm(own) < 0.5:
            own = form.other_vector(known)
        z[part, i] = own / np.linalg.norm(own)
    values = norm * np.sqrt(np.array([x[0] for x in pairs]))
    vectors = v @ z
    largest = np.abs(vectors).argmax(axis=0)
    vectors *= np.sign(vectors[largest, np.arange(len(pairs))])
    return values, vectors


# --- Spark -----------------------------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows whose vector is not null, not empty and all finite."""
    fits = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(LARGEST)),
    )
    return vectors.select("vec_id", "embedding").where(fits & (F.size("embedding") > 0))


def _integers(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, x) for each length of vectors in a batch."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        flat = column.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        x = np.floor(SCALE * flat.astype(np.float64)).astype(np.int64) + SHIFT
        yield size, rows, x.reshape(len(rows), size)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and length of vectors: the number of rows and the exact sum in each dimension."""
    counts: dict[int, int] = {}
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for size, rows, x in _integers(batch.column("embedding")):
            counts[size] = counts.get(size, 0) + len(rows)
            # Halves of 2**30 that no batch's sum takes past 64 bits.
            low, high = x & (2**30 - 1), x >> 30
            total = high.sum(axis=0).astype(object) * 2**30 + low.sum(axis=0).astype(object)
            sums[size] = sums.get(size, 0) + total
    for size, n in counts.items():
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([size]),
                pa.array([n]),
                pa.array([[str(s) for s in sums[size]]], pa.list_(pa.string())),
            ],
            names=["size", "n", "sums"],
        )


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: in 64 bits if it fits, else in whole numbers of any size."""
    at = np.abs(x).max(initial=0)
    if (int(at) + 1) * n + max(map(abs, sums)) < 2**62:
        return x * n - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def _triangle(rows: np.ndarray) -> np.ndarray:
    """The triangular factor of rows, square however few rows there are."""
    r = np.linalg.qr(rows, mode="r")
    out = np.zeros((rows.shape[1], rows.shape[1]))
    out[: len(r)] = r
    return out


def _factors(batches, fits: dict[int, tuple[int, list[int]]]) -> Iterator[pa.RecordBatch]:
    """Per task and length of vectors: the triangular factor of its centred rows."""
    made: dict[int, np.ndarray] = {}
    for batch in batches:
        for size, _, x in _integers(batch.column("embedding")):
            n, sums = fits[size]
            centred = _deviations(x, n, sums).astype(np.float64) / n
            step = max(4 * size, 1024)
            for at in range(0, len(centred), step):
                block = centred[at : at + step]
                made[size] = _triangle(np.vstack([made[size], block]) if size in made else block)
    yield from _packed(made)


def _reduced(batches) -> Iterator[pa.RecordBatch]:
    """The factor of all factors of a group, taken in their order."""
    made: dict[int, np.ndarray] = {}
    for batch in batches:
        made = _unpacked(batch.to_pylist(), made)
    yield from _packed(made)


def _unpacked(rows, made: dict[int, np.ndarray] | None = None) -> dict[int, np.ndarray]:
    """One factor of each size from rows with ``size`` and ``factor``, added to those ``made``."""
    made = dict(made or {})
    for row in rows:
        size = row["size"]
        r = np.frombuffer(row["factor"]).reshape(size, size)
        made[size] = _triangle(np.vstack([made[size], r])) if size in made else r
    return made


def _packed(made: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for size, r in made.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([size]), pa.array([r.tobytes()], pa.binary())], names=["size", "factor"]
        )


def _moments(batches, fits, axes) -> Iterator[pa.RecordBatch]:
    """Per task and length: sums of products of the whitened rows, and their sums beside them."""
    made: dict[int, np.ndarray] = {}
    for batch in batches:
        for size, _, x in _integers(batch.column("embedding")):
            w = _whitened(x, *fits[size], axes[size][0])
            both = np.hstack([w, np.ones((len(w), 1))])
            made[size] = made.get(size, 0) + both.T @ both
    for size, m in made.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([size]), pa.array([m.reshape(-1).tolist()], pa.list_(pa.float64()))],
            names=["size", "moments"],
        )


def _whitened(x: np.ndarray, n: int, sums: list[int], axes: np.ndarray) -> np.ndarray:
    return _deviations(x, n, sums).astype(np.float64) / n @ axes


def _rows(batches, fits, axes, errors) -> Iterator[pa.RecordBatch]:
    """The result's rows of each batch, a few vectors at a time."""
    for whole in batches:
        for at in range(0, len(whole), 2048):
            batch = whole.slice(at, 2048)
            for size, rows, x in _integers(batch.column("embedding")):
                n, sums = fits[size]
                own, explained = axes[size]
                count = len(explained)
                if not count:
                    continue
                away = _deviations(x, n, sums)
                bound = max(abs(int(away.min())), abs(int(away.max())))
                if bound * bound * size < 2**63:
                    squares = np.square(away.astype(np.int64)).sum(axis=1).tolist()
                else:
                    squares = [sum(int(d) ** 2 for d in row) for row in away]
                    squares = [s if s < 2**63 else None for s in squares]
                white = away.astype(np.float64) / n @ own
                many = len(rows) * count
                again = pa.array(np.repeat(rows, count))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(again),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(many, n)),
                        pa.array(squares, pa.int64()).take(
                            pa.array(np.repeat(np.arange(len(rows)), count))
                        ),
                        pa.array(white.reshape(-1)),
                        pa.array(np.tile(explained, len(rows))),
                        pa.array(np.full(many, errors[size])),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained",
                           "identity_error"],
                )


def fit(vectors: DataFrame, components: int = COMPONENTS):
    """(fits, axes): for each length of vectors n and S, and the whitening axes with what they
    explain.

    What reaches the driver is as large as the dimensions: sums, and one triangular factor.
    """
    parts = vectors.mapInArrow(_sums, "size long, n long, sums array<string>")
    whole = F.col("s").cast("decimal(38,0)")
    totals = (
        settle(parts)
        .select("size", "n", F.posexplode("sums").alias("place", "s"))
        .groupBy("size", "place")
        .agg(F.sum("n").alias("n"), F.sum(whole).alias("s"), F.count("*").alias("tasks"))
    )
    fits: dict[int, tuple[int, list[int]]] = {}
    groups = 1
    for size, _, n, s, tasks in totals.orderBy("size", "place").collect():
        fits.setdefault(size, (n, []))[1].append(int(s))
        groups = max(groups, tasks)
    factors = vectors.mapInArrow(partial(_factors, fits=fits), "size long, factor binary")
    factors = settle(factors.withColumn("place", F.spark_partition_id().cast("long")))
    while groups > 1:
        groups = -(-groups // FAN_IN)
        # Groups by rank, so that no task gets more factors than FAN_IN or so of each length.
        dealt = factors.repartition(groups, F.pmod("place", F.lit(groups)))
        merged = dealt.sortWithinPartitions("size", "place").select("size", "factor")
        factors = settle(
            merged.mapInArrow(_reduced, "size long, factor binary")
            .withColumn("place", F.spark_partition_id().cast("long"))
        )
    axes = {}
    for size, r in _unpacked(factors.orderBy("size", "place").collect()).items():
        values, directions = right_vectors(r, components)
        trace = float(np.square(r).sum())
        n = fits[size][0]
        axes[size] = (directions / (values / math.sqrt(n)), np.square(values) / (trace or 1.0))
    return fits, axes


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Every usable vector on every component of the whitening fitted to all of them.

    Input: ``vec_id``, ``embedding`` (array of float or double) and any other columns. Entries c
    count as x = floor(64 c) + 1000000. Result, a row per vector and component: ``vec_id``,
    ``component`` (from 1, by falling eigenvalue of x's covariance), ``n`` (vectors fitted),
    ``deviation`` (the exact sum over dimensions of (n x - S)², null where 64 bits do not hold
    it), ``whitened`` (the centred vector on the component over the square root of its eigenvalue),
    ``explained`` (its share of the covariance's trace) and ``identity_error`` (the largest entry
    of whitened's covariance, measured over all rows, less the identity).

    Rows drop out whose vector is null, empty or holds a null, a NaN, an infinity or an entry of
    2**55 or more, which has no such integer. Vectors of another length are a space of their own,
    fitted to themselves; lengths are few. Components whose eigenvalue is zero to working precision
    do not exist, so fewer vectors than dimensions, or equal ones, give fewer components or no
    rows. Repeated rows and ids count each time; a null ``vec_id`` is kept. An empty table gives no
    rows.
    """
    used = usable(vectors)
    fits, axes = fit(used, components)
    errors = {}
    moments = used.mapInArrow(
        partial(_moments, fits=fits, axes=axes), "size long, moments array<double>"
    )
    summed = (
        settle(moments)
        .select("size", F.posexplode("moments").alias("place", "m"))
        .groupBy("size", "place")
        .agg(F.sum("m").alias("m"))
    )
    flat: dict[int, list[float]] = {}
    for size, _, m in summed.orderBy("size", "place").collect():
        flat.setdefault(size, []).append(m)
    for size, m in flat.items():
        side = len(axes[size][1]) + 1
        m = np.array(m).reshape(side, side) / fits[size][0]
        covariance = m[:-1, :-1] - np.outer(m[:-1, -1], m[:-1, -1])
        errors[size] = float(np.abs(covariance - np.eye(side - 1)).max(initial=0.0))
    kind = used.schema["vec_id"].dataType.simpleString()
    return used.mapInArrow(
        partial(_rows, fits=fits, axes=axes, errors=errors),
        f"""vec_id {kind}, component int, n long, deviation long, whitened double,
            explained double, identity_error double""",
    )
