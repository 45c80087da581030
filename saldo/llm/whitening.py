"""Embedding whitening by FEAST: eigenpairs of the covariance through contour integration.

The covariance is summed by Spark: first the sums of each dimension, then products of
entries centred by the sums' integer means. All of it is whole numbers, so neither the
number of tasks nor a retry changes a digit; what the integer means leave over is taken
out exactly before the one division.

The eigenpairs of the largest eigenvalues come from FEAST. A circle around an interval of
the spectrum is a contour; the integral of the resolvent (zI - V)^-1 along it projects
onto the eigenvectors inside. Quadrature turns the integral into one complex solve for each
node, and nodes of all intervals are independent, so they are tasks. Rayleigh-Ritz in the
projected space gives eigenpairs, which start the next turn until residuals are at rounding
level. The number of eigenvalues above a shift is the number of positive pivots of the
shifted matrix (its inertia); intervals are placed between eigenvalues by it, and every
interval must give exactly as many eigenpairs as the inertia of its two ends says.

Rows then are projected in one pass. Only sums over rows ever leave the tasks: d entries,
then d (d + 1) / 2, then those of the few components; d is at most ``MOST_DIMENSIONS``.

Defined results: rows without a vector, or with a null or non-finite entry, are left out;
vectors of another length than most have (the longer one in a tie), empty ones
always, are left out too; entries beyond ``MOST_SCALED`` after scaling raise an error, as
their products have no exact sum; rows repeat as often as in the input, count as often, and
null ids stay; components whose eigenvalue is zero at rounding level cannot be whitened and
are left out, so equal vectors (or one) give no rows; equal eigenvalues have any orthonormal
basis of their space, the same for all rows; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saldo.session import ensure_checkpoint_dir

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
MOST_DIMENSIONS, MOST_SCALED = 4096, 2**30
#: Eigenvalues of an interval, nodes of a half contour, turns at most.
PER_INTERVAL, NODES, TURNS = 4, 8, 20
#: Span of an interval's eigenvalues over the margin around them; gaps (of the largest entry) that count as none.
WIDEST, NARROW = 8, 1e-9
#: Largest whole number below which doubles are exact.
EXACT = 2**53


def scaled(docs: DataFrame, vector: str, *ids: str) -> DataFrame:
    """(ids, x) of the usable rows, x the vector as whole numbers."""
    entries = F.col(vector).cast("array<double>")
    sound = F.col(vector).isNotNull() & F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = docs.select(*[F.col(i) for i in ids], F.when(sound & (F.size(entries) > 0), entries).alias("_entries"))
    rows = rows.filter(F.col("_entries").isNotNull())
    sizes = rows.groupBy(F.size("_entries").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = sizes["d"] if sizes else 0
    if d > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {d} dimensions; the covariance of at most {MOST_DIMENSIONS} is held")
    big = F.raise_error(F.lit(f"an entry is beyond {MOST_SCALED} after scaling"))
    whole = F.transform(
        "_entries",
        lambda c: F.when(F.abs(c * SCALE) <= MOST_SCALED, F.floor(c * SCALE) + SHIFT).otherwise(big.cast("bigint")),
    )
    return rows.filter(F.size("_entries") == d).select(*ids, whole.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def column_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of rows and the exact sum of every dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = _matrix(batch)
                at = np.arange(x.shape[1])
                yield pa.RecordBatch.from_pydict({"i": at, "n": np.full(len(at), len(x)), "s": x.sum(axis=0)})

    parts = rows.select("x").mapInArrow(run, "i long, n long, s long").groupBy("i")
    found = parts.agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("i").collect()
    return (int(found[0]["n"]) if found else 0), [int(r["s"]) for r in found]


def products(rows: DataFrame, centre: list[int]) -> list[list[int]]:
    """Exact sums of (x_i - centre_i) (x_j - centre_j) over all rows."""
    middle, d = np.array(centre, dtype=np.int64), len(centre)
    above = np.triu_indices(d)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), dtype=np.int64)
        held = 0  # no entry of the total is larger
        for batch in batches:
            if not len(batch):
                continue
            y = _matrix(batch) - middle
            most = int(np.abs(y).max()) ** 2 + 1
            # a block's products stay exact: as doubles, or else as integers
            step, kind = (EXACT // most, np.float64) if most * 64 < EXACT else (max(2**62 // most, 1), np.int64)
            for a in range(0, len(y), step):
                part = y[a : a + step].astype(kind)
                if held + most * len(part) >= 2**62:
                    yield pa.RecordBatch.from_pydict({"i": above[0], "j": above[1], "p": total[above]})
                    total, held = np.zeros((d, d), dtype=np.int64), 0
                total += (part.T @ part).astype(np.int64)
                held += most * len(part)
        if held:
            yield pa.RecordBatch.from_pydict({"i": above[0], "j": above[1], "p": total[above]})

    parts = rows.select("x").mapInArrow(run, "i long, j long, p long").groupBy("i", "j")
    out = [[0] * d for _ in range(d)]
    for r in parts.agg(F.sum(F.col("p").cast("decimal(38,0)")).alias("p")).collect():
        out[r["i"]][r["j"]] = out[r["j"]][r["i"]] = int(r["p"])
    return out


@dataclass(frozen=True)
class Moments:
    """Rows, sums, integer means, and the covariance, each entry rounded once."""

    n: int
    sums: list[int]
    centre: list[int]
    covariance: np.ndarray

    def rest(self) -> list[int]:
        """n times what the integer means leave of the means."""
        return [s - self.n * c for s, c in zip(self.sums, self.centre)]


def moments(rows: DataFrame) -> Moments:
    """Sums and covariance of the vectors of ``rows``."""
    n, sums = column_sums(rows)
    centre = [s // n for s in sums]
    raw = products(rows, centre) if n else []
    rest = [s - n * c for s, c in zip(sums, centre)]
    covariance = [[(n * p - a * b) / (n * n) for p, b in zip(line, rest)] for line, a in zip(raw, rest)]
    return Moments(n, sums, centre, np.array(covariance).reshape(len(sums), len(sums)))


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a matrix congruent to ``v`` with the same shifts (Householder)."""
    a = v.copy()
    d = len(a)
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0:
            continue
        x[0] += np.copysign(norm, x[0])
        x /= np.linalg.norm(x)
        part = a[k + 1 :, k:]
        part -= 2 * np.outer(x, x @ part)
        part = a[k:, k + 1 :]
        part -= 2 * np.outer(part @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def inertia(diagonal: np.ndarray, beside: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie above each shift: the positive pivots of the shifted matrix."""
    tiny = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(beside).max(initial=0.0), np.finfo(float).tiny)
    pivot = diagonal[0] - shifts
    count = np.zeros(len(shifts), dtype=int)
    for k in range(len(diagonal)):
        if k:
            pivot = diagonal[k] - shifts - beside[k - 1] ** 2 / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot > 0
    return count


def located(diagonal: np.ndarray, beside: np.ndarray, wanted: int) -> np.ndarray:
    """The ``wanted`` largest eigenvalues to a small fraction of the largest, by halving on the inertia."""
    reach = np.abs(diagonal) + np.append(np.abs(beside), 0) + np.append(0, np.abs(beside))
    low, high = np.full(wanted, -reach.max()), np.full(wanted, reach.max())
    for _ in range(50):
        middle = (low + high) / 2
        above = inertia(diagonal, beside, middle) > np.arange(wanted)
        low, high = np.where(above, middle, low), np.where(above, high, middle)
    return (low + high) / 2


@dataclass(frozen=True)
class Interval:
    """An interval of the spectrum and how many eigenvalues the inertia counts in it."""

    low: float
    high: float
    inside: int

    def nodes(self) -> list[tuple[complex, complex]]:
        """Gauss-Legendre nodes and weights on the upper half of the circle around the interval."""
        centre, radius = (self.low + self.high) / 2, (self.high - self.low) / 2
        points, weights = np.polynomial.legendre.leggauss(NODES)
        turn = np.exp(1j * np.pi / 2 * (1 - points))
        return [(centre + radius * t, w * radius * t / 2) for t, w in zip(turn, weights)]


def _groups(gap: np.ndarray, start: int, end: int) -> list[tuple[int, int]]:
    """The eigenvalues start ... end as groups whose span is not too wide for the gaps at their ends.

    ``gap[k]`` lies above eigenvalue k. A group is divided at its widest gap, so that the
    contour around it does not cut close to some of its eigenvalues.
    """
    span = gap[start + 1 : end + 1].sum()
    if end == start or span <= WIDEST * min(gap[start], gap[end + 1]) / 2:
        return [(start, end)]
    cut = start + 1 + int(np.argmax(gap[start + 1 : end + 1]))
    if gap[cut] <= NARROW:
        return [(start, end)]
    return _groups(gap, start, cut - 1) + _groups(gap, cut, end)


def intervals(v: np.ndarray, wanted: int) -> list[Interval]:
    """Intervals that together hold the ``wanted`` largest eigenvalues of ``v``, whose largest entry is 1.

    They are bounded in gaps of the spectrum. A bound is never put between eigenvalues
    that are equal at rounding level, so an interval may hold more than ``PER_INTERVAL``.
    """
    diagonal, beside = tridiagonal(v)
    d, some = len(v), min(len(v), wanted + 2 * PER_INTERVAL)
    while True:
        values = located(diagonal, beside, some)
        gap = np.append(np.inf, values[:-1] - values[1:])  # above each eigenvalue
        ends = [k for k in range(wanted, some) if gap[k] > NARROW]
        if ends or some == d:
            break
        some = min(d, 2 * some)
    # of the first gaps below the wanted eigenvalues the widest bounds the last interval
    stop = max((k for k in ends if k < ends[0] + PER_INTERVAL), key=lambda k: gap[k]) if ends else d
    gap = np.append(gap, np.inf)
    out, start = [], 0
    while start < stop:
        end = next((k for k in range(min(start + PER_INTERVAL, stop), stop) if gap[k] > NARROW), stop) - 1
        for first, last in _groups(gap, start, end):
            near = min(gap[first], gap[last + 1], 0.1 * values[0])
            margin = max(values[first] - values[last], near)
            low = values[last] - min(gap[last + 1], margin) / 2
            high = values[first] + min(gap[first], margin) / 2
            above = inertia(diagonal, beside, np.array([low, high]))
            out.append(Interval(float(low), float(high), int(above[0] - above[1])))
        start = end + 1
    if sum(p.inside for p in out) != inertia(diagonal, beside, np.array([out[-1].low]))[0]:
        raise ArithmeticError(f"eigenvalues between the intervals {out}")
    return out


def _solved(spark: SparkSession, v: np.ndarray, tasks: list[tuple], blocks: list[np.ndarray]) -> list[np.ndarray]:
    """The projection of each interval's block: one complex solve a task, summed by interval."""
    shared = spark.sparkContext.broadcast((v, blocks))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matrix, starts = shared.value
        for batch in batches:
            out = []
            for row in batch.itertuples():
                y = starts[row.interval]
                part = np.linalg.solve(complex(row.zr, row.zi) * np.eye(len(matrix)) - matrix, y)
                out.append((row.interval, row.node, (complex(row.wr, row.wi) * part).real.tobytes()))
            yield pd.DataFrame(out, columns=["interval", "node", "block"])

    points = spark.createDataFrame(tasks, "interval int, node int, zr double, zi double, wr double, wi double")
    found = points.repartition(max(len(tasks) // 4, 1)).mapInPandas(run, "interval int, node int, block binary").collect()
    out = [np.zeros_like(b) for b in blocks]
    for r in sorted(found, key=lambda r: (r["interval"], r["node"])):
        out[r["interval"]] += np.frombuffer(r["block"]).reshape(blocks[r["interval"]].shape)
    shared.destroy()
    return out


def ritz(v: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenpairs of ``v`` within the span of a block's columns, falling."""
    # twice is enough: columns that the projection made nearly dependent
    q = np.linalg.qr(np.linalg.qr(block)[0])[0]
    values, inner = np.linalg.eigh(q.T @ v @ q)
    return values[::-1], (q @ inner)[:, ::-1]


def feast(spark: SparkSession, v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a covariance and their unit eigenvectors (columns).

    Raises if an interval does not give as many eigenpairs as its inertia says.
    """
    size = np.abs(v).max()
    parts = intervals(v / size, wanted)
    v = v / size
    draw = np.random.default_rng(0)
    blocks = [draw.standard_normal((len(v), min(len(v), 3 * p.inside // 2 + 3))) for p in parts]
    tasks = [
        (k, m, float(z.real), float(z.imag), float(w.real), float(w.imag))
        for k, p in enumerate(parts)
        for m, (z, w) in enumerate(p.nodes())
    ]
    best = [np.inf] * len(parts)
    kept: list[tuple[np.ndarray, np.ndarray] | None] = [None] * len(parts)
    for _ in range(TURNS):
        projected = _solved(spark, v, tasks, blocks)
        better = False
        for k, (p, block) in enumerate(zip(parts, projected)):
            values, vectors = ritz(v, block)
            blocks[k] = vectors
            residual = np.abs(v @ vectors - vectors * values).max(axis=0)
            inside = np.flatnonzero((values > p.low) & (values <= p.high))
            # what is left of the outside may mix to a value inside, never to a small residual
            inside = np.sort(inside[np.argsort(residual[inside], kind="stable")][: p.inside])
            off = residual[inside].max(initial=0.0)
            if len(inside) == p.inside and off < best[k] / 2:
                better, best[k], kept[k] = True, off, (values[inside], vectors[:, inside])
        if all(k is not None for k in kept) and (not better or max(best) < 1e-15):
            break
    missing = [p for p, k in zip(parts, kept) if k is None]
    if missing or max(best) > 1e-11:
        raise ArithmeticError(f"intervals without all of their eigenpairs: {missing}, residuals {best}")
    values, vectors = ritz(v, np.concatenate([k[1] for k in kept], axis=1))
    return values[:wanted] * size, vectors[:, :wanted]


@dataclass(frozen=True)
class Whitening:
    """What whitens a row: moments, and eigenvalues and eigenvectors of the leading components."""

    moments: Moments
    values: np.ndarray
    vectors: np.ndarray

    def explained(self) -> np.ndarray:
        """Each component's share of the whole variance."""
        return self.values / np.trace(self.moments.covariance)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening:
    """The whitening of ``rows`` (x) by its leading components; fewer where the covariance has less rank."""
    found = moments(rows)
    v = found.covariance
    d = len(v)
    if not d or not np.trace(v) > 0:
        return Whitening(found, np.zeros(0), np.zeros((d, 0)))
    size = np.abs(v).max()
    rank = int(inertia(*tridiagonal(v / size), np.array([d * 1e-13]))[0])
    values, vectors = feast(rows.sparkSession, v, min(components, rank))
    return Whitening(found, values, vectors)


def whitened(rows: DataFrame, model: Whitening, *ids: str) -> DataFrame:
    """(ids, deviation, w) of every row: the exact squared distance from the mean times n squared, and the whitened entries."""
    m = model.moments
    n, rest = m.n, m.rest()
    centre, offset = np.array(m.centre, dtype=np.int64), np.array([r / n for r in rest]) if n else np.zeros(0)
    to = model.vectors / np.sqrt(model.values)
    square = sum(r * r for r in rest)
    high, low = (np.array([f(r, 2**31) for r in rest], dtype=np.int64) for f in (int.__floordiv__, int.__mod__))
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            y = _matrix(batch) - centre
            own = (y.astype(object) ** 2).sum(axis=1) if np.abs(y).max() > 2**25 else (y**2).sum(axis=1).tolist()
            # sum of y * rest in two halves, each of which a long can hold
            cross = [int(a) * 2**31 + int(b) for a, b in zip(y @ high, y @ low)]
            deviation = [str(n * n * int(a) - 2 * n * c + square) for a, c in zip(own, cross)]
            w = (y - offset) @ to
            column = pa.ListArray.from_arrays(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32), w.ravel())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in ids], pa.array(deviation), column], names=[*ids, "deviation", "w"]
            )

    schema = ", ".join([*[f"`{i}` {kinds[i]}" for i in ids], "deviation string, w array<double>"])
    found = rows.mapInArrow(run, schema)
    return found.select(*ids, F.col("deviation").cast("decimal(38,0)").alias("deviation"), "w")


def identity_error(found: DataFrame, components: int) -> Column:
    """The largest entry of the covariance of ``w`` minus the identity, as a literal."""
    entries = [F.element_at("w", k + 1) for k in range(components)]
    off = [
        F.abs(F.covar_pop(entries[a], entries[b]) - (1.0 if a == b else 0.0))
        for a in range(components)
        for b in range(a, components)
    ]
    most = found.agg(*[o.alias(f"c{k}") for k, o in enumerate(off)]).first() if components else None
    return F.lit(max(most) if most and most[0] is not None else None).cast("double")


def whiten(docs: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable row and component."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = scaled(docs, vector, vec_id).withColumnRenamed(vec_id, "vec_id").checkpoint()
    model = fit(rows, components)
    k = len(model.values)
    if not k:
        empty = rows.limit(0).select("vec_id", F.lit(0).cast("decimal(38,0)").alias("deviation"), F.array().cast("array<double>").alias("w"))
        found = empty
    else:
        found = whitened(rows, model, "vec_id").checkpoint()
    error = identity_error(found, k)
    share = F.array(*[F.lit(float(e)) for e in model.explained()]) if k else F.array().cast("array<double>")
    each = found.select("vec_id", "deviation", F.posexplode("w").alias("_at", "whitened"))
    return each.select(
        "vec_id", (F.col("_at") + 1).alias("component"), F.lit(model.moments.n).cast("bigint").alias("n"), "deviation",
        "whitened", F.get(share, F.col("_at")).alias("explained"), error.alias("identity_error"),
    )
