"""Embedding whitening by QDWH spectral divide and conquer.

Entries become whole numbers, x = floor(1024 * c) + 100000, so counts and sums are exact whatever the
order in which tasks add them. The covariance is added up from centred entries, per task and then per
matrix row; only the sums and the d x d covariance come to the driver, whose size the dimension bounds.

There the symmetric matrix is split: the polar factor U of (V - shift * I), found by the dynamically
weighted Halley iteration, gives the projector (I + U) / 2 on the eigenvectors above the shift. Pivoted
columns of the projector give bases of that invariant subspace and of its complement, V restricted to
each is split again, and so on to single components; only subspaces that can hold one of the wanted
components are split further. The tasks get the d x k whitening matrix and project their rows.

Cases: rows whose vector is null, has a null or non-finite entry or fewer entries than the longest one
(its last entries count as null) are dropped; entries beyond 2^40 count as 2^40; of equal eigenvalues
any orthonormal components may come; a component whose eigenvalue is zero to double precision cannot be
whitened and is left out, so vectors that are all equal give no rows; a deviation above the largest long
is null; repeated rows and null ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.texts import rows, saved

COMPONENTS = 8
# Scale and offset of the whole numbers.
SCALE, OFFSET, LARGEST = 1024, 100_000, 2.0**40
EPS = float(np.finfo(float).eps)
#: Rows that a task multiplies at once.
BLOCK = 4096


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """vec_id, entries (array of double) of the rows that are kept, and their dimension."""
    entries = F.col("embedding").cast("array<double>")
    longest = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    whole = F.forall("entries", lambda c: F.coalesce(F.abs(c) < float("inf"), F.lit(False)) & ~F.isnan(F.coalesce(c, F.lit(float("nan")))))
    kept = vectors.select("vec_id", entries.alias("entries")).where((F.size("entries") == longest) & whole)
    return kept, max(longest, 0)


def numbers(batch: pa.RecordBatch, dimension: int) -> np.ndarray:
    values = batch["entries"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)
    return np.floor(SCALE * np.clip(values, -LARGEST, LARGEST)).astype(np.int64) + OFFSET


@dataclass
class Centre:
    """Number of vectors and exact sums of their entries."""

    n: int
    sums: list[int]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - sums / n, exact up to the last rounding."""
        whole, rest = self._parts()
        return (x - whole) - rest / self.n

    def _parts(self) -> tuple[np.ndarray, np.ndarray]:
        parts = [divmod(s, self.n) for s in self.sums]
        return np.array([q for q, _ in parts], np.int64), np.array([r for _, r in parts], np.int64)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum over dimensions of (n * x - sums)^2."""
        whole, rest = self._parts()
        off = x - whole
        bound = (np.abs(off).max(initial=0) + 1.0) * self.n
        if bound * bound * x.shape[1] < 2.0**62:
            return ((self.n * off - rest) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * a - b) ** 2 for a, b in zip(row, rest.tolist())) for row in off.tolist()]
        return [v if v < 2**63 else None for v in exact]


def centre(vectors: DataFrame, dimension: int) -> Centre:
    """Sums per dimension, in two halves so that no partial sum leaves a long."""
    names = ("place", "n", "high", "low")
    schema = pa.schema([(n, pa.int64()) for n in names])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low, n = np.zeros(dimension, np.int64), np.zeros(dimension, np.int64), 0
        for batch in batches:
            x = numbers(batch, dimension)
            high += (x >> 32).sum(axis=0)
            low += (x & 0xFFFFFFFF).sum(axis=0)
            n += len(x)
        yield rows(schema, np.arange(dimension), np.full(dimension, n), high, low)

    found = vectors.mapInArrow(each, ", ".join(f"{n} long" for n in names))
    total = found.groupBy("place").agg(*[F.sum(c).alias(c) for c in names[1:]]).orderBy("place").collect()
    return Centre(total[0]["n"] if total else 0, [(r["high"] << 32) + r["low"] for r in total])


def covariance(vectors: DataFrame, around: Centre) -> np.ndarray:
    """Mean of the products of centred entries; one matrix row is added up by one task."""
    d = len(around.sums)
    form, schema = "place int, sums binary", pa.schema([("place", pa.int32()), ("sums", pa.binary())])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x = numbers(batch, d)
            for at in range(0, len(x), BLOCK):
                y = around.centred(x[at : at + BLOCK])
                total += y.T @ y
        yield rows(schema, np.arange(d), [row.tobytes() for row in total])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, sums in zip(batch["place"].to_pylist(), batch["sums"]):
                total[place] = total.get(place, 0.0) + np.frombuffer(sums.as_py())
        yield rows(schema, list(total), [v.tobytes() for v in total.values()])

    found = vectors.mapInArrow(products, form).repartition("place").mapInArrow(added, form).collect()
    full = np.zeros((d, d))
    for r in found:
        full[r["place"]] = np.frombuffer(r["sums"])
    full /= around.n
    return (full + full.T) / 2


def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by the QR-based dynamically weighted Halley iteration."""
    m, least = len(a), EPS
    x = a / np.linalg.norm(a)
    for _ in range(20):
        square = least * least
        root = (4 * (1 - square) / (square * square)) ** (1 / 3)
        first = np.sqrt(1 + root)
        one = first + np.sqrt(8 - 4 * root + 8 * (2 - square) / (square * first)) / 2
        two = (one - 1) ** 2 / 4
        three = one + two - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(three) * x, np.eye(m)]))
        new = two / three * x + (one - two / three) / np.sqrt(three) * q[:m] @ q[m:].T
        new = (new + new.T) / 2
        least = min(1.0, least * (one + two * square) / (1 + three * square))
        done = abs(1 - least) < 10 * EPS and np.linalg.norm(new - x) < 1e-7 * np.sqrt(m)
        x = new
        if done:
            break
    return x


def split(a: np.ndarray, size: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of two invariant subspaces, the one of larger eigenvalues first; None if all are equal."""
    m, diagonal = len(a), np.diag(a)
    mean = diagonal.mean()
    spread = np.linalg.norm(a - mean * np.eye(m))
    if spread <= 4 * m * EPS * size:
        return None
    # a shift may hit an eigenvalue or leave all on one side; the mean lies between them, and so do shifts near it
    near = [mean + k * spread / m / 16 for k in (0, 1, -1, 2, -2, 3, -3, 5, -5)]
    best = None
    for shift in [float(np.median(diagonal)), *near]:
        projector = (np.eye(m) + polar(a - shift * np.eye(m))) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < m:
            continue
        upper, lower = bases(projector, rank)
        left = np.linalg.norm(lower.T @ a @ upper)
        if best is None or left < best[0]:
            best = left, upper, lower
        if left <= 8 * m * EPS * size:
            break
    return best[1:] if best else None


def bases(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Bases of a projector's range and of its complement, from `rank` pivoted columns."""
    left, chosen = projector.copy(), []
    for _ in range(rank):
        k = int(np.argmax((left * left).sum(axis=0)))
        chosen.append(k)
        unit = left[:, k] / np.linalg.norm(left[:, k])
        left -= np.outer(unit, unit @ left)
    start, _ = np.linalg.qr(projector[:, chosen])
    # once more through the projector: the basis is then as exact as the projector
    full, _ = np.linalg.qr(projector @ start, mode="complete")
    return full[:, :rank], full[:, rank:]


def components(v: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The `count` largest eigenvalues, falling, and their unit eigenvectors as columns."""
    size = float(np.linalg.norm(v))
    found: list[np.ndarray] = []
    # subspaces by falling eigenvalues, the largest on top
    open_: list[np.ndarray] = [np.eye(len(v))]
    while open_ and len(found) < count:
        basis = open_.pop()
        inner = basis.T @ v @ basis
        parts = split((inner + inner.T) / 2, size) if basis.shape[1] > 1 else None
        if parts is None:
            found += list(basis.T)
        else:
            open_ += [basis @ parts[1], basis @ parts[0]]
    vectors, _ = np.linalg.qr(np.array(found).T)
    vectors = refined(v, vectors)
    values = np.einsum("ij,ij->j", vectors, v @ vectors)
    order = np.argsort(-values, kind="stable")[:count]
    return values[order], vectors[:, order]


def refined(v: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The vectors turned within their span until it is diagonal to rounding (first order, repeated)."""
    for _ in range(3):
        inner = vectors.T @ v @ vectors
        values = np.diag(inner)
        gap = values[None, :] - values[:, None]
        clear = np.abs(gap) > 1e3 * EPS * max(1e-300, np.abs(values).max(initial=0)) * len(v)
        turn = np.where(clear, inner / np.where(clear, gap, 1), 0.0)
        np.fill_diagonal(turn, 0)
        if np.abs(turn).max(initial=0) > 0.01:
            break
        vectors, r = np.linalg.qr(vectors + vectors @ turn)
        vectors = vectors * np.sign(np.diag(r))
    return vectors


def whiten(vectors: DataFrame, count: int = COMPONENTS) -> DataFrame:
    """vec_id, deviation, whitened (array): the first `count` components; n, explained, identity_error are attributes of all."""
    spark = vectors.sparkSession
    kept, d = usable(vectors)
    kind = vectors.schema["vec_id"].dataType.simpleString()
    around = centre(kept, d) if d else Centre(0, [])
    if not around.n:
        return spark.createDataFrame([], _form(kind))
    v = covariance(kept, around)
    values, axes = components(v, min(count, d))
    real = values > d * EPS * max(float(values.max(initial=0)), 0.0)
    values, axes = values[real], axes[:, real]
    if not len(values):
        return spark.createDataFrame([], _form(kind))
    matrix = axes / np.sqrt(values)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = numbers(batch, d)
            projected = around.centred(x) @ matrix
            yield pa.RecordBatch.from_arrays(
                [batch["vec_id"], pa.array(around.deviations(x), pa.int64()), pa.array(list(projected), pa.list_(pa.float64()))],
                names=["vec_id", "deviation", "whitened"],
            )

    found = saved(kept.mapInArrow(each, f"vec_id {kind}, deviation long, whitened array<double>"), "whitened")
    explained = F.array(*[F.lit(float(e / np.trace(v))) for e in values])
    return found.select(
        "vec_id", F.lit(around.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"),
        F.lit(identity_error(found, len(values))).alias("identity_error"),
    )


def _form(kind: str) -> str:
    return f"vec_id {kind}, n long, deviation long, whitened array<double>, explained array<double>, identity_error double"


def identity_error(found: DataFrame, count: int) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    each = [F.col("whitened")[k] for k in range(count)]
    means = found.agg(*[F.avg(c) for c in each]).first()
    off = [c - F.lit(m) for c, m in zip(each, means)]
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    entries = found.agg(*[F.avg(off[i] * off[j]) for i, j in pairs]).first()
    return max(abs(e - (i == j)) for e, (i, j) in zip(entries, pairs))


def components_of_rows(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    each = whitened.select("vec_id", "n", "deviation", "identity_error", F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "c"))
    return each.select(
        "vec_id", (F.col("k") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error"
    )
