"""Whitening of embeddings by hierarchical merging of singular value decompositions.

Each partition reduces its vectors to a count, exact sums and all singular values and right vectors of
its centred rows. Summaries are merged in a tree, a few at a time: their scaled vectors are stacked below one another
with a row that corrects for the difference of the means, and decomposed again. All dimensions are kept, so no
merge loses anything. Sums are whole numbers of any size and rows are centred before they are multiplied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.util import mapped, materialize

#: Summaries that one task merges.
FAN = 16
#: Added to every scaled component, and the size beyond which scaled components are cut (doubles are whole numbers up to there).
SHIFT, LARGEST = 1_000_000, float(1 << 52)


@dataclass
class Summary:
    """``n`` rows with exact sums (whole numbers), and singular values and right vectors (rows) of the centred rows."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> Summary:
        """Of an integer matrix, a row a vector."""
        n, dims = x.shape
        # Partial sums can't overflow: rows are whole numbers below 2^53.
        sums = [sum(int(part.sum()) for part in np.array_split(column, -(-n // 512))) for column in x.T]
        middle = [s // n for s in sums]
        # Whole numbers are subtracted as such; what is left of the mean is below one.
        rest = np.array([(s - m * n) / n for s, m in zip(sums, middle, strict=True)])
        centred = (x - np.array(middle, np.int64)).astype(float) - rest
        return Summary(n, sums, *_decompose(centred, dims))

    def merged(self, other: Summary) -> Summary:
        n, m = self.n, other.n
        apart = np.array([float(a * m - b * n) / n / m for a, b in zip(self.sums, other.sums, strict=True)])
        correction = apart * np.sqrt(n / (n + m) * m)
        stacked = np.vstack([self.values[:, None] * self.vectors, other.values[:, None] * other.vectors, correction])
        return Summary(n + m, [a + b for a, b in zip(self.sums, other.sums, strict=True)], *_decompose(stacked, len(self.sums)))

    def pack(self) -> dict:
        return {"n": self.n, "sums": ",".join(map(str, self.sums)), "factors": np.vstack([self.values, self.vectors]).tobytes()}

    @staticmethod
    def unpack(n: int, sums: str, factors: bytes) -> Summary:
        whole = [int(s) for s in sums.split(",")]
        table = np.frombuffer(factors).reshape(-1, len(whole))
        return Summary(n, whole, table[0], table[1:])


def _decompose(rows: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """All ``dims`` singular values, zeros too, and right vectors of the rows."""
    if len(rows) < dims:
        rows = np.vstack([rows, np.zeros((dims - len(rows), dims))])
    _, values, vectors = np.linalg.svd(np.linalg.qr(rows, mode="r"))
    return values, vectors


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Dimensions, matrix and row numbers of the vectors of each length in a batch of (dims, x, ...)."""
    for batch in batches:
        dims = batch.column(0).to_numpy()
        for d in np.unique(dims).tolist():
            own = np.flatnonzero(dims == d)
            piece = batch.column(1).take(pa.array(own))
            yield d, piece.flatten().to_numpy().reshape(-1, d), own


_SUMMARY = "dims int, n long, sums string, factors binary"


def _summaries(found: dict[int, Summary]) -> pa.RecordBatch:
    rows = [{"dims": d} | s.pack() for d, s in found.items()]
    kinds = [("dims", pa.int32()), ("n", pa.int64()), ("sums", pa.string()), ("factors", pa.binary())]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds], [k for k, _ in kinds])


def summarise(vectors: DataFrame) -> DataFrame:
    """One summary a partition and length of ``vectors`` (dims, x array<long>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Summary] = {}
        for d, x, _ in _matrices(batches):
            own = Summary.of(x)
            found[d] = found[d].merged(own) if d in found else own
        yield _summaries(found)

    return vectors.select("dims", "x").transform(mapped(run, _SUMMARY))


def _tree(level: DataFrame, join: Callable[[Iterator], Iterator], fan: int = FAN) -> list:
    """Rows of ``level`` after merging ``fan`` of a length at a time, level by level, until each length has one.

    What reaches the driver is a row for each length of vector, as large as the square of the length whatever the rows.
    """
    schema = level.schema
    level = materialize(level)
    while (most := max((r["count"] for r in level.groupBy("dims").count().collect()), default=0)) > 1:
        parts = -(-most // fan)
        # Numbered by content, so that a task that runs again deals them out alike.
        numbered = level.withColumn("part", F.pmod(F.xxhash64(*schema.names), F.lit(parts)).cast("int"))
        level = materialize(numbered.repartition(parts, "dims", "part").transform(mapped(join, schema)))
    return level.collect()


def merge_all(summaries: DataFrame) -> dict[int, Summary]:
    """The one summary of each length of vector."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], Summary] = {}
        for batch in batches:
            for r in batch.to_pylist():
                key, own = (r["dims"], r["part"]), Summary.unpack(r["n"], r["sums"], r["factors"])
                found[key] = found[key].merged(own) if key in found else own
        for (d, _), s in found.items():
            yield _summaries({d: s})

    return {r["dims"]: Summary.unpack(r["n"], r["sums"], r["factors"]) for r in _tree(summaries, join)}


@dataclass
class Whitener:
    """Whitening of vectors of one length: ``basis`` has a component a row, ``roots`` the roots of their eigenvalues."""

    n: int
    sums: list[int]
    basis: np.ndarray
    roots: np.ndarray
    explained: np.ndarray

    @staticmethod
    def of(s: Summary, most: int) -> Whitener:
        """The first ``most`` components, but none whose eigenvalue is zero in double precision."""
        eigen = s.values**2 / s.n
        alive = s.values > s.values.max(initial=0) * max(s.n, len(s.sums)) * np.finfo(float).eps
        basis = s.vectors[:most][alive[:most]]
        eigen, total = eigen[:most][alive[:most]], eigen.sum()
        turn = np.sign(basis[np.arange(len(basis)), np.abs(basis).argmax(axis=1)]) if len(basis) else np.zeros(0)
        return Whitener(s.n, s.sums, basis * turn[:, None], np.sqrt(eigen), eigen / total if len(eigen) else eigen)

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """x less the whole part of the mean, and what is left of the sums: n * x - sum = n * first - second, without large numbers."""
        middle = [s // self.n for s in self.sums]
        return x - np.array(middle, np.int64), [s - m * self.n for s, m in zip(self.sums, middle, strict=True)]

    def whiten(self, x: np.ndarray) -> np.ndarray:
        whole, rest = self.centred(x)
        return (whole.astype(float) - np.array(rest) / self.n) @ self.basis.T / self.roots

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - sum)^2, exact; none where it takes more than a long."""
        whole, rest = self.centred(x)
        reach = self.n * (int(np.abs(whole).max(initial=0)) + 1)
        if reach * reach * x.shape[1] < 1 << 63:
            return ((whole * self.n - np.array(rest)) ** 2).sum(axis=1).tolist()
        about = ((whole.astype(float) * self.n - np.array(rest, float)) ** 2).sum(axis=1)
        exact = (sum((self.n * v - r) ** 2 for v, r in zip(row, rest, strict=True)) if a < 2.0**64 else 1 << 63 for row, a in zip(whole.tolist(), about, strict=True))
        return [v if v < 1 << 63 else None for v in exact]


def _moments(z: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    mean = z.mean(axis=0)
    return len(z), mean, (z - mean).T @ (z - mean)


def _joined(a: tuple[int, np.ndarray, np.ndarray], b: tuple[int, np.ndarray, np.ndarray]) -> tuple[int, np.ndarray, np.ndarray]:
    n = a[0] + b[0]
    apart = a[1] - b[1]
    return n, a[1] - apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] / n * b[0])


def _packed(d: int, n: int, mean: np.ndarray, square: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array([d], pa.int32()), pa.array([n], pa.int64()), pa.array([np.vstack([mean, square]).tobytes()], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["dims", "n", "moments"])


def identity_error(fit: DataFrame, whiteners: dict[int, Whitener]) -> float:
    """Largest absolute entry, over all lengths, of the covariance of the whitened ``fit`` (dims, x) minus the identity.

    The covariance is taken from the whitened rows themselves: centred in each partition and merged in the same tree.
    """

    def unpack(r: dict) -> tuple[int, np.ndarray, np.ndarray]:
        table = np.frombuffer(r["moments"]).reshape(-1, len(whiteners[r["dims"]].roots))
        return r["n"], table[0], table[1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for d, x, _ in _matrices(batches):
            if len(whiteners[d].roots):
                own = _moments(whiteners[d].whiten(x))
                found[d] = _joined(found[d], own) if d in found else own
        for d, own in found.items():
            yield _packed(d, *own)

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], tuple[int, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for r in batch.to_pylist():
                key, own = (r["dims"], r["part"]), unpack(r)
                found[key] = _joined(found[key], own) if key in found else own
        for (d, _), own in found.items():
            yield _packed(d, *own)

    error = 0.0
    for r in _tree(fit.transform(mapped(run, "dims int, n long, moments binary")), join):
        n, _, square = unpack(r.asDict())
        error = max(error, float(np.abs(square / n - np.eye(len(square))).max(initial=0)))
    return error


def whiten(embeddings: DataFrame, components: int = 16, scale: float = 64.0) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each row and component.

    Entries become x = floor(scale * c) + 1,000,000; vectors that are null or hold null or non-finite entries take no
    part. The fit list holds each distinct x once. Vectors of each length have a fit of their own, and
    components whose eigenvalue is zero in double precision, as after a fit of one vector, give no rows; each component's largest
    entry is positive. Scaled entries beyond 2^52 in size count as that. ``deviation`` is null where it takes more than a long.
    Repeated and null ids keep their rows; an empty table gives none; other columns are ignored.
    """
    scaled = F.transform("embedding", lambda c: F.floor(F.least(F.greatest(c.cast("double") * scale, F.lit(-LARGEST)), F.lit(LARGEST))) + SHIFT)
    finite = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = embeddings.where(F.col("embedding").isNotNull() & finite & (F.size("embedding") > 0)).select(
        F.size("embedding").alias("dims"), scaled.alias("x"), F.col("vec_id").cast("long").alias("vec_id")
    )
    fit = materialize(rows.select("dims", "x").distinct())
    whiteners = {d: Whitener.of(s, components) for d, s in merge_all(summarise(fit)).items()}
    error = identity_error(fit, whiteners)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, x, own in _matrices([batch]):
                w = whiteners[d]
                m, k = len(own), len(w.roots)
                columns = [
                    batch.column(2).take(pa.array(np.repeat(own, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, w.n), pa.int64()), pa.array(w.deviation(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                    pa.array(w.whiten(x).ravel()), pa.array(np.tile(w.explained, m)), pa.array(np.full(m * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.transform(mapped(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"))
