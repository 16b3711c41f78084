"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors are dealt to shards, and each shard is indexed for a range of queries: the components of a dimension are posted by
quantised impact (their size on a logarithmic scale down from the shard's largest), so a posting segment holds the rows
of one dimension and impact. A block of queries takes up segments by descending impact over all dimensions.
It adds them to approximate scores and stops when what is left and the rounding of impacts can't lift
any row outside a set of possible members to a query's k-th score, and scoring that set is cheaper than going on.
Possible members are scored exactly, and the shards' lists are merged by (score, vec_id). Queries
travel to the shards in packed blocks; vectors are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.util import materialize, mapped

#: Vectors of a shard and queries of a block, and blocks that a task answers with one index.
SHARD, QUERY_BLOCK, BLOCKS = 16384, 256, 64

#: Steps of quantised impact, each so much smaller than the one before, and the share of postings after which queries look for their proof.
LEVELS, FALL, LOOK = 64, 2**0.25, 0.1

#: Lengths of vectors stay below, so that no inner product leaves a long.
LONGEST = 2.0**31


class ImpactIndex:
    """One shard: integer vectors (rows of one length) and their postings by descending quantised impact.

    ``segments[l]`` lists, for impact ``LEVELS - l``, (dimension, rows with a positive component, rows with a
    negative one). A component there has a size in (bounds[l + 1], bounds[l]] and counts as the middle; zeros
    aren't posted. ``rest[l]`` is, for each row, the length of what its postings down to that level leave
    out: the unseen components and the rounding of the seen ones. By Cauchy-Schwarz a row's score lies
    within ``rest * |query|`` of its sum.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        n, dims = self.vectors.shape
        x = self.vectors.astype(float)
        size = np.abs(x)
        bounds = max(float(size.max(initial=0)), 1.0) * FALL ** -np.arange(LEVELS + 1.0)
        bounds[-1] = 0
        self.middle = (bounds[:-1] + bounds[1:]) / 2
        #: No posting counts for more than this in its dimension.
        self.top = np.maximum(size.max(axis=0, initial=0), bounds[-2]) * FALL
        level_of = (np.searchsorted(-bounds, -size.ravel(), side="right") - 1).astype(np.int16).reshape(n, dims)
        self.segments: list[list[tuple[int, np.ndarray, np.ndarray]]] = [[] for _ in range(LEVELS)]
        for d in range(dims):
            by = np.argsort(level_of[:, d], kind="stable").astype(np.int32)
            cuts = np.searchsorted(level_of[by, d], np.arange(LEVELS + 1))
            for level, (start, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if end > start:
                    rows = by[start:end]
                    up = self.vectors[rows, d] > 0
                    self.segments[level].append((d, rows[up], rows[~up]))
        sizes = [sum(len(up) + len(down) for _, up, down in level) for level in self.segments]
        #: Postings left after each level, and those touched so far by all queries.
        self.left = np.cumsum(sizes[::-1])[::-1] - sizes
        self.touched = 0
        self.rest = np.zeros((LEVELS, n), np.float32)
        squares = (x * x).sum(axis=1)
        length = np.sqrt(squares)
        for level, segments in enumerate(self.segments):
            for d, up, down in segments:
                for rows in (up, down):
                    squares[rows] += (size[rows, d] - self.middle[level]) ** 2 - size[rows, d] ** 2
            # Rounded up, as sums in single precision and the differences above may err.
            self.rest[level] = np.sqrt(np.maximum(squares, 0)) * (1 + 1e-6) + 1e-6 * length

    def search(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query ids and scores of the k best rows but ``own``, ties to the smaller id."""
        n, m = len(self.ids), len(queries)
        out: list[tuple[np.ndarray, np.ndarray]] = [(self.ids[:0], np.zeros(0, np.int64))] * m
        at = np.searchsorted(self.ids, own)
        mine = (at < n) & (self.ids[np.minimum(at, n - 1)] == own)
        norm = np.sqrt((queries.astype(float) ** 2).sum(axis=1))
        # No sum of terms in single precision errs by more than this.
        margin = (np.abs(queries).astype(float) @ self.top) * (self.vectors.shape[1] + 4) * 2.0**-22 + 1
        scores = np.zeros((n, m), np.float32)
        open_ = np.arange(m)
        looked = self.vectors.size
        for level in range(LEVELS):
            middle = np.float32(self.middle[level])
            asked = queries[open_].astype(np.float32)
            for d, up, down in self.segments[level]:
                add = asked[:, d] * middle
                if add.any():
                    scores[up] += add
                    scores[down] -= add
                    self.touched += (len(up) + len(down)) * len(open_)
            left, last = self.left[level], level == LEVELS - 1
            # Look before more than a share of all postings has gone by since the last look.
            if not last and looked - self.left[level + 1] <= LOOK * self.vectors.size:
                continue
            looked = left
            done = np.zeros(len(open_), bool)
            for i, q in enumerate(open_):
                sums = scores[:, i].astype(float)
                reach = self.rest[level] * norm[q] + margin[q]
                if mine[q]:
                    sums[at[q]] = -np.inf
                kth = np.partition(sums - reach, max(0, n - k))[max(0, n - k)]
                # Rows below can't reach k others: that is the proof.
                alive = np.flatnonzero((sums + reach >= kth) & (sums > -np.inf))
                # Go on where the postings left cost less than scoring all possible members.
                if not last and 2 * len(alive) * self.vectors.shape[1] > left:
                    continue
                exact = self.vectors[alive] @ queries[q]
                best = np.lexsort((self.ids[alive], -exact))[:k]
                out[q] = (self.ids[alive][best], exact[best])
                done[i] = True
            if done.any():
                open_, scores = open_[~done], np.ascontiguousarray(scores[:, ~done])
            if not len(open_):
                break
        return out


def _pack(ids: np.ndarray, vectors: np.ndarray) -> bytes:
    return ids.astype(np.int64).tobytes() + vectors.astype(np.int64).tobytes()


def _matrix(batch: pa.RecordBatch, column: str, dims: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy().reshape(-1, dims)


def exact_top_k(vectors: DataFrame, k: int = 10, every: int = 100, scale: float = 1024.0) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row whose vec_id is divisible by ``every``, the k best others.

    Components become floor(scale * x) with x as double. Vectors that are null or hold null or non-finite
    components take no part, nor do null ids; vectors of another length than the query's are no
    candidates. Rows of one id are the first in order. Fewer than k candidates give them all; an empty
    table gives no rows; other columns are ignored. Vectors of scaled length 2^31 or more take no part, as their inner
    products might leave a long.

    A shard and a range of query blocks are one key, so a task's work is bounded: its vectors are read first and indexed,
    then blocks are answered one after another. The k best of each shard are merged by a window over (query, shards) rows.
    """
    clean = materialize(
        vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
        .where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
        .where(F.aggregate("x", F.lit(0.0), lambda s, v: s + (F.abs(v) * scale + 1) * (F.abs(v) * scale + 1)) < LONGEST**2)
        .select("vec_id", F.transform("x", lambda v: F.floor(v * scale)).alias("x"))
        .groupBy("vec_id")
        .agg(F.min("x").alias("x"))
        .withColumn("dims", F.size("x"))
    )
    mine = F.col("vec_id") % every == 0
    sizes = clean.groupBy("dims").agg(F.count("*").alias("n"), F.count_if(mine).alias("m")).collect()  # as many rows as lengths
    by_dims = lambda f: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for r in sizes for x in (r["dims"], f(r))]), "dims"), F.lit(1)) if sizes else F.lit(1)
    shards = by_dims(lambda r: -(-r["n"] // SHARD))
    ranges = by_dims(lambda r: max(1, -(-r["m"] // (QUERY_BLOCK * BLOCKS))))
    index = clean.select(
        "dims", F.pmod(F.xxhash64("vec_id"), shards).cast("int").alias("shard"), F.explode(F.sequence(F.lit(0), (ranges - 1).cast("int"))).alias("range"),
        F.lit(0).alias("turn"), "vec_id", "x", F.lit(None).cast("binary").alias("block"),
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dims").to_numpy()
            for d in np.unique(dims).tolist():
                own = batch.filter(pa.array(dims == d))
                ids, x = own.column("vec_id").to_numpy(), _matrix(own, "x", d) if d else np.zeros((own.num_rows, 0), np.int64)
                starts = range(0, len(ids), QUERY_BLOCK)
                blocks = [_pack(ids[a : a + QUERY_BLOCK], x[a : a + QUERY_BLOCK]) for a in starts]
                yield pa.RecordBatch.from_arrays([pa.array([d] * len(blocks), pa.int32()), pa.array(blocks, pa.binary())], ["dims", "block"])

    asked = clean.where(mine).transform(mapped(pack, "dims int, block binary"))
    asked = asked.select(
        "dims", F.explode(F.sequence(F.lit(0), (shards - 1).cast("int"))).alias("shard"), F.pmod(F.xxhash64("block"), ranges).cast("int").alias("range"), F.lit(1).alias("turn"),
        F.lit(None).cast("long").alias("vec_id"), F.lit(None).cast("array<bigint>").alias("x"), "block",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        index, key = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = np.stack([batch.column(c).to_numpy() for c in ("dims", "shard", "range", "turn")])
            cuts = [0, *(np.flatnonzero((columns[:, 1:] != columns[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                dims, shard, part, turn = columns[:, start].tolist()
                piece = batch.slice(start, end - start)
                if (dims, shard, part) != key:
                    key, index, held = (dims, shard, part), None, []
                if turn == 0:
                    held.append((piece.column("vec_id").to_numpy(), _matrix(piece, "x", dims) if dims else np.zeros((piece.num_rows, 0), np.int64)))
                    continue
                if index is None and not held:
                    continue  # a shard that no vector fell into
                if index is None:
                    index, held = ImpactIndex(*(np.concatenate(c) for c in zip(*held, strict=True))), []
                for block in piece.column("block").to_pylist():
                    data = np.frombuffer(block, np.int64)
                    m = len(data) // (dims + 1)
                    found = index.search(data[m:].reshape(m, dims), data[:m], k)
                    sizes = [len(ids) for ids, _ in found]
                    arrays = [np.repeat(data[:m], sizes), *(np.concatenate([f[i] for f in found]) for i in range(2))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in arrays], ["query_id", "vec_id", "score"])

    found = index.unionByName(asked).repartition("dims", "shard", "range").sortWithinPartitions("dims", "shard", "range", "turn").transform(
        mapped(run, "query_id long, vec_id long, score long")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
