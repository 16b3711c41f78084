"""A hashed maximum-entropy language model with a class-factored softmax.

P(word | history) = P(class | history) * P(word | class). The class factor is a softmax over hashed n-gram
and skip features of the preceding words; the word factor is the softmax of word biases within the
class, whose maximum-likelihood solution is the share of counts. Frequent words are classed by the
company they keep (k-means over counts beside the commonest words) and by frequency, the rest of
the head by frequency, all other words are one class.

Counts come from all training texts by a shuffle. Weights are trained by distributed gradient updates: in each
round every shard of the training texts takes AdaGrad steps from the common weights, and the shards'
weights are averaged. The rows of hashed features and with them the size of a shard grow with the
root of the number of tokens, whatever the cluster. Texts are scored in numpy batches; words outside the
head get their counts by a join.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import hashing
from shelfspark.llm.util import chunks, held_out, mapped, materialize

#: Words with counts in every scorer; of these, words with a class by company; words beside which company is counted.
HEAD, CLASSED, ANCHORS = 1 << 17, 1 << 14, 64
#: Batch of a gradient step, in tokens; tokens of a shard for each row of features; rounds of averaging.
BATCH, PER_ROW, ROUNDS = 8192, 128, 2
_CLUSTERS, _BINS, _LEVELS = 10, 4, 4
#: Classes by company and frequency, by frequency alone, of the tail, of the end.
TAIL = _CLUSTERS * _BINS + _LEVELS
END_CLASS = TAIL + 1
CLASSES = END_CLASS + 1

#: Bits of a hash by which the head is looked up.
_PREFIX = 19

_END = np.uint64(0x5851F42D4C957F2D)
_START = np.uint64(0x14057B7EF767814F)
_FOLDS, _FOLD = 5, 1


def token_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts, an end after each, and the n + 1 offsets of the texts."""
    raw, offsets = hashing.text_bytes(texts)
    starts, ends, words = hashing.words(raw, offsets)
    n = len(words) - 1
    out = np.full(len(starts) + n, _END)
    places = np.arange(len(starts)) + np.repeat(np.arange(n), np.diff(words))
    out[places] = hashing.word_hashes(raw, starts, ends)
    return out, words + np.arange(n + 1)


def _history(tokens: np.ndarray, offsets: np.ndarray, back: int) -> np.ndarray:
    """The token ``back`` places before each one, a start mark before the text's first."""
    out = np.full(len(tokens), _START)
    out[back:] = tokens[: len(tokens) - back]
    first = np.repeat(offsets[:-1], np.diff(offsets))
    out[np.arange(len(tokens)) - first < back] = _START
    return out


def feature_rows(tokens: int) -> int:
    """Rows of hashed features for so many training tokens: four times their root, as a power of two."""
    return 1 << max(10, (4 * math.isqrt(max(1, tokens)) - 1).bit_length())


def features(tokens: np.ndarray, offsets: np.ndarray, rows: int) -> np.ndarray:
    """Hashed features of each token's history (tokens x 4): word before, its skip, bigram, skip bigram."""
    a, b, c = (_history(tokens, offsets, k) for k in (1, 2, 3))
    mask = np.uint64(rows - 1)
    salted = (a, b ^ np.uint64(2), a * np.uint64(3) + hashing.mix(b), b * np.uint64(5) + hashing.mix(c))
    return np.stack([(hashing.mix(x) >> np.uint64(7) & mask).astype(np.int64) for x in salted], axis=1)


@dataclass
class Head:
    """The most frequent words, sorted by hash, with log10 probabilities that don't depend on history."""

    hashes: np.ndarray
    counts: np.ndarray
    rank: np.ndarray
    #: First place of a hash with the same upper ``_PREFIX`` bits or more; how many places have the same, at most.
    first: np.ndarray
    most: int

    @staticmethod
    def of(hashes: np.ndarray, counts: np.ndarray) -> Head:
        """From words by falling count."""
        order = np.argsort(hashes)
        held = np.bincount((hashes >> np.uint64(64 - _PREFIX)).astype(np.int64), minlength=1 << _PREFIX)
        return Head(hashes[order], counts[order], order, (np.cumsum(held) - held).astype(np.int32), int(held.max()))

    def find(self, tokens: np.ndarray) -> np.ndarray:
        """Places of tokens, -1 outside the head."""
        if not len(self.hashes):
            return np.full(len(tokens), -1)
        last = len(self.hashes) - 1
        # Hashes are spread evenly: a token's prefix leads to its place or a few before it.
        at = np.minimum(np.take(self.first, (tokens >> np.uint64(64 - _PREFIX)).astype(np.int64)), last).astype(np.int64)
        there = np.take(self.hashes, at)
        behind = np.flatnonzero(there < tokens)
        for _ in range(self.most):
            behind = behind[at[behind] < last]
            if not len(behind):
                break
            at[behind] += 1
            behind = behind[np.take(self.hashes, at[behind]) < tokens[behind]]
        return np.where(np.take(self.hashes, at) == tokens, at, -1)


def _summed(df: DataFrame, make: Callable[[Iterator[pa.RecordBatch]], np.ndarray], kind: type, blocks: int = 64) -> np.ndarray:
    """The sum over partitions of equally long arrays, added up block by block in a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = np.array_split(make(batches), blocks)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(blocks), pa.int32()), pa.array([p.astype(kind).tobytes() for p in parts], pa.binary())], ["block", "data"]
        )

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(d, kind) for d in pdf["data"])
        return pd.DataFrame({"block": [pdf["block"].iat[0]], "data": [total.astype(kind).tobytes()]})

    rows = df.transform(mapped(run, "block int, data binary")).groupBy("block").applyInPandas(add, "block int, data binary").collect()
    return np.concatenate([np.frombuffer(r["data"], kind) for r in sorted(rows)])


def count_words(training: DataFrame) -> DataFrame:
    """``word long, c long``: hash and count of every token of ``training`` (text); written once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merge() -> tuple[np.ndarray, np.ndarray]:
            w = np.concatenate([words, *(h[0] for h in held)])
            c = np.concatenate([counts, *(h[1] for h in held)])
            values, inverse = np.unique(w, return_inverse=True)
            return values, np.bincount(inverse, weights=c, minlength=len(values)).astype(np.int64)

        give = lambda: pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(counts)], ["word", "c"])
        for batch in chunks(batches, 0):
            held.append(np.unique(token_stream(batch.column(0))[0], return_counts=True))
            if sum(len(h[0]) for h in held) > 500_000:
                (words, counts), held = merge(), []
                if len(words) > 1_000_000:
                    yield give()
                    words, counts = words[:0], counts[:0]
        words, counts = merge()
        yield give()

    return materialize(training.transform(mapped(run, "word long, c long")).groupBy("word").agg(F.sum("c").alias("c")))


def _classes(head: Head, company: np.ndarray, rounds: int = 25) -> np.ndarray:
    """The class of each place of the head."""
    out = np.zeros(len(head.hashes), np.int64)
    by_rank = np.empty(len(out), np.int64)
    by_rank[head.rank] = np.arange(len(out))  # place of each rank
    n = min(CLASSED, len(out))
    x = np.log1p(company[:n].astype(float))
    x -= x.mean(axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True) + 1e-9
    centres = x[np.linspace(0, max(0, min(n, 400) - 1), _CLUSTERS).astype(int)] if n else x
    group = np.zeros(n, np.int64)
    for _ in range(rounds if n else 0):
        group = (x @ centres.T).argmax(axis=1)
        for k in range(_CLUSTERS):
            if (group == k).any():
                centres[k] = x[group == k].mean(axis=0)
                centres[k] /= np.linalg.norm(centres[k]) + 1e-9
    mass = np.cumsum(head.counts[by_rank[:n]].astype(float))
    bins = np.minimum((mass / max(1.0, mass[-1] if n else 1.0) * _BINS).astype(int), _BINS - 1) if n else group
    out[by_rank[:n]] = group * _BINS + bins
    rest = len(out) - n
    out[by_rank[n:]] = _CLUSTERS * _BINS + np.minimum(np.arange(rest) * _LEVELS // max(1, rest), _LEVELS - 1)
    out[head.hashes == _END] = END_CLASS
    return out


def class_of(head: Head, classes: np.ndarray, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = head.find(tokens)
    return at, np.where(at >= 0, classes[at] if len(classes) else 0, np.where(tokens == _END, END_CLASS, TAIL))


def _raised(w: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Sums of weights by class, less the largest of each row."""
    z = np.take(w, f[:, 0], axis=0)
    z += bias
    for k in range(1, f.shape[1]):
        z += np.take(w, f[:, k], axis=0)
    z -= z.max(axis=1, keepdims=True)
    return z


def softmax(w: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    z = _raised(w, bias, f)
    np.exp(z, out=z)
    z /= z.sum(axis=1, keepdims=True)
    return z


def log_softmax(w: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    z = _raised(w, bias, f)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


#: Runs up to this long are added up side by side, longer ones each by itself.
_SHORT = 24


def _sums(p: np.ndarray, of: np.ndarray, starts: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Sums of the rows ``of`` of ``p`` by runs, given their starts and lengths."""
    out = np.take(p, of[starts], axis=0)
    left = np.flatnonzero((times > 1) & (times <= _SHORT))
    for i in range(1, _SHORT):
        if not len(left):
            break
        out[left] += np.take(p, of[starts[left] + i], axis=0)
        left = left[times[left] > i + 1]
    for r in np.flatnonzero(times > _SHORT).tolist():
        out[r] = np.take(p, of[starts[r] : starts[r] + times[r]], axis=0).sum(axis=0, dtype=np.float64)
    return out


class Trainer:
    """AdaGrad over batches of (features, class), from weights ``w``."""

    def __init__(self, w: np.ndarray, bias: np.ndarray, rate: float = 0.15):
        self.w, self.bias, self.rate = w.copy(), bias.astype(np.float32), rate
        self.g2 = np.full(len(w), 1e-4, np.float32)

    def step(self, f: np.ndarray, y: np.ndarray) -> None:
        n, k = f.shape
        p = softmax(self.w, self.bias, f)
        p[np.arange(n), y] -= 1
        flat = f.ravel()
        order = np.argsort(flat.astype(np.uint16) if len(self.w) <= 1 << 16 else flat, kind="stable")  # short keys are sorted by radix
        fresh = np.ones(n * k, bool)
        fresh[1:] = flat[order[1:]] != flat[order[:-1]]
        rows = flat[order[fresh]]
        # Sums by row of features, over the root of how often the row occurs.
        starts = np.flatnonzero(fresh)
        times = np.diff(np.append(starts, n * k))
        grad = _sums(p, order // k, starts, times)
        grad /= np.sqrt(times.astype(np.float32))[:, None]
        self.g2[rows] += (grad * grad).mean(axis=1)
        self.w[rows] -= grad * (self.rate / np.sqrt(self.g2[rows]))[:, None]


def train(training: DataFrame, head: Head, classes: np.ndarray, bias: np.ndarray, rows: int, shards: int, blocks: int = 64) -> np.ndarray:
    """Weights after ``ROUNDS`` rounds over all of ``training`` (doc_id, text).

    Texts are dealt to shards and rounds, and ordered within, by hashes of their rows.
    """
    spark = training.sparkSession
    place = lambda salt: F.xxhash64("doc_id", "text", F.lit(salt))
    dealt = training.select(F.pmod(place(1), F.lit(shards)).cast("int").alias("shard"), place(2).alias("place"), "text")
    w = np.zeros((rows, CLASSES), np.float32)
    for r in range(ROUNDS):
        common = spark.sparkContext.broadcast((head, classes, bias, w))

        def run(batches: Iterator[pa.RecordBatch], common=common) -> Iterator[pa.RecordBatch]:
            head, classes, bias, w = common.value
            trainer, shard, seen = None, None, 0

            def trained() -> pa.RecordBatch:
                parts = [p.tobytes() for p in np.array_split(trainer.w.ravel(), blocks)]
                return pa.RecordBatch.from_arrays(
                    [pa.array(range(blocks), pa.int32()), pa.array([seen] * blocks, pa.int64()), pa.array(parts, pa.binary())], ["block", "seen", "data"]
                )

            for batch in batches:
                own = batch.column(0).to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)] if len(own) else [0]
                for start, end in zip(cuts[:-1], cuts[1:], strict=True):
                    if own[start] != shard:
                        if trainer is not None:
                            yield trained()
                        trainer, shard, seen = Trainer(w, bias), own[start], 0
                    for piece in chunks(iter([batch.slice(start, end - start)]), 1):
                        tokens, offsets = token_stream(piece.column(1))
                        f, (_, y) = features(tokens, offsets, rows), class_of(head, classes, tokens)
                        for at in range(0, len(y), BATCH):
                            trainer.step(f[at : at + BATCH], y[at : at + BATCH])
                        seen += len(y)
            if trainer is not None:
                yield trained()

        def average(pdf: pd.DataFrame) -> pd.DataFrame:
            total = sum(n * np.frombuffer(d, np.float32).astype(float) for n, d in zip(pdf["seen"], pdf["data"], strict=True)) / pdf["seen"].sum()
            return pd.DataFrame({"block": [pdf["block"].iat[0]], "data": [total.astype(np.float32).tobytes()]})

        own = dealt.where(F.pmod("place", F.lit(ROUNDS)) == r).repartition(shards, "shard").sortWithinPartitions("shard", "place")
        found = own.select("shard", "text").transform(mapped(run, "block int, seen long, data binary")).groupBy("block").applyInPandas(average, "block int, data binary")
        got = sorted(tuple(x) for x in found.collect())
        if got:
            w = np.concatenate([np.frombuffer(d, np.float32) for _, d in got]).reshape(rows, CLASSES)
        common.unpersist()
    return w


def word_logs(head: Head, classes: np.ndarray, in_class: np.ndarray) -> np.ndarray:
    """log10 of each head word's share of its class."""
    return np.log10(head.counts / np.maximum(in_class[classes], 1)) if len(classes) else np.zeros(0)


def score_texts(docs: DataFrame, trainers: int | None = None) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for each row.

    Trained on rows outside the held-out fold. A null text counts as empty: its one token is the end.
    ``trainers`` is the number of shards, by default as many as the number of tokens asks for.
    Null ids fall into a fold as the empty string does; repeated rows count and are scored each; an empty
    table gives no rows; other columns are ignored. Unknown words share one place in the tail class.
    """
    spark = docs.sparkSession
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    learnt = source.where(~held_out(F.col("doc_id"), _FOLDS, _FOLD))
    training = learnt.select("text")
    counts = count_words(training)
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = int(total["n"]), int(total["v"])
    top = counts.orderBy(F.desc("c"), "word").limit(HEAD).toPandas()
    ranked, ranked_counts = top["word"].to_numpy(np.int64).view(np.uint64), top["c"].to_numpy(np.int64)
    head = Head.of(ranked, ranked_counts)
    beside = min(ANCHORS, len(ranked))
    classed = min(CLASSED, len(ranked))

    def company(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros(classed * ANCHORS, np.int64)
        held, n = [np.zeros(0, np.int64)], 0
        for batch in chunks(batches, 0):
            tokens, offsets = token_stream(batch.column(0))
            at = head.find(tokens)
            rank = np.where(at >= 0, head.rank[at], HEAD) if len(head.rank) else at
            owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            for k in (1, 2):
                together = owner[k:] == owner[:-k]
                for x, y in ((rank[k:], rank[:-k]), (rank[:-k], rank[k:])):
                    ok = np.flatnonzero(together & (x < classed) & (y < beside))
                    held.append(x[ok] * ANCHORS + y[ok])
                    n += len(ok)
            if n > len(out):
                # As many pairs as counts: adding them up costs no more than finding them.
                out += np.bincount(np.concatenate(held), minlength=len(out))
                held, n = [np.zeros(0, np.int64)], 0
        return out + np.bincount(np.concatenate(held), minlength=len(out))

    met = _summed(training, company, np.int64) if classed else np.zeros(0, np.int64)
    classes = _classes(head, met.reshape(-1, ANCHORS))
    in_class = np.bincount(classes, weights=head.counts, minlength=CLASSES)
    tail_n, tail_v = n - int(head.counts.sum()), v - len(head.counts)
    in_class[TAIL] = tail_n
    # The tail's softmax keeps a place for unknown words.
    bias = np.log((in_class + 0.5) / (in_class.sum() + 0.5 * CLASSES))
    rows = feature_rows(n)
    weights = train(learnt, head, classes, bias, rows, trainers or -(-max(1, n) // (PER_ROW * rows)))
    word_log = word_logs(head, classes, in_class)
    base_log = np.log10((head.counts + 0.5) / (n + 0.5 * (v + 1)))
    none_log = float(np.log10(0.5 / (n + 0.5 * (v + 1))))
    shared = spark.sparkContext.broadcast((head, classes, bias.astype(np.float32), weights, word_log, base_log))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, classes, bias, weights, word_log, base_log = shared.value
        for batch in chunks(batches, 2):
            tokens, offsets = token_stream(batch.column(2))
            f, (at, y) = features(tokens, offsets, rows), class_of(head, classes, tokens)
            logs = np.zeros(len(tokens))
            for i in range(0, len(y), BATCH):
                part = log_softmax(weights, bias, f[i : i + BATCH])
                logs[i : i + BATCH] = part[np.arange(len(part)), y[i : i + BATCH]]
            logs /= np.log(10)
            known = at >= 0
            base = np.zeros(len(tokens))
            logs[known] += word_log[at[known]]
            base[known] = base_log[at[known]]
            # An end that training never saw is unknown, whatever the words say.
            lost = ~known & (tokens == _END)
            base[lost] = none_log
            per = lambda x: np.add.reduceat(x, offsets[:-1]) if len(offsets) > 1 else np.zeros(0)
            ids = batch.column(0).to_numpy()
            doc_rows = [pa.array(ids), batch.column(1), pa.nulls(len(ids), pa.int64()), pa.array(np.diff(offsets)),
                        pa.array(per(known.astype(np.int64))), pa.array(per(base)), pa.array(per(logs))]
            names = ["row", "doc_id", "word", "n", "known", "base", "logs"]
            yield pa.RecordBatch.from_arrays(doc_rows, names)
            away = np.flatnonzero(~known & (tokens != _END))
            owner = np.searchsorted(offsets, away, side="right") - 1
            order = np.lexsort((tokens[away], owner))
            owner, word = owner[order], tokens[away][order]
            if len(word):
                begin = np.concatenate([[0], np.flatnonzero((np.diff(owner) != 0) | (word[1:] != word[:-1])) + 1])
                times = np.diff(np.append(begin, len(word)))
                k = len(begin)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[owner[begin]]), pa.nulls(k, pa.int64()), pa.array(word[begin].view(np.int64)), pa.array(times),
                     pa.nulls(k, pa.int64()), pa.nulls(k, pa.float64()), pa.nulls(k, pa.float64())], names
                )

    ddl = "row long, doc_id long, word long, n long, known long, base double, logs double"
    scored = materialize(source.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").transform(mapped(score, ddl)))
    c = F.coalesce("c", F.lit(0))
    tail = (
        scored.where("word IS NOT NULL").select("row", "word", "n").join(counts, "word", "left")
        .select(
            "row", F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("n"),
            F.when(c > 0, F.col("n")).otherwise(0).alias("known"),
            (F.col("n") * F.log10((c + 0.5) / (n + 0.5 * (v + 1)))).alias("base"),
            (F.col("n") * F.log10((c + 0.5) / (tail_n + 0.5 * (tail_v + 1)))).alias("logs"),
        )
    )
    parts = scored.where("word IS NULL").drop("word").unionByName(tail)
    return (
        parts.groupBy("row")
        .agg(F.max("doc_id").alias("doc_id"), *(F.sum(x).alias(x) for x in ("n", "known", "base", "logs")))
        .select(
            "doc_id", held_out(F.col("doc_id"), _FOLDS, _FOLD).alias("held_out"), F.col("n").alias("n_tokens"), F.col("known").alias("n_known"),
            F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), F.col("logs").alias("score"),
        )
    )
