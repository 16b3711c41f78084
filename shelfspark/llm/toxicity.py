"""Toxicity by weak supervision.

1. A lexicon of words and word beginnings is read off labelled documents.
2. Voters say "toxic" or abstain: fixed insults, eight shares of the learned lexicon, several hits at once,
   masked words, exclamations, address of a reader, threats, shouting; one votes for the absence of all of these.
3. A generative label model sees only how often each combination of votes occurs, with and without a
   label, over all training documents. Within a class a vote depends on one other voter (a tree, the one that
   explains most), so the model holds accuracies and correlations and is a distribution still. Expectation
   maximisation estimates it together with the annotator's accuracy.
4. A linear classifier over lexicon terms is trained on the posterior labels of labelled and unlabelled documents
   and scores every text.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm.util import chunks, held_out, materialize, mapped, small

#: Bounds of the labelled and the unlabelled sample and of the lexicon that reach the driver.
MAX_LABELLED = 20_000
MAX_UNLABELLED = 20_000
MAX_TERMS = 4_000

#: Common English insults.
INSULTS = frozenset(
    "idiot idiots stupid moron morons scum trash loser losers clown pathetic worthless disgusting dumb imbecile filth vermin".split()
)

_SHARES = 8
#: Voters in order of their bits.
VOTERS = ("insults", *(f"lexicon{i}" for i in range(_SHARES)), "several", "masked", "exclaimed", "addressed", "threat", "shouted", "none")
_FOLDS, _FOLD = 4, 2
_WORD = re.compile(r"[^\W\d_]+")
_MASKED = re.compile(r"\b[^\W\d_][*#@$]{2,}")
_SHOUTED = re.compile(r"\b[A-Z]{3,}\W+[A-Z]{3,}\W+[A-Z]{3,}\b")
_THREAT = re.compile(r"\b(?:kill|hurt|destroy|burn|hang) (?:you|yourself|them|him|her)\b")
_ADDRESS = re.compile(r"\b(?:you are|you're|du bist|tu es|vous êtes|eres|shut up)\b")


def terms(word: str) -> list[str]:
    """A word and its beginnings of four to six letters (marked by ``~``)."""
    return [word] + [word[:n] + "~" for n in (4, 5, 6) if len(word) >= n]


def lexicon(docs: DataFrame, labels: DataFrame, limit: int = MAX_TERMS, least: int = 4) -> list[tuple[str, float, bool]]:
    """Terms by log odds of toxic against other documents, those of ``least`` toxic texts at least.

    Each with its odds and whether it is strong: rare in clean texts, in one of 100 toxic ones or more.

    ``labels`` (doc_id, toxic) is bounded; texts that repeat count once, with the largest of their labels.
    """
    own = docs.join(F.broadcast(labels), "doc_id").groupBy("text").agg(F.max("toxic").alias("toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 0):
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                counts[toxic].update({t for w in set(_WORD.findall((text or "").lower())) for t in terms(w)})
            names = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), *(pa.array([c[n] for n in names], pa.int64()) for c in counts)],
                ["term", "clean", "toxic"],
            )

    counted = own.transform(mapped(run, "term string, clean long, toxic long")).groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    )
    n = {r["toxic"]: r["n"] for r in labels.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    odds = F.log((F.col("toxic") + 0.5) / (n.get(1, 0) + 1)) - F.log((F.col("clean") + 0.5) / (n.get(0, 0) + 1))
    best = (
        counted.where(F.col("toxic") >= least).withColumn("odds", odds).where("odds > 1.5")
        .orderBy(F.desc(F.col("odds") * F.log1p("toxic")), "term").limit(limit)
    )
    share = max(least, 0.01 * n.get(1, 0))
    return [(r["term"], r["odds"], r["odds"] >= 3.5 and r["toxic"] >= share) for r in best.collect()]


class Reader:
    """Terms and votes of texts."""

    def __init__(self, names: list[str], strong: list[bool]):
        self.ids = {t: i for i, t in enumerate(names)}
        self.strong = {i: zlib.crc32(t.encode()) % _SHARES for i, (t, s) in enumerate(zip(names, strong, strict=True)) if s}
        self.known: dict[str, tuple[int, ...]] = {}

    def read(self, text: str | None) -> tuple[list[int], int]:
        """Sorted term ids, and the votes as bits."""
        lower = (text or "").lower()
        words = set(_WORD.findall(lower))
        known, ids = self.known, self.ids
        found: set[int] = set()
        hits = 0
        for w in words:
            own = known.get(w)
            if own is None:
                if len(known) > 100_000:
                    known.clear()
                own = known[w] = tuple(ids[t] for t in terms(w) if t in ids)
            if own:
                found.update(own)
                hits += any(i in self.strong for i in own)
        said = [bool(words & INSULTS)] + [False] * _SHARES
        for i in found:
            if i in self.strong:
                said[1 + self.strong[i]] = True
        said += [hits >= 2, bool(_MASKED.search(lower)), "!!!" in lower, bool(_ADDRESS.search(lower)), bool(_THREAT.search(lower)), bool(_SHOUTED.search(text or ""))]
        votes = sum(1 << i for i, v in enumerate(said) if v) or 1 << len(said)
        return sorted(found), votes


@dataclass
class LabelModel:
    """P(toxic), the annotator's P(label 1) for each class, and P(vote | vote of its parent, class) along a tree of voters."""

    prior: float
    annotator: np.ndarray
    parent: np.ndarray
    table: np.ndarray  # class, voter, vote of the parent (0 for the root) -> P(vote)

    @staticmethod
    def fit(bits: np.ndarray, counts: np.ndarray, rounds: int = 60) -> LabelModel:
        """``bits``: combinations x voters; ``counts``: combinations x 3 (no label, label 0, label 1)."""
        n, k = bits.shape
        model = LabelModel(0.1, np.array([0.05, 0.95]), np.full(k, -1), np.zeros((2, k, 2)))
        seen = counts[:, 1:]
        total = seen.sum(axis=0)
        model.prior = float((total[1] + 1) / (total.sum() + 10))
        # Labelled documents first; then all of them by their posteriors.
        model._estimate(bits, seen.T)
        for _ in range(rounds):
            p = model.posterior(bits)
            weight = np.stack([(counts * (1 - p)).sum(axis=1), (counts * p).sum(axis=1)])
            mass = weight.sum(axis=1)
            model.prior = float((mass[1] + 1) / (mass.sum() + 10))
            labelled = np.stack([(seen * (1 - p[:, 1:])).sum(axis=0), (seen * p[:, 1:]).sum(axis=0)])
            model.annotator = np.clip((labelled[:, 1] + np.array([0.1, 1.9])) / (labelled.sum(axis=1) + 2), 1e-3, 1 - 1e-3)
            model._estimate(bits, weight)
        return model

    def _estimate(self, bits: np.ndarray, weight: np.ndarray) -> None:
        """The tree of voters with the most mutual information given the class, and its tables."""
        k = bits.shape[1]
        mass = weight.sum(axis=1)
        one = weight @ bits
        both = np.stack([(bits * w[:, None]).T @ bits for w in weight])
        gain = np.zeros((k, k))
        for y in range(2):
            whole = mass[y] + 4
            for a in (0, 1):
                for b in (0, 1):
                    pair = both[y] if a and b else one[y][:, None] - both[y] if a else one[y][None, :] - both[y] if b else mass[y] - one[y][:, None] - one[y][None, :] + both[y]
                    p = (pair + 1) / whole
                    pa = ((one[y] if a else mass[y] - one[y]) + 2) / whole
                    pb = ((one[y] if b else mass[y] - one[y]) + 2) / whole
                    gain += (whole / (mass.sum() + 8)) * p * np.log(p / np.outer(pa, pb))
        # Largest gains first from the first voter on.
        self.parent = np.full(k, -1)
        inside, best = np.zeros(k, bool), np.zeros(k, int)
        inside[0] = True
        for _ in range(k - 1):
            open_ = np.where(inside, -np.inf, gain[best, np.arange(k)])
            j = int(open_.argmax())
            self.parent[j], inside[j] = best[j], True
            best = np.where(gain[j] > gain[best, np.arange(k)], j, best)
        for y in range(2):
            for j in range(k):
                u = self.parent[j]
                if u < 0:
                    self.table[y, j] = (one[y, j] + 0.5) / (mass[y] + 5)
                    continue
                rate = (one[y, j] + 0.5) / (mass[y] + 5)
                # Rare parents lean on the voter's own rate.
                on, off = both[y, u, j], one[y, j] - both[y, u, j]
                self.table[y, j, 1] = (on + 2 * rate) / (one[y, u] + 2)
                self.table[y, j, 0] = (off + 2 * rate) / (mass[y] - one[y, u] + 2)
        self.table = np.clip(self.table, 1e-6, 1 - 1e-6)

    def log_votes(self, bits: np.ndarray) -> np.ndarray:
        """log P(votes | class), combinations x 2."""
        out = np.zeros((len(bits), 2))
        for j, u in enumerate(self.parent):
            p = self.table[:, j, :][:, bits[:, u].astype(int) if u >= 0 else np.zeros(len(bits), int)].T
            out += np.where(bits[:, [j]] > 0, np.log(p), np.log(1 - p))
        return out

    def posterior(self, bits: np.ndarray) -> np.ndarray:
        """P(toxic) for each combination without a label, with label 0 and with label 1."""
        by_class = self.log_votes(bits)
        base = np.log(self.prior / (1 - self.prior)) + by_class[:, 1] - by_class[:, 0]
        a = self.annotator
        labels = np.array([0.0, np.log((1 - a[1]) / (1 - a[0])), np.log(a[1] / a[0])])
        return 1 / (1 + np.exp(-np.clip(base[:, None] + labels, -40, 40)))


def fit_linear(rows: list[list[int]], targets: np.ndarray, n: int, rounds: int = 400, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on sets of terms with soft targets, by Adam on full batches."""
    sizes = np.array([len(r) for r in rows], np.int64)
    flat = np.fromiter((i for r in rows for i in r), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(rows)), sizes)
    w = np.zeros(n + 1)
    m, v = np.zeros(n + 1), np.zeros(n + 1)
    for i in range(1, rounds + 1):
        z = np.bincount(owner, weights=w[flat], minlength=len(rows)) + w[n]
        error = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - targets
        g = np.append(np.bincount(flat, weights=error[owner], minlength=n), error.sum()) / max(1, len(rows))
        g[:n] += l2 * w[:n]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-9)
    return w[:n], float(w[n])


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, max_labelled: int = MAX_LABELLED, max_terms: int = MAX_TERMS,
    max_unlabelled: int = MAX_UNLABELLED,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for each row of ``docs``.

    Only labels of rows outside the held-out fold are read, ``max_labelled`` of them at most (by a hash
    of the id; of several labels of one id the largest). Votes are counted over all documents outside
    that fold; beside the labelled rows, ``max_unlabelled`` others at most (by a hash of the row) train the classifier. Null texts count as empty and get the score of a text without terms, null ids are never
    labelled; repeated rows are scored each, an empty table gives no rows and other columns are ignored. Without
    usable labels every score rests on the fixed insults' voter alone.
    """
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    usable = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .where(~held_out(F.col("doc_id"), _FOLDS, _FOLD))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_labelled)
    )
    sample = materialize(usable)
    found = lexicon(source, sample, max_terms)
    names, strong = [t for t, _, _ in found], [s for _, _, s in found]
    for w in sorted(INSULTS.difference(names)):
        names.append(w)
        strong.append(False)
    make = lambda: Reader(names, strong)

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = make()
        kinds = [("votes", pa.int32()), ("label", pa.int32()), ("n", pa.int64()), ("place", pa.int64()), ("terms", pa.list_(pa.int32()))]
        schema = pa.schema(kinds)
        for batch in chunks(batches, 0):
            counts: Counter = Counter()
            rows = []
            for text, label, place, drawn in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                ids, bits = reader.read(text)
                if label is not None or drawn:
                    rows.append((bits, label, 1, place, ids))
                else:
                    counts[bits] += 1
            rows += [(bits, None, n, None, None) for bits, n in counts.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    training = source.where(~held_out(F.col("doc_id"), _FOLDS, _FOLD)).join(F.broadcast(sample), "doc_id", "left")
    place = F.xxhash64("doc_id", "text")
    share = min(1.0, 2 * max_unlabelled / max(1, source.count()))
    drawn = F.pmod(F.xxhash64("doc_id", "text", F.lit(1)), F.lit(1_000_000)) < int(share * 1_000_000)
    asked = training.select("text", "toxic", place.alias("place"), drawn.alias("drawn"))
    voted = materialize(asked.transform(mapped(votes, "votes int, label int, n long, place long, terms array<int>")))
    #: At most 2**16 combinations of 16 voters.
    tally: dict[int, np.ndarray] = {}
    for r in voted.groupBy("votes", "label").agg(F.sum("n").alias("n")).collect():
        tally.setdefault(r["votes"], np.zeros(3))[0 if r["label"] is None else 1 + r["label"]] += r["n"]
    combinations = np.array(sorted(tally) or [1], np.int64)
    bits = (combinations[:, None] >> np.arange(len(VOTERS)) & 1).astype(float)
    model = LabelModel.fit(bits, np.array([tally.get(c, np.zeros(3)) for c in combinations.tolist()]))
    posterior = dict(zip(combinations.tolist(), model.posterior(bits), strict=True))
    drawn_rows = voted.where("terms IS NOT NULL").select("votes", "label", "terms", "place")
    take = lambda which, most: drawn_rows.where(which).orderBy("place", "votes", "label").limit(most).collect()
    labelled = take("label IS NOT NULL", 2 * max_labelled)
    if labelled:
        known = [(r["terms"], float(posterior[r["votes"]][1 + r["label"]])) for r in labelled]
        known += [(r["terms"], float(posterior[r["votes"]][0])) for r in take("label IS NULL", max_unlabelled)]
    else:
        known = [([names.index(w)], 0.9) for w in sorted(INSULTS)] + [([], 0.01)] * 50
    targets = np.array([t for _, t in known])
    weights, bias = fit_linear([t for t, _ in known], targets, len(names))
    by_term = {i: float(x) for i, x in enumerate(weights)}

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = make()
        for batch in chunks(batches, 1):
            z = np.array([bias + sum(by_term[i] for i in reader.read(t)[0]) for t in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -40, 40))))], ["doc_id", "score"])

    return source.transform(mapped(score, "doc_id long, score double")).select(
        "doc_id",
        held_out(F.col("doc_id"), _FOLDS, _FOLD).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that are scored toxic; rows with a null id stay."""
    gone = materialize(toxicity_scores(docs, labels, **options).where("predicted = 1 AND doc_id IS NOT NULL").select("doc_id").distinct())
    return docs.join(small(gone), "doc_id", "left_anti").select(*docs.columns)
