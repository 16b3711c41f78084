"""Audit of how far each source's words diverge from its language and from the language's other sources.

Every source of a language gets an integer distribution over the language's kept terms. Two sources are compared
through their joint count histogram: how many terms have count x in the one and y in the other. Cells
with both counts positive are tallied from the terms themselves, inside tasks and before the shuffle; cells with a zero on one side
or on both are implied by the sources' own histograms, less what the first kind has taken. The divergence
is then evaluated once a cell, times the cell's multiplicity, and never once a term.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfspark.llm.hashing import text_bytes, words
from shelfspark.llm.util import chunks, mapped, materialize

#: Bytes that part terms: all ASCII but letters.
_OUTSIDE = np.arange(256) < 128
_OUTSIDE[[*range(65, 91), *range(97, 123)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Rows of partial counts that a task holds before it passes them on, and pairs of counts tallied in one step.
PARTIAL_ROWS, PAIR_BLOCK = 500_000, 1 << 21

#: Probabilities are shares of this whole.
UNIT = 1_000_000_000


def term_array(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts in a row, A-Z lower-cased, and the number of each one's text."""
    raw, offsets = text_bytes(texts)
    starts, ends, parts = words(raw, offsets, _OUTSIDE)
    lengths = ends - starts
    letters = np.ascontiguousarray(_LOWER[raw[~_OUTSIDE[raw]]])
    at = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=at[1:])
    terms = pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(at), pa.py_buffer(letters)])
    return terms, np.repeat(np.arange(len(texts)), np.diff(parts))


def _count(batch: pa.RecordBatch) -> pa.Table:
    """``lang, source, term, count, docs`` of a batch of (lang, source, text)."""
    terms, doc = term_array(batch.column(2))
    coded = terms.dictionary_encode()
    code, n = coded.indices.to_numpy().astype(np.int64), max(len(coded.dictionary), 1)
    groups, group = np.unique(np.stack([c.dictionary_encode().indices.to_numpy() for c in batch.columns[:2]]), axis=1, return_inverse=True)
    first = np.zeros(groups.shape[1], np.int64)
    first[group.ravel()[::-1]] = np.arange(batch.num_rows)[::-1]
    seen, counts = np.unique(doc * n + code, return_counts=True)
    keys, back = np.unique(group.ravel()[seen // n] * n + seen % n, return_inverse=True)
    own = pa.array(first[keys // n])
    return pa.table(
        {
            "lang": batch.column(0).take(own), "source": batch.column(1).take(own), "term": coded.dictionary.take(pa.array(keys % n)).cast(pa.string()),
            "count": np.bincount(back, counts, len(keys)).astype(np.int64), "docs": np.bincount(back, minlength=len(keys)).astype(np.int64),
        }
    )


def _merge(tables: list[pa.Table]) -> pa.Table:
    keys = ["lang", "source", "term"]
    done = pa.concat_tables(tables).group_by(keys, use_threads=False).aggregate([("count", "sum"), ("docs", "sum")])
    return done.select([*keys, "count_sum", "docs_sum"]).rename_columns([*keys, "count", "docs"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.Table] = []
    for batch in chunks(batches, 2, 4_000_000):
        held.append(_count(batch))
        if sum(t.num_rows for t in held) > 2 * PARTIAL_ROWS:
            held = [_merge(held)]
            if held[0].num_rows > PARTIAL_ROWS:
                yield from held.pop().combine_chunks().to_batches(65536)
    if held:
        yield from _merge(held).combine_chunks().to_batches(65536)


def term_counts(docs: DataFrame, min_docs: int = 3) -> DataFrame:
    """``lang, term, total, counts``: terms of at least ``min_docs`` of a language's rows, counts (source, count) by source.

    Null text, lang and source count as ''. Tasks count ahead of the one shuffle, so a frequent term costs
    a row a task and source, and its counts meet in a list of at most as many entries as the language has sources.
    """
    texts = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    partial = texts.transform(mapped(_counted, "lang string, source string, term string, count long, docs long"))
    by_source = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))
    by_term = by_source.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("count").alias("total"), F.array_sort(F.collect_list(F.struct("source", "count"))).alias("counts")
    )
    return by_term.where(F.col("docs") >= min_docs).select("lang", "term", "total", "counts")


def _pairs(size: int, source: np.ndarray, count: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Sources and counts (a, b, x, y) of all a < b of each row, in blocks; rows hold ``size`` entries."""
    for i in range(0, size - 1, step := max(1, PAIR_BLOCK // size)):
        # Entries i to i + step meet all later ones.
        left, right = np.triu_indices(size - i, 1)
        own = left < step
        left, right = left[own] + i, right[own] + i
        for at in range(0, len(source), rows := max(1, PAIR_BLOCK // max(len(left), 1))):
            part = slice(at, at + rows)
            yield tuple(c.ravel() for c in (source[part][:, left], source[part][:, right], count[part][:, left], count[part][:, right]))


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells with two positive counts, ``lang, a, b, x, y, m``, tallied within blocks of terms."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column(1)
        flat = lists.flatten()
        coded = flat.field(0).dictionary_encode()
        values, count = np.unique(flat.field(1).to_numpy(), return_inverse=True)
        names, source = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        sizes = pc.list_value_length(lists).to_numpy().astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        langs = batch.column(0).dictionary_encode()
        lang = langs.indices.to_numpy()
        s, k = len(names), len(values)
        wide = s * s * k * k >= 1 << 63
        for size in np.unique(sizes[sizes > 1]).tolist():
            for own_lang in np.unique(lang[sizes == size]).tolist():
                rows = np.flatnonzero((sizes == size) & (lang == own_lang))
                at = starts[rows][:, None] + np.arange(size)
                for a, b, x, y in _pairs(size, source[at], count[at]):
                    if wide:  # too many distinct values for one number
                        cells, m = np.unique(np.stack([a, b, x, y]), axis=1, return_counts=True)
                        a, b, x, y = cells
                    else:
                        cells, m = np.unique(((a * s + b) * k + x) * k + y, return_counts=True)
                        rest, y = np.divmod(cells, k)
                        rest, x = np.divmod(rest, k)
                        a, b = np.divmod(rest, s)
                    n = len(m)
                    yield pa.RecordBatch.from_arrays(
                        [
                            langs.dictionary.take(pa.array(np.full(n, own_lang))), names.take(pa.array(a)), names.take(pa.array(b)),
                            pa.array(values[x]), pa.array(values[y]), pa.array(m.astype(np.int64)),
                        ],
                        ["lang", "a", "b", "x", "y", "m"],
                    )


def joint_histograms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, a, b, x, y, m``: of each two sources a < b of a language, m terms have count x in a and y in b.

    ``kept`` as ``term_counts`` gives it, ``groups`` (lang, source, v, terms): the language's kept terms
    and those that the source has. Multiplicities of a pair add up to v; cells of no term are left out.
    """
    both = kept.select("lang", "counts").transform(mapped(_tally, "lang string, a string, b string, x long, y long, m long"))
    # A term with two positive counts leaves both cells with one zero, and comes back once to that with two.
    cell = lambda x, y, m: F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), m.alias("m"))
    x, y, m, zero = F.col("x"), F.col("y"), F.col("m"), F.lit(0)
    taken = both.select("lang", "a", "b", F.explode(F.array(cell(x, y, m), cell(x, zero, -m), cell(zero, y, -m), cell(zero, zero, m))).alias("c"))
    own = kept.select("lang", F.explode("counts").alias("c")).groupBy("lang", "c.source", "c.count").agg(F.count("*").alias("m"))
    pairs = source_pairs(groups)
    first = pairs.join(own.withColumnRenamed("source", "a"), ["lang", "a"]).select("lang", "a", "b", F.col("count").alias("x"), F.lit(0).cast("long").alias("y"), "m")
    second = pairs.join(own.withColumnRenamed("source", "b"), ["lang", "b"]).select("lang", "a", "b", F.lit(0).cast("long").alias("x"), F.col("count").alias("y"), "m")
    none = pairs.select("lang", "a", "b", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), (F.col("v") - F.col("terms_a") - F.col("terms_b")).alias("m"))
    cells = taken.select("lang", "a", "b", "c.*").unionByName(first).unionByName(second).unionByName(none)
    return cells.groupBy("lang", "a", "b", "x", "y").agg(F.sum("m").alias("m")).where("m > 0")


def source_pairs(groups: DataFrame) -> DataFrame:
    """Each two sources a < b of a language, once, with both sides' figures (as many rows as the audit's own pairs)."""
    left = groups.select("lang", F.col("source").alias("a"), "v", F.col("n").alias("n_a"), F.col("terms").alias("terms_a"))
    right = groups.select("lang", F.col("source").alias("b"), F.col("n").alias("n_b"), F.col("terms").alias("terms_b"))
    return left.join(right, "lang").where("a < b")


def share(count: Column, n: Column, v: Column) -> Column:
    """1 + floor(10^9 * (count + 1) / (n + v)), exact for counts up to 10^18."""
    above = F.lit(UNIT).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", above, (n + v).cast("decimal(20,0)")) + 1


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q), exact: shares are at most 10^9 + 1."""
    return F.call_function("div", (p - q) * (p - q), q)


def source_divergence(docs: DataFrame, min_docs: int = 3, top: int = 200) -> DataFrame:
    """``lang, source, part, item, value, rank`` for every (lang, source) that occurs, with texts or without.

    Part ``pair`` has a row for each other source of the language, valued by the sum of the divergence over all
    kept terms (0 where there are none); part ``term`` the ``top`` terms that the source has and uses more than its
    language does. Ranks run from 1 by value, ties by item in the order of its bytes. Null text, lang and source
    count as ''; each row is a document, repeated ids too; an empty table gives no rows; other columns are ignored.
    """
    kept = materialize(term_counts(docs, min_docs))
    terms = kept.select("lang", "term", "total", F.explode("counts").alias("c")).select("lang", "term", "total", "c.source", "c.count")
    own = terms.groupBy("lang", "source").agg(F.sum("count").alias("n"), F.count("*").alias("terms"))
    whole = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("n_lang"))
    found = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    groups = materialize(found.join(own, ["lang", "source"], "left").join(whole, "lang", "left").na.fill(0, ["n", "terms", "v", "n_lang"]))

    cells = joint_histograms(kept, groups).join(source_pairs(groups), ["lang", "a", "b"])
    p, q = share(F.col("x"), F.col("n_a"), F.col("v")), share(F.col("y"), F.col("n_b"), F.col("v"))
    cells = cells.select("lang", "a", "b", "m", p.alias("p"), q.alias("q"))
    p, q, m = F.col("p"), F.col("q"), F.col("m")
    sums = cells.groupBy("lang", "a", "b").agg(F.sum(divergence(p, q) * m).alias("ab"), F.sum(divergence(q, p) * m).alias("ba"))
    both_ways = F.array(
        F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("ab").alias("value")),
        F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("ba").alias("value")),
    )
    pairs = source_pairs(groups).select("lang", "a", "b").join(sums, ["lang", "a", "b"], "left").na.fill(0, ["ab", "ba"])
    pairs = pairs.select("lang", F.explode(both_ways).alias("r")).select("lang", "r.source", F.lit("pair").alias("part"), "r.item", "r.value")

    used = terms.join(groups.select("lang", "source", "n", "v", "n_lang"), ["lang", "source"])
    p, q = share(F.col("count"), F.col("n"), F.col("v")), share(F.col("total"), F.col("n_lang"), F.col("v"))
    used = used.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
    used = used.select("lang", "source", "part", "item", divergence(F.col("p"), F.col("q")).alias("value"))

    best_first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best_first))
    return ranked(pairs).unionByName(ranked(used).where(F.col("rank") <= top))
