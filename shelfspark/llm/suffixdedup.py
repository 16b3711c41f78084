"""Exact removal of repeated byte strings by distributed, externally induced suffix sorting.

Every ``length``-byte window picks an anchor by its content: the leftmost of the least hashed
``length // 2``-byte strings inside it. Equal windows pick equal anchors, so windows are compared within
the group of their anchor's string only. The windows that pick one anchor form a context, a stretch of
at most 150 bytes for a length of 100. Contexts are named by content (two 64-bit hashes), as substrings
are in the recursion of induced sorting: of equal contexts all but the first are repeats. Those that a task sees
itself are settled before anything is shuffled, so a passage that many documents share doesn't gather in one task.
Where a group holds unlike contexts, the first of each is suffix sorted, shard by shard, and classes of equal
windows are read off the common prefixes. What repeats is the same whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import hashing
from shelfspark.llm.suffixes import Shard
from shelfspark.llm.util import chunks, mapped, materialize, shared_dir, small

#: Context bytes that a shard sorts at once; a single group may hold more, of which TEXT_BYTES stay in memory.
SHARD_BYTES, TEXT_BYTES = 1_000_000, 16_000_000

#: Contexts of a task that are compared with each other before they are shuffled.
LOCAL_CONTEXTS = 400_000

#: Text whose windows are anchored at once: some twenty arrays of eight bytes a letter.
ANCHOR_BYTES = 256_000

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _sums(raw: np.ndarray, base: np.uint64) -> np.ndarray:
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * hashing.powers(base, len(raw)), out=total[1:])
    return total


def _span_hashes(total: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Hashes of byte spans from prefix sums: equal spans anywhere have equal hashes."""
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    return (total[ends] - total[starts]) * hashing.powers(inverse, len(total))[starts]


def contexts(raw: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Contexts of all texts: ``text`` (index), ``first`` and ``last`` window start in the text, ``anchor``
    and ``content`` hashes."""
    k = length // 2
    w = length - k + 1
    n = len(raw)
    empty = {c: np.zeros(0, np.int64) for c in ("text", "first", "last")} | {c: np.zeros(0, np.uint64) for c in ("anchor", "content")}
    if n < length:
        return empty
    total = _sums(raw, _A)
    at = np.arange(n - k + 1)
    grams = hashing.mix(_span_hashes(total, at, at + k, _A))
    # Least of w neighbours by doubling; the low bits hold the place, so ties go to the left.
    bits = np.uint64(max(1, int(n).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    least = (grams & ~low) | at.astype(np.uint64)
    span = 1
    while 2 * span <= w:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = w - span
    least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
    picked = (least & low).astype(np.int64)
    sizes = np.diff(offsets)
    counts = np.maximum(sizes - length + 1, 0)
    text = np.repeat(np.arange(len(sizes)), counts)
    windows = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[text]
    if not len(windows):
        return empty
    anchor = picked[windows]
    fresh = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(text) != 0)) + 1
    begin = np.concatenate([[0], fresh])
    last = np.concatenate([fresh, [len(windows)]]) - 1
    a, b = windows[begin], windows[last]
    content = hashing.mix(_span_hashes(_sums(raw, _B), a, b + length, _B) ^ (b - a).astype(np.uint64))
    origin = offsets[text[begin]]
    return {"text": text[begin], "first": a - origin, "last": b - origin, "anchor": grams[anchor[begin]], "content": content}


_CONTEXT = pa.schema([("anchor", pa.int64()), ("doc_id", pa.int64()), ("first", pa.int64()), ("last", pa.int64()), ("sort", pa.bool_())])
_CONTEXT_DDL = "anchor long, doc_id long, first long, last long, sort boolean"


class _Local:
    """Contexts of one task: copies among them become spans, the first of each is left for the shuffle."""

    def __init__(self, length: int):
        self.length, self.held, self.n = length, [], 0

    def add(self, found: dict[str, np.ndarray], ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        row = (found["anchor"].view(np.int64), found["content"].view(np.int64), ids[found["text"]], found["first"], found["last"])
        self.held.append(np.stack(row))
        self.n += len(row[0])
        if self.n >= LOCAL_CONTEXTS:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        anchor, content, doc, first, last = np.concatenate(self.held or [np.zeros((5, 0), np.int64)], axis=1)
        self.held, self.n = [], 0
        order = np.lexsort((first, doc, content, anchor))
        anchor, content, doc, first, last = (x[order] for x in (anchor, content, doc, first, last))
        copy = np.zeros(len(anchor), bool)
        copy[1:] = (content[1:] == content[:-1]) & (anchor[1:] == anchor[:-1])
        start, end, owner = first[copy], last[copy] + self.length, doc[copy]
        order = np.lexsort((start, owner))
        start, end, owner = start[order], end[order], owner[order]
        number = np.cumsum(np.concatenate([[0], owner[1:] != owner[:-1]])) if len(owner) else owner
        reach = np.maximum.accumulate((number << 32) + end) if len(owner) else end
        heads = np.flatnonzero(np.concatenate([[True], (number[1:] << 32) + start[1:] > reach[:-1]])) if len(owner) else number
        ends = np.append(heads[1:], len(start)) - 1
        owner, start, end = owner[heads], start[heads], reach[ends] - (number[ends] << 32) if len(heads) else end
        # Spans go anywhere: their key only deals them out evenly.
        deal = hashing.mix(owner.view(np.uint64) ^ hashing.mix(start.view(np.uint64))).view(np.int64)
        rows = [(deal, anchor), (np.zeros_like(deal), content), (owner, doc), (start, first), (end - self.length, last)]
        columns = [pa.array(np.concatenate([x, y[~copy]])) for x, y in rows]
        return pa.RecordBatch.from_arrays([*columns, pa.array(np.arange(len(columns[0])) < len(deal))], _LISTED)


_LISTED = ["anchor", "content", "doc_id", "first", "last", "span"]


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams contexts (anchor, content, doc_id, first, last, span) sorted in that order.

    Gives each context that repeats an earlier one of its content (``sort`` false) and, of anchors with
    several contents, the first context of each (``sort`` true). Rows marked ``span`` are repeats already.
    One row is held, whatever a group's size.
    """
    previous: tuple[int, int] | None = None
    waiting = None  # the first row of an anchor that has shown one content so far
    for batch in batches:
        spans = batch.filter(batch.column(5))
        if spans.num_rows:
            yield pa.RecordBatch.from_arrays([*(spans.column(i) for i in (0, 2, 3, 4)), pa.array(np.zeros(spans.num_rows, bool))], schema=_CONTEXT)
            batch = batch.filter(pa.compute.invert(batch.column(5)))
        if batch.num_rows == 0:
            continue
        anchor, content, *rest = (batch.column(i).to_numpy() for i in range(5))
        same_anchor = np.concatenate([[previous is not None and previous[0] == anchor[0]], anchor[1:] == anchor[:-1]])
        copy = same_anchor & np.concatenate([[previous is not None and previous[1] == content[0]], content[1:] == content[:-1]])
        heads = np.flatnonzero(~copy)
        later = same_anchor[heads]  # heads whose anchor has had another content before
        shown = np.zeros(len(anchor), bool)
        shown[heads[later]] = True
        shown[heads[:-1][later[1:]]] = True
        out = [np.concatenate([x[copy], x[shown]]) for x in (anchor, *rest)]
        flags = np.repeat([False, True], [copy.sum(), shown.sum()])
        if len(heads):
            if later[0] and waiting is not None:
                out = [np.append(c, v) for c, v in zip(out, waiting, strict=True)]
                flags = np.append(flags, True)
            end = heads[-1]
            waiting = None if later[-1] else tuple(x[end] for x in (anchor, *rest))
        previous = (anchor[-1], content[-1])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out] + [pa.array(flags, pa.bool_())], schema=_CONTEXT)


def _sorted_shards(length: int, folder: str):
    """Suffix sorts the contexts (anchor, doc_id, first, piece) of whole anchors and gives repeats as spans.

    Contexts come by (anchor, document, place), so that the first of equal strings in the shard starts earliest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, last = Shard(length, folder, TEXT_BYTES), None

        def spans() -> pa.RecordBatch:
            out: list[np.ndarray] = [np.zeros((0, 3), np.int64)]
            for (doc, first), found in shard.repeats():
                cut = np.flatnonzero(np.diff(found) != 1)
                a, b = found[np.concatenate([[0], cut + 1])], found[np.append(cut, len(found) - 1)]
                out.append(np.stack([np.full(len(a), doc), first + a, first + b + length], axis=1))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(out).T], ["doc_id", "start", "end"])

        for batch in batches:
            for anchor, doc, first, piece in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if shard.size > SHARD_BYTES and anchor != last:
                    yield spans()
                    shard = Shard(length, folder, TEXT_BYTES)
                shard.add((doc, first), piece)
                last = anchor
        if shard.size:
            yield spans()

    return run


def _source(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )


def first_texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` of ids in several rows with a text: the first text in order. Only ids are shuffled for the others."""
    source = _source(docs)
    again = materialize(source.groupBy("doc_id").count().where("count > 1").select("doc_id"))
    return materialize(source.join(small(again), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("text").alias("text")))


def repeated_spans(docs: DataFrame, length: int = 100, firsts: DataFrame | None = None) -> DataFrame:
    """``doc_id, spans``: merged byte spans, array<struct<start,end>>, of strings that also start earlier.

    Earlier means a smaller doc_id, or an earlier start in the same text. Texts are UTF-8 bytes; null
    texts are empty; null ids take no part; of repeated ids the first text in order counts. Only
    documents with such spans are returned. ``firsts`` is ``first_texts(docs)`` where it is at hand.
    """
    firsts = first_texts(docs) if firsts is None else firsts
    source = _source(docs)
    if not firsts.isEmpty():
        source = source.join(small(firsts.select("doc_id")), "doc_id", "left_anti").unionByName(firsts)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local = _Local(length)
        for batch in chunks(batches, 1, ANCHOR_BYTES):
            yield from local.add(contexts(*hashing.text_bytes(batch.column(1)), length), batch.column(0).to_numpy())
        yield local.flush()

    listed = source.transform(mapped(anchors, "anchor long, content long, doc_id long, first long, last long, span boolean"))
    grouped = listed.repartition("anchor").sortWithinPartitions("anchor", "content", "doc_id", "first")
    repeated = materialize(grouped.transform(mapped(_repeated, _CONTEXT_DDL)))
    copies = repeated.where("NOT sort").select("doc_id", F.col("first").alias("start"), (F.col("last") + length).alias("end"))

    # Texts of contexts to sort: a document's contexts meet its text once.
    unlike = repeated.where("sort").groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("first", "last", "anchor"))).alias("contexts"))
    wanted = materialize(unlike)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1):
            out: list[list] = [[], [], [], []]
            for doc, text, own in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                raw = text.encode()
                for c in own:
                    piece = raw[c["first"] : c["last"] + length]
                    for column, value in zip(out, (c["anchor"], doc, c["first"], piece), strict=True):
                        column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, types, strict=True)], ["anchor", "doc_id", "first", "piece"])

    holders = source.join(small(wanted.select("doc_id")), "doc_id", "left_semi")
    pieces = holders.join(wanted, "doc_id").select("doc_id", "text", "contexts").transform(mapped(cut, "anchor long, doc_id long, first long, piece binary"))
    shards = pieces.repartition("anchor").sortWithinPartitions("anchor", "doc_id", "first")
    sorted_ = shards.transform(mapped(_sorted_shards(length, shared_dir(docs.sparkSession)), "doc_id long, start long, end long"))

    # Spans that overlap or touch become one.
    spans = copies.union(sorted_).groupBy("doc_id").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
            flat = lists.flatten()
            start, end = (flat.field(i).to_numpy() for i in range(2))
            # Sorted within a document; the document's number in the high bits keeps documents apart.
            base = owner.astype(np.int64) << 32
            reach = np.maximum.accumulate(base + end)
            fresh = np.concatenate([[True], base[1:] + start[1:] > reach[:-1]])
            heads = np.flatnonzero(fresh)
            ends = np.append(heads[1:], len(start)) - 1
            merged = pa.StructArray.from_arrays([pa.array(start[heads]), pa.array(reach[ends] - base[ends])], ["start", "end"])
            offsets = np.searchsorted(owner[heads], np.arange(len(lists) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), merged)], ["doc_id", "spans"])

    return spans.mapInArrow(merge, "doc_id long, spans array<struct<start: bigint, end: bigint>>")


def remove_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """The columns of ``docs`` with ``kept`` (binary: the text without its repeated spans) and ``spans``.

    Null texts count as empty; of rows of one id those with the first text in order are cut, the others
    left as they are; rows with a null id are left whole. Every row stays; an
    empty table gives no rows. Columns of ``docs`` named ``kept`` or ``spans`` give way to these.
    """
    docs = docs.drop("kept", "spans")
    firsts = first_texts(docs)
    spans = materialize(repeated_spans(docs, length, firsts))
    ids = spans.select("doc_id")
    docs_at = docs.columns.index("text")
    kind = "kept binary, spans array<struct<start: bigint, end: bigint>>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, docs_at):
            at, by = docs_at, len(batch.schema) - 1
            kept = []
            for text, own in zip(batch.column(at).to_pylist(), batch.column(by).to_pylist(), strict=True):
                raw, parts, place = (text or "").encode(), [], 0
                for s in own:
                    parts.append(raw[place : s["start"]])
                    place = s["end"]
                kept.append(b"".join([*parts, raw[place:]]))
            columns = [c for i, c in enumerate(batch.columns) if i != by]
            fields = [f for i, f in enumerate(batch.schema) if i != by]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(kept, pa.binary()), batch.column(by)], [*(f.name for f in fields), "kept", "spans"]
            )

    from pyspark.sql.types import StructType

    schema = StructType([*docs.schema.fields, *StructType.fromDDL(kind).fields])
    cuttable, others = docs, docs.limit(0)
    if not firsts.isEmpty():
        digest = lambda x: F.sha2(F.col(x).cast("string").cast("binary"), 256)
        keys = firsts.select("doc_id", digest("text").alias("__first"))
        keyed = docs.join(small(keys), "doc_id", "left").withColumn("__other", F.col("__first").isNotNull() & ~F.col("__first").eqNullSafe(digest("text")))
        cuttable, others = (keyed.where(x).select(*docs.columns) for x in ("NOT __other", "__other"))
    touched = cuttable.join(small(ids), "doc_id", "left_semi").join(spans, "doc_id").select(*docs.columns, "spans").transform(mapped(cut, schema))
    whole = cuttable.join(small(ids), "doc_id", "left_anti").select(*docs.columns).unionByName(others).select(
        *docs.columns,
        F.coalesce("text", F.lit("")).cast("binary").alias("kept"),
        F.array().cast("array<struct<start: bigint, end: bigint>>").alias("spans"),
    )
    return touched.unionByName(whole)


def digests(removed: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of ``remove_repeats``' rows."""
    n = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return removed.select(
        "doc_id",
        n.alias("n_bytes"),
        (n - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def drop_repeats(docs: DataFrame, length: int = 100) -> DataFrame:
    """``docs`` with texts cut; parts of letters left at a border are dropped, ``n_chars`` follows the text."""
    own = {c: f"own_{c}_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "n_chars")}
    names, docs = docs.columns, docs.withColumnsRenamed(own)
    text = F.when(F.col("text").isNull(), F.lit(None).cast("string")).otherwise(
        F.when(F.is_valid_utf8(F.col("kept").cast("string")), F.col("kept").cast("string")).otherwise(
            F.replace(F.make_valid_utf8(F.col("kept").cast("string")), F.lit("\ufffd"), F.lit(""))
        )
    )
    cut = remove_repeats(docs, length).withColumn("text", F.when(F.size("spans") > 0, text).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.when(F.size("spans") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return cut.select(*docs.columns).withColumnsRenamed({v: k for k, v in own.items()}).select(*names)
