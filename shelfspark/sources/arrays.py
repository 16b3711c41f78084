"""One JSON array read by many tasks.

The file is scanned as text that is parted at closing braces, so Spark splits it by byte ranges wherever it lies. Whether
a byte range starts inside a string and how deep is known only after those before it. A first pass therefore reduces
each range to what it does to either state; the driver joins these few numbers, and a second pass cuts the
records. A record that runs over ranges is put together from its pieces.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfspark.storage import materialize

_ESCAPED = re.compile(r"\\.", re.DOTALL)
#: Up to the array's bracket.
_OPENING = re.compile(r'\s*(?:\[|\{\s*"(?:records|products)"\s*:\s*\[)')
_NOT_BRACKETS = re.compile(r"[^][{}]+")


@dataclass
class Effect:
    """What a text does if it starts outside (0) or inside (1) a string: change of depth, least depth on the way, and state after."""

    delta: int
    least: int
    inside: bool


def _effect(text: str, inside: bool) -> Effect:
    parts = _ESCAPED.sub("", text).split('"')
    depth = least = 0
    for bracket in _NOT_BRACKETS.sub("", "".join(parts[inside::2])):
        depth += 1 if bracket in "[{" else -1
        least = min(least, depth)
    return Effect(depth, least, inside != (len(parts) % 2 == 0))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """``start, piece``: texts up to each closing brace, with the start of their byte range; in order within it."""
    return spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("piece"))


def _trimmed(batches: Iterator[pa.RecordBatch], skip: int) -> Iterator[tuple[int, str]]:
    """Byte range and text of each piece with its brace, without what opens the array."""
    first = True
    for batch in batches:
        for start, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            text = piece + "}"
            if start == 0 and first:
                text, first = text[skip:], False
            yield start, text


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _reduced(skip: int):
    """One row a byte range and starting state: the effect of all its pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[Effect]] = {}
        for start, text in _trimmed(batches, skip):
            whole = found.setdefault(start, [Effect(0, 0, False), Effect(0, 0, True)])
            for i, e in enumerate(whole):
                own = _effect(text, e.inside)
                whole[i] = Effect(e.delta + own.delta, min(e.least, e.delta + own.least), own.inside)
        schema = pa.schema([("start", pa.int64()), ("state", pa.int32()), ("delta", pa.int64()), ("least", pa.int64()), ("inside", pa.bool_())])
        yield _batch([(start, s, e.delta, e.least, e.inside) for start, both in found.items() for s, e in enumerate(both)], schema)

    return run


@dataclass(frozen=True)
class _Begin:
    """How a byte range begins: depth in the array's elements, inside a string or not, after the array or not, and the range where its open record began."""

    depth: int
    inside: bool
    ended: bool
    anchor: int


#: Place of the record that is open at a range's end, behind the range's others.
_OPEN = 1 << 62


def _cut(skip: int, begins: dict[int, _Begin]):
    """``anchor, seq, piece, text``: records by the range where they begin; those that run over its end in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("anchor", pa.int64()), ("seq", pa.int64()), ("piece", pa.int64()), ("text", pa.string())])
        at, rows, size = None, [], 0

        def close() -> None:
            if pending and not ended:
                rows.append((anchor, _OPEN, at, "".join(pending)))

        pending: list[str] = []
        for start, text in _trimmed(batches, skip):
            if start != at:
                close()
                at, seq, pending = start, 0, []
                depth, inside, ended, anchor = (lambda b: (b.depth, b.inside, b.ended, b.anchor))(begins[start])
                continued = depth > 0
                if not continued:
                    anchor = start
            if ended:
                continue
            e = _effect(text, inside)
            pending.append(text)
            if depth + e.least < 0:
                if not re.match(r"\s*\]", "".join(pending)):
                    raise ValueError("the array holds other elements than objects")
                ended = True
                continue
            depth, inside = depth + e.delta, e.inside
            if depth == 0 and not inside:
                rows.append((anchor, _OPEN if continued else seq, at if continued else 0, "".join(pending)))
                seq, continued, anchor, pending = seq + (not continued), False, start, []
                size += len(rows[-1][3])
                if size > 4_000_000:
                    yield _batch(rows, schema)
                    rows, size = [], 0
        close()
        yield _batch(rows, schema)

    return run


def array_records(spark: SparkSession, path: str) -> DataFrame | None:
    """``pos, text``: the elements of one JSON array of objects in order, or none if the file doesn't open with such an array.

    The file holds ``[...]`` or an object whose first key is ``records`` or ``products``. Other elements than objects and an
    array that doesn't end are errors. Five numbers a byte range and a count reach the driver.
    """
    pieces = _pieces(spark, path)
    head = pieces.where("start = 0").first()
    opening = _OPENING.match(head.piece + "}") if head else None
    if opening is None:
        return None
    skip = opening.end()
    effects: dict[int, dict[bool, Effect]] = {}
    for r in pieces.mapInArrow(_reduced(skip), "start long, state int, delta long, least long, inside boolean").collect():
        effects.setdefault(r.start, {})[bool(r.state)] = Effect(r.delta, r.least, r.inside)
    depth, inside, ended, anchor, begins = 0, False, False, 0, {}
    for start in sorted(effects):
        begins[start] = _Begin(depth, inside, ended, anchor)
        e = effects[start][inside]
        if depth == 0 or depth + e.least <= 0:
            anchor = start  # a record ends or begins here, so an open one at its end began here
        ended, depth, inside = ended or depth + e.least < 0, depth + e.delta, e.inside
    if not ended:
        raise ValueError(f"the array in {path} doesn't end")
    found = materialize(pieces.mapInArrow(_cut(skip, begins), "anchor long, seq long, piece long, text string"))
    open_ = found.where(F.col("seq") == _OPEN).groupBy("anchor", "seq").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", "text"))), lambda p: p["text"]), "").alias("text"))
    records = found.where(F.col("seq") < _OPEN).select("anchor", "seq", "text").unionByName(open_)
    # A range's records are numbered from 0, and the open one comes last.
    before, offsets = 0, []
    for r in sorted(found.groupBy("anchor").agg(F.count_if(F.col("seq") < _OPEN).alias("n"), F.max((F.col("seq") == _OPEN).cast("int")).alias("open")).collect()):
        offsets.append((r.anchor, before, r.n))
        before += r.n + r.open
    placed = records.join(F.broadcast(spark.createDataFrame(offsets, "anchor long, before long, n long")), "anchor")
    pos = F.col("before") + F.when(F.col("seq") == _OPEN, F.col("n")).otherwise(F.col("seq"))
    # Between records stand commas; a record's own text starts at its brace.
    text = F.regexp_replace("text", r"^\s*,?\s*(?=\{)", "")
    whole = F.when(F.startswith(text, F.lit("{")), text).otherwise(F.raise_error(F.lit("the array holds other elements than objects")))
    return placed.select(pos.cast("int").alias("pos"), whole.alias("text"))
