"""WARC archives: writing, reading back, and merging capture runs into one ordered index.

Archives are written by Spark's own text writer into the shared folder (gzip, CRLF separators), so they
reach any store that Spark can write and appear only once a task commits. Every record is UTF-8 text:
ASCII headers and a payload that is the page's html.

The index merge writes each reading task's captures as a run, sorted locally by (url key, timestamp, page).
Range borders are read off the runs at even steps, every run is cut at them into packed blocks, and each range merges
the blocks of its k runs with a loser tree. Only blocks are shuffled, and no task sorts what runs have sorted.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfspark.llm.util import materialize, mapped, shared_dir, small

#: Payloads below this size are never deduplicated.
MIN_REVISIT_BYTES = 1000

#: Captures that a range of the merged index holds, about; a task keeps one range in memory. Most borders' samples.
RANGE_CAPTURES, SAMPLES = 200_000, 100_000

_VERSION = "WARC/1.1"


def url_key(url: Column) -> Column:
    """Sort key of a url: host labels from the top level down, then port, path and query, in lower case."""
    bare = F.regexp_replace(F.lower(F.trim(F.coalesce(url, F.lit("")))), r"^[a-z][a-z0-9+.-]*://(?:[^/@]*@)?|#.*$", "")
    host = F.regexp_replace(F.regexp_extract(bare, r"^([^/:?]*)", 1), r"^www\d*\.", "")
    return F.concat(
        F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.regexp_replace(bare, r"^[^/:?]*", "")
    )


def _header_value(c: Column) -> Column:
    """A value that stays on its line: control characters and line separators become ``%20``."""
    return F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"[\x00-\x1f\x7f\u0085  ]", "%20")


def plan_records(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Pages with ``payload, payload_bytes, payload_digest, refers_to`` (null: a response).

    Of equal payloads (equal SHA-256 and length) of at least ``min_bytes``, the row of the largest page_id
    is the response, as are rows that repeat it; a null page_id is the smallest. Sizes and digests are
    aggregated before they are shuffled; only groups of two rows or more are joined back.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", "url", payload.alias("payload")).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    keyed = base.select(
        "*",
        F.sha1(F.col("payload").cast("binary")).alias("payload_digest"),
        F.when(F.col("payload_bytes") >= min_bytes, F.unhex(F.sha2(F.col("payload").cast("binary"), 256))).alias("same"),
    )
    groups = (
        keyed.where("same IS NOT NULL").groupBy("same").agg(F.max("page_id").alias("response_id"), F.count("*").alias("n"))
        .where("n > 1").drop("n")
    )
    # Payloads without a key, and those of their own, meet nothing.
    groups = materialize(groups)
    known = keyed.where("same IS NOT NULL").join(small(groups), "same", "left")
    alone = keyed.where("same IS NULL").withColumn("response_id", F.lit(None).cast(groups.schema["response_id"].dataType))
    return (
        known.unionByName(alone)
        .withColumn(
            "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("response_id")), F.col("response_id"))
        )
        .select("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")
    )


def warc_record(row: dict[str, Column] | None = None) -> Column:
    """The text of a record, without its last line end (the writer's separator)."""
    c = row or {n: F.col(n) for n in ("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")}
    revisit = c["refers_to"].isNotNull()
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    uri = lambda i: F.concat(F.lit("<urn:page:"), F.coalesce(i.cast("string"), F.lit("none")), F.lit(">"))
    second = lambda i: F.date_format(
        F.timestamp_seconds(F.lit(946684800) + F.pmod(F.coalesce(i, F.lit(0)), F.lit(10**9))), "yyyy-MM-dd'T'HH:mm:ss'Z'"
    )
    length = F.when(revisit, F.lit(0)).otherwise(c["payload_bytes"])
    return F.concat(
        F.lit(_VERSION + "\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", uri(c["page_id"])),
        line("WARC-Target-URI", _header_value(c["url"])),
        line("WARC-Date", second(c["page_id"])),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), c["payload_digest"])),
        line("X-Payload-Length", c["payload_bytes"].cast("string")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
                line("WARC-Refers-To", uri(c["refers_to"])),
            ),
        ).otherwise(""),
        line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        F.when(revisit, "").otherwise(c["payload"]),
        F.lit("\r\n"),
    )


def write_archives(pages: DataFrame, path: str | None = None) -> str:
    """Write one WARC record per row of ``pages`` (page_id, url, html); returns the archives' folder."""
    path = path or shared_dir(pages.sparkSession)
    plan_records(pages).select(warc_record().alias("value")).write.option("lineSep", "\r\n").option("compression", "gzip").text(path)
    return path


class _Records:
    """Cuts a stream of lines into records, by Content-Length."""

    def __init__(self):
        self.headers: dict[str, str] | None = None
        self.body: list[bytes] = []
        self.missing = 0

    def feed(self, line: bytes) -> tuple[dict[str, str], bytes] | None:
        """Takes the next line without its CRLF; returns a record once it is whole."""
        if self.headers is None:
            if line == _VERSION.encode():
                self.headers, self.missing = {}, -1
            elif line:
                raise ValueError(f"not a WARC record: {line[:80]!r}")
            return None
        if self.missing < 0:
            if line:
                name, _, value = line.decode().partition(": ")
                self.headers[name] = value
                return None
            self.missing, self.body = int(self.headers["Content-Length"]), []
            return None if self.missing else self._done()
        self.body.append(line)
        self.missing -= len(line)
        if self.missing <= 0:
            if self.missing < 0:
                raise ValueError("a payload runs over its Content-Length")
            return self._done()
        self.body.append(b"\r\n")
        self.missing -= 2
        return None if self.missing > 0 else self._done() if self.missing == 0 else None

    def _done(self) -> tuple[dict[str, str], bytes]:
        out, self.headers = (self.headers or {}, b"".join(self.body)), None
        return out


def read_archives(spark, path: str) -> DataFrame:
    """The records of all archives: ``archive, position, page_id, url, captured, record_type, payload_bytes,
    payload_digest, refers_to``.

    A response's size and digest are taken from its payload and held against its headers; a revisit
    carries those of the payload it stands for. Gzip files aren't split, so a file's lines come in order
    to one task, which holds one record at a time.
    """
    lines = spark.read.option("lineSep", "\r\n").text(path).select(F.input_file_name().alias("archive"), F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        schema = pa.schema(
            [
                ("archive", pa.string()), ("position", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("captured", pa.string()),
                ("record_type", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
            ]
        )
        number = lambda uri: None if uri is None or uri == "<urn:page:none>" else int(uri[len("<urn:page:") : -1])
        reader, archive, position = _Records(), None, 0
        for batch in batches:
            rows = []
            for name, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name != archive:
                    if reader.headers is not None:
                        raise ValueError(f"{archive} ends within a record")
                    reader, archive, position = _Records(), name, 0
                record = reader.feed(line)
                if record is None:
                    continue
                h, body = record
                digest, size = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(h["X-Payload-Length"])
                if h["WARC-Type"] == "response" and (hashlib.sha1(body).hexdigest(), len(body)) != (digest, size):
                    raise ValueError(f"{h['WARC-Record-ID']}: payload and headers differ")
                rows.append(
                    (name, position, number(h["WARC-Record-ID"]), h["WARC-Target-URI"], h["WARC-Date"], h["WARC-Type"], size, digest, number(h.get("WARC-Refers-To")))
                )
                position += 1
            columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        if reader.headers is not None:
            raise ValueError(f"{archive} ends within a record")

    ddl = (
        "archive string, position long, page_id long, url string, captured string, record_type string, payload_bytes long, "
        "payload_digest string, refers_to long"
    )
    return lines.transform(mapped(run, ddl))


class LoserTree:
    """Merges k sorted runs of (key, item): the winner leaves, and its run's next key replays one path."""

    def __init__(self, runs: list[Iterator[tuple]]):
        self.runs = [iter(r) for r in runs]
        self.heads = [next(r, None) for r in self.runs]
        self.k = len(self.runs)
        self.losers = [-1] * max(1, self.k)
        for leaf in range(self.k):
            self._build(leaf)

    def _less(self, a: int, b: int) -> bool:
        """Whether run ``a`` goes before ``b``: an ended run is last, ties go to the earlier run."""
        x, y = self.heads[a], self.heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return (x[0], a) < (y[0], b)

    def _build(self, leaf: int) -> None:
        """While the tree fills, a leaf waits at the first empty node."""
        winner, node = leaf, (leaf + self.k) // 2
        while node > 0:
            if self.losers[node] < 0:
                self.losers[node] = winner
                return
            if self._less(self.losers[node], winner):
                winner, self.losers[node] = self.losers[node], winner
            node //= 2
        self.losers[0] = winner

    def __iter__(self) -> Iterator[tuple]:
        while self.k and (head := self.heads[winner := self.losers[0]]) is not None:
            yield head
            self.heads[winner] = next(self.runs[winner], None)
            node = (winner + self.k) // 2
            while node > 0:
                if self._less(self.losers[node], winner):
                    winner, self.losers[node] = self.losers[node], winner
                node //= 2
            self.losers[0] = winner


def _keys(batch: pa.RecordBatch) -> list[tuple]:
    """Sort keys of captures; a null page goes first, as in Spark's order."""
    url, captured, page = (batch.column(c).to_pylist() for c in ("url_key", "captured", "page_id"))
    archive, position = (batch.column(c).to_pylist() for c in ("archive", "position"))
    return [(u, c, p is not None, p or 0, a, n) for u, c, p, a, n in zip(url, captured, page, archive, position, strict=True)]


def merge_index(captures: DataFrame, ranges: int | None = None) -> DataFrame:
    """``captures`` (as read from archives) in global order of (url key, timestamp, page), in capture histories.

    Adds ``url_key``, the range ``part`` and the place ``part_pos`` in it; (part, part_pos) is the order.
    Range borders are full sort keys, so a host or url with a third of all captures spreads over many ranges;
    there are as many ranges as the number of captures asks for (or ``ranges``).
    """
    order = ["url_key", "captured", "page_id", "archive", "position"]
    sorted_ = captures.withColumn("url_key", url_key(F.col("url"))).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id()
    runs = materialize(sorted_.withColumn("run", F.shiftright(place, 33)).withColumn("run_pos", place.bitwiseAND(F.lit((1 << 33) - 1))))
    names = [c for c in runs.columns if c not in ("run", "run_pos")]
    total = runs.count()
    n = ranges or max(1, -(-total // RANGE_CAPTURES))
    borders: list[tuple] = []
    if n > 1:
        step = max(1, min(RANGE_CAPTURES, total // n) // 16, total // SAMPLES)
        sample = runs.where(F.col("run_pos") % step == step // 2).select(*order).collect()
        keys = sorted((r["url_key"], r["captured"], r["page_id"] is not None, r["page_id"] or 0, r["archive"], r["position"]) for r in sample)
        borders = [keys[len(keys) * i // n] for i in range(1, n)] if keys else []

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of one run and range each: ``part, run, run_pos, block``."""
        for batch in batches:
            if not batch.num_rows:
                continue
            own, pos = batch.column("run").to_numpy(), batch.column("run_pos").to_numpy()
            parts = np.fromiter((bisect_right(borders, k) for k in _keys(batch)), np.int64, batch.num_rows)
            fresh = np.flatnonzero((np.diff(own) != 0) | (np.diff(parts) != 0) | (np.diff(pos) != 1)) + 1
            starts = [0, *fresh.tolist()]
            blocks = []
            for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
                sink = pa.BufferOutputStream()
                piece = batch.slice(a, b - a).select(names)
                with pa.ipc.new_stream(sink, piece.schema) as out:
                    out.write_batch(piece)
                blocks.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(parts[starts], pa.int32()), pa.array(own[starts]), pa.array(pos[starts]), pa.array(blocks, pa.binary())], ["part", "run", "run_pos", "block"]
            )

    def merged(part: int, blocks: list[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
        pieces = [pa.ipc.open_stream(b).read_all().combine_chunks().to_batches()[0] for _, b in blocks]
        of_run: dict[int, list[tuple]] = {}
        at = 0
        for (run, _), piece in zip(blocks, pieces, strict=True):
            keys = _keys(piece)
            of_run.setdefault(run, []).extend(zip(keys, range(at, at + len(keys)), strict=True))
            at += len(keys)
        rows = pa.concat_batches(pieces)
        places = pa.array([i for _, i in LoserTree(list(of_run.values()))], pa.int64())
        for start in range(0, at, 10_000):
            piece = rows.take(places[start : start + 10_000])
            yield pa.RecordBatch.from_arrays(
                [*piece.columns, pa.array(np.full(piece.num_rows, part, np.int32)), pa.array(np.arange(start, start + piece.num_rows))], [*names, "part", "part_pos"]
            )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks = None, []
        for batch in batches:
            for p, r, b in zip(*(batch.column(c).to_pylist() for c in (0, 1, 3)), strict=True):
                if p != part and blocks:
                    yield from merged(part, blocks)
                    blocks = []
                part = p
                blocks.append((r, b))
        if blocks:
            yield from merged(part, blocks)

    packed = runs.transform(mapped(cut, "part int, run long, run_pos long, block binary"))
    schema = T.StructType([runs.schema[c] for c in names] + [T.StructField("part", T.IntegerType()), T.StructField("part_pos", T.LongType())])
    return packed.repartition("part").sortWithinPartitions("part", "run", "run_pos").transform(mapped(merge, schema))


def capture_index(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC archives, read them back and merge their capture index.

    Null html counts as empty, a null url as empty; null ids and repeated rows keep their records; an
    empty table gives an empty index; other columns are ignored.
    """
    folder = write_archives(pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string")), path)
    return merge_index(read_archives(pages.sparkSession, folder))
