"""Media columns: texts kept as motion-JPEG movies, and the timed clips of a movie.

A payload becomes the quantised coefficients of baseline JPEG frames, so that it is stored without loss in a
format that is otherwise lossy. Reading parses the file's lists and index, decodes every frame (each stands
for itself) and finds shots where the histograms of neighbouring frames differ much more than around them.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfspark.llm import mjpeg
from shelfspark.llm.util import BATCH_BYTES, chunks, mapped

#: Side of a frame in pixels, bytes of a unit (a block of each component) and units of a frame; microseconds a frame.
SIDE, UNIT, UNITS, MICROS = 16, 192, 4, 40_000
#: Frames coded in one step.
BLOCK = 4096
#: Steps of a sample in a histogram, frames on either side whose changes are the measure, and how much (in halves) a cut exceeds them.
BINS, AROUND, HALVES = 16, 8, 3


def padded(text: bytes) -> bytes:
    """With spaces up to a positive multiple of the unit."""
    return text + b" " * (-len(text) % UNIT or (UNIT if not text else 0))


def movies(texts: list[bytes]) -> list[bytes]:
    """An AVI file for each text; its information list says how many bytes count and how many are stored."""
    size = UNIT * UNITS
    payloads = [padded(t) for t in texts]
    counts = [-(-len(p) // size) for p in payloads]
    raw = np.frombuffer(b"".join(p + b"\x80" * (n * size - len(p)) for p, n in zip(payloads, counts, strict=True)), np.uint8)
    header, frames = mjpeg.frame_header(SIDE, SIDE), []
    for at in range(0, len(raw), BLOCK * size):
        values = raw[at : at + BLOCK * size].astype(np.int16) - 128  # what fills the last frame up is zero
        frames += [header + data + b"\xff\xd9" for data in mjpeg.encode_frames(values.reshape(-1, UNITS * 3, 64))]
    ends = np.cumsum(counts).tolist()
    return [
        mjpeg.write_avi(frames[end - n : end], SIDE, SIDE, MICROS, b"bytes=%d payload=%d" % (len(t), len(p)))
        for t, p, n, end in zip(texts, payloads, counts, ends, strict=True)
    ]


def store(docs: DataFrame) -> DataFrame:
    """``doc_id, media``: the movie of each whole text in UTF-8, spaces appended to a positive multiple of 192 bytes.

    Null texts are empty; repeated rows give repeated rows, an empty table none; other columns are ignored. No shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, 1, BATCH_BYTES):
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(movies(texts), pa.binary())], ["doc_id", "media"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).transform(mapped(run, "doc_id long, media binary"))


class Films:
    """Frames of some files, decoded: for each file its headers, histograms, coefficients as bytes where asked for, and clips."""

    def __init__(self, files: list[bytes], payload: bool):
        self.heads = [mjpeg.read_avi(f) for f in files]
        counts = np.array([len(h.places) for h in self.heads], np.int64)
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        places = [(i, at, n) for i, h in enumerate(self.heads) for at, n in h.places]
        self.histograms = np.zeros((len(places), 0), np.int64)
        pieces: list[bytes] = []
        for a in range(0, len(places), BLOCK):
            frames = mjpeg.decode_frames([files[i][at : at + n] for i, at, n in places[a : a + BLOCK]])
            found = self._histograms(frames)
            if a == 0:
                self.histograms = np.zeros((len(places), found.shape[1]), np.int64)
            if found.shape[1] > self.histograms.shape[1]:
                self.histograms = np.pad(self.histograms, ((0, 0), (0, found.shape[1] - self.histograms.shape[1])))
            self.histograms[a : a + len(frames), : found.shape[1]] = found
            if payload:
                pieces += [(blocks + 128).astype(np.uint8).tobytes() for _, blocks in frames]
        self.pieces = pieces

    @staticmethod
    def _histograms(frames: list[tuple[mjpeg.Layout, np.ndarray]]) -> np.ndarray:
        """Samples of each frame by component and step."""
        most = max(max(layout.unit) + 1 for layout, _ in frames)
        out = np.zeros((len(frames), most * BINS), np.int64)
        alike: dict[mjpeg.Layout, list[int]] = {}
        for i, (layout, _) in enumerate(frames):
            alike.setdefault(layout, []).append(i)
        for layout, own in alike.items():
            blocks = np.stack([frames[i][1] for i in own])
            part = np.tile(np.array(layout.unit), blocks.shape[1] // len(layout.unit))
            values = mjpeg.samples((blocks * np.array(layout.quantisers)[part]).reshape(-1, 64))
            cell = (np.arange(len(own))[:, None] * most + part).ravel()[:, None] * BINS + (values >> 4)
            out[own] = np.bincount(cell.ravel(), minlength=len(own) * most * BINS).reshape(len(own), -1)
        return out

    def clips(self) -> list[list[tuple[int, int, int]]]:
        """For each file (first frame, last frame, change at the start) of its clips, one after another.

        A frame starts a clip where its change from the frame before is larger than a sixteenth of the samples, not exceeded by
        its neighbours', and more than 1.5 times the mean change of the frames around it. All in whole numbers.
        """
        n = len(self.histograms)
        change = np.zeros(n, np.int64)
        change[1:] = np.abs(np.diff(self.histograms, axis=0)).sum(axis=1) // 2
        first = np.repeat(self.starts, self.ends - self.starts)
        after = np.repeat(self.ends, self.ends - self.starts)
        at = np.arange(n)
        change[at == first] = 0
        low, high = np.maximum(first + 1, at - AROUND), np.minimum(after, at + AROUND + 1)
        total = np.concatenate([[0], np.cumsum(change)])
        around, others = total[high] - total[np.minimum(low, high)] - change, high - low - 1
        size = self.histograms.sum(axis=1)
        beside = np.maximum(np.concatenate([[0], change[:-1]]), np.concatenate([change[1:], [0]])[:n]) if n else change
        cut = (at > first) & (16 * change > size) & (change >= beside) & (2 * change * others > HALVES * around)
        cut |= at == first
        out = []
        for a, b in zip(self.starts.tolist(), self.ends.tolist(), strict=True):
            begins = (np.flatnonzero(cut[a:b]) + a).tolist()
            out.append([(x - a, y - a - 1, int(change[x])) for x, y in zip(begins, [*begins[1:], b], strict=True)])
        return out


def clips(media: DataFrame) -> DataFrame:
    """``doc_id, clip, first_frame, last_frame, start_ms, end_ms, change``: the shots of each movie (doc_id, media), from 0.

    Movies are motion-JPEG AVI files of baseline frames, with any sampling, restarts and code tables; others raise
    ``FormatError``. Null movies and movies without frames have no clips; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), *[pa.int64()] * 5]
        for batch in chunks(batches, 1, BATCH_BYTES):
            own = np.flatnonzero(batch.column(1).is_valid().to_numpy(zero_copy_only=False))
            films = Films(batch.column(1).take(pa.array(own)).to_pylist(), payload=False)
            rows, source = [], []
            for i, head, found in zip(own.tolist(), films.heads, films.clips(), strict=True):
                for k, (a, b, change) in enumerate(found):
                    rows.append((k, a, b, a * head.micros // 1000, (b + 1) * head.micros // 1000, change))
                    source.append(i)
            columns = list(zip(*rows, strict=True)) or [()] * 6
            arrays = [batch.column(0).take(pa.array(source, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "clip", "first_frame", "last_frame", "start_ms", "end_ms", "change"])

    ddl = "doc_id long, clip int, first_frame long, last_frame long, start_ms long, end_ms long, change long"
    return media.select(F.col("doc_id").cast("long"), "media").transform(mapped(run, ddl))


def digests(media: DataFrame) -> DataFrame:
    """Of each movie that ``store`` made, all read back from it: sizes and digests of payload and file, and its clips.

    ``feature`` has the number of frames and the start of each clip in milliseconds.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        for batch in chunks(batches, 1, BATCH_BYTES):
            files = batch.column(1).to_pylist()
            films = Films(files, payload=True)
            rows = []
            for file, head, start, end, found in zip(files, films.heads, films.starts.tolist(), films.ends.tolist(), films.clips(), strict=True):
                n_bytes, stored = map(int, re.fullmatch(rb"bytes=(\d+) payload=(\d+)", head.comment).groups())
                payload = b"".join(films.pieces[start:end])[:stored]
                starts = ",".join(str(a * head.micros // 1000) for a, _, _ in found)
                rows.append(
                    (
                        n_bytes, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(file),
                        hashlib.sha256(file).hexdigest(), f"frames={end - start};clips={starts}",
                    )
                )
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["doc_id", *names])

    ddl = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string"
    return media.select("doc_id", "media").transform(mapped(run, ddl))
