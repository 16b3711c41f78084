"""Baseline JPEG frames in AVI files, coded and decoded many frames at a time.

A frame's entropy-coded data can only be read from its start, but frames (and restart intervals) are independent. The decoder
thus walks all of them in lockstep: each step reads one symbol of every interval through tables. Blocks keep
their coefficients in zigzag order. The inverse transform works on whole numbers, so its result doesn't depend
on how many blocks are transformed at once.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np

# The code tables that frames in AVI files are read with where they bring none (numbers of codes by length, symbols).
DC_BITS = (0, 1, 5, 1, 1, 1, 1, 1, 1, 0, 0, 0, 0, 0, 0, 0)
DC_SYMBOLS = bytes(range(12))
AC_BITS = (0, 2, 1, 3, 3, 2, 4, 3, 5, 5, 4, 4, 0, 0, 1, 125)
AC_SYMBOLS = bytes.fromhex(
    "01020300041105122131410613516107227114328191a1082342b1c11552d1f02433627282090a161718191a25262728292a3435363738393a43444546474849"
    "4a535455565758595a636465666768696a737475767778797a838485868788898a92939495969798999aa2a3a4a5a6a7a8a9aab2b3b4b5b6b7b8b9bac2c3c4"
    "c5c6c7c8c9cad2d3d4d5d6d7d8d9dae1e2e3e4e5e6e7e8e9eaf1f2f3f4f5f6f7f8f9fa"
)

#: Bits after which a fraction of the transform's whole numbers starts.
_SCALE = 13


class FormatError(ValueError):
    """A file that isn't a motion-JPEG AVI, or holds frames of another kind than baseline JPEG."""


def zigzag() -> np.ndarray:
    """Place in a block, row by row, of each coefficient of the zigzag order."""
    cells = sorted(((r, c) for r in range(8) for c in range(8)), key=lambda x: (x[0] + x[1], x[0] if (x[0] + x[1]) % 2 else x[1]))
    return np.array([r * 8 + c for r, c in cells])


@lru_cache(maxsize=1)
def _transform() -> np.ndarray:
    """Whole-number matrix from zigzag coefficients to the 64 samples of a block, 2^13 times the inverse cosine transform."""
    k, x = np.meshgrid(np.arange(8), np.arange(8))
    one = np.where(k == 0, np.sqrt(0.125), 0.5) * np.cos((2 * x + 1) * k * np.pi / 16)
    return np.rint(np.kron(one, one)[:, zigzag()].T * (1 << _SCALE))


def samples(coefficients: np.ndarray) -> np.ndarray:
    """8-bit samples (n, 64) of dequantised blocks (n, 64); sums stay below 2^53 and are thus exact."""
    out = coefficients.astype(float) @ _transform()
    out = np.floor(out * 2.0**-_SCALE + 128.5)
    return np.clip(out, 0, 255).astype(np.uint8)


def code_words(bits: tuple[int, ...], symbols: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Code and length by symbol."""
    words, lengths, code, at = np.zeros(256, np.uint64), np.zeros(256, np.uint64), 0, 0
    for length, n in enumerate(bits, 1):
        for s in symbols[at : at + n]:
            words[s], lengths[s], code = code, length, code + 1
        code, at = code << 1, at + n
    return words, lengths


@lru_cache(maxsize=64)
def _lookup(bits: tuple[int, ...], symbols: bytes, dc: bool) -> np.ndarray:
    """By the next 16 bits: length of the code, size of the value (5 bits up), coefficients passed over (9 bits up); 0 where there is no code."""
    table, at = np.zeros(1 << 16, np.int64), 0
    words, lengths = code_words(bits, symbols)
    for s in symbols[: sum(bits)]:
        length, size, run = int(lengths[s]), s & 15, 0 if dc else s >> 4
        if not dc and s == 0:
            run = 64  # the rest of the block is zero
        at = int(words[s]) << (16 - length)
        table[at : at + (1 << (16 - length))] = length | size << 5 | run << 9
    return table


# ---------------------------------------------------------------- writing


#: Coefficients lie within this of zero.
_REACH = 2048


@lru_cache(maxsize=1)
def _written() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bits and lengths of a first coefficient's code and value, and of others' by zeros before (times 2 * _REACH) and value."""
    value = np.arange(-_REACH, _REACH)
    size = np.frexp(np.abs(value).astype(float))[1].astype(np.uint64)
    extra = (value + np.where(value < 0, (1 << size.astype(np.int64)) - 1, 0)).astype(np.uint64)
    words, lengths = code_words(DC_BITS, DC_SYMBOLS)
    dc, dc_lengths = words[size] << size | extra, (lengths[size] + size).astype(np.uint8)
    words, lengths = code_words(AC_BITS, AC_SYMBOLS)
    symbol = (np.arange(16)[:, None] << 4) | size.astype(np.int64)
    ac, ac_lengths = (np.where(value == 0, 0, c) for c in (words[symbol] << size | extra, lengths[symbol] + size))
    return dc, dc_lengths, ac.astype(np.uint64).ravel(), ac_lengths.astype(np.uint8).ravel()


def encode_frames(coefficients: np.ndarray) -> list[bytes]:
    """Entropy-coded data of frames (n, blocks, 64) of three components, one block each a unit, with the default tables."""
    frames, blocks, _ = coefficients.shape
    value = coefficients.astype(np.int32)
    # Each component's first coefficients are coded as differences.
    first = value[:, :, 0].reshape(frames, blocks // 3, 3)
    value[:, :, 0] = np.diff(first, axis=1, prepend=0).reshape(frames, blocks)
    value = value.reshape(-1, 64)
    dc, dc_lengths, ac, ac_lengths = _written()
    words, sizes = code_words(AC_BITS, AC_SYMBOLS)
    key = value + _REACH
    holes = np.flatnonzero((value[:, 1:] == 0).any(axis=1))
    run = np.zeros((len(holes), 64), np.int32)
    if len(holes):
        full = value[holes] != 0
        full[:, 0] = True
        before = np.maximum.accumulate(np.where(full, np.arange(64), 0), axis=1)
        run[:, 1:] = np.where(full[:, 1:], np.arange(63) - before[:, :-1], 0)
        key[holes] += (run & 15) * (2 * _REACH)
    # A place for each coefficient and one for what follows the block, its end and the frame's padding; an even number.
    bits, lengths = np.zeros((len(value), 66), np.uint64), np.zeros((len(value), 66), np.uint8)
    bits[:, :64], lengths[:, :64] = ac[key], ac_lengths[key]
    bits[:, 0], lengths[:, 0] = dc[value[:, 0] + _REACH], dc_lengths[value[:, 0] + _REACH]
    for row, k in zip(*np.nonzero(run > 15), strict=True):  # sixteen zeros at a time go ahead, in up to three codes
        for _ in range(int(run[row, k]) >> 4):
            bits[holes[row], k] |= words[0xF0] << np.uint64(lengths[holes[row], k])
            lengths[holes[row], k] += np.uint8(sizes[0xF0])
    if len(holes):
        ended = holes[before[:, 63] < 63]
        bits[ended, 64], lengths[ended, 64] = words[0], sizes[0]
    used = lengths.reshape(frames, -1).sum(axis=1, dtype=np.int64)
    pad = -used % 8
    last = np.arange(1, frames + 1) * blocks - 1
    bits[last, 64] = bits[last, 64] << pad.astype(np.uint64) | ((1 << pad) - 1).astype(np.uint64)
    lengths[last, 64] += pad.astype(np.uint8)
    bits, lengths = bits.ravel(), lengths.ravel()
    if lengths.max(initial=0) <= 32:  # two values at a time
        bits, lengths = bits[::2] << lengths[1::2].astype(np.uint64) | bits[1::2], lengths[::2] + lengths[1::2]
    packed = _pack_bits(bits, lengths).tobytes()
    ends = (np.cumsum(used + pad) // 8).tolist()
    return [packed[a:b].replace(b"\xff", b"\xff\x00") for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _pack_bits(bits: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bytes of the values' bits one after another; values of up to 64 bits, whole bytes in all."""
    own = np.flatnonzero(lengths)
    bits, lengths = bits[own], lengths[own]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    word, within = starts >> 6, (starts & 63).astype(np.uint8)
    total = int(ends[-1]) if len(ends) else 0
    out = np.zeros(total // 64 + 2, np.uint64)
    high = bits << (64 - lengths).astype(np.uint64)
    firsts = np.flatnonzero(np.diff(word, prepend=-1))
    if len(word):
        out[word[firsts]] = np.bitwise_or.reduceat(high >> within.astype(np.uint64), firsts)
    over = np.flatnonzero(within + lengths > 64)
    # One value at most runs over the end of a word.
    out[word[over] + 1] |= high[over] << (64 - within[over]).astype(np.uint64)
    return np.frombuffer(out.astype(">u8").tobytes(), np.uint8)[: total // 8]


def frame_header(width: int, height: int) -> bytes:
    """Up to the entropy-coded data: quantisation by one, three components of full size, default tables."""
    quantiser = b"\xff\xdb\x00\x43\x00" + b"\x01" * 64
    frame = b"\xff\xc0" + struct.pack(">HBHHB", 17, 8, height, width, 3) + b"".join(bytes((c, 0x11, 0)) for c in (1, 2, 3))
    scan = b"\xff\xda" + struct.pack(">HB", 12, 3) + b"".join(bytes((c, 0)) for c in (1, 2, 3)) + b"\x00\x3f\x00"
    return b"\xff\xd8" + quantiser + frame + scan


def _chunk(name: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return name + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)


def write_avi(frames: list[bytes], width: int, height: int, micros: int, comment: bytes) -> bytes:
    """A motion-JPEG AVI file of complete frames, ``micros`` microseconds each, with an index; ``comment`` goes to its information list."""
    n, largest = len(frames), max(map(len, frames), default=0)
    main = struct.pack("<14I", micros, 0, 0, 0x10, n, 0, 1, largest, width, height, 0, 0, 0, 0)
    stream = b"vidsMJPG" + struct.pack("<IHHIIIIIIIIHHHH", 0, 0, 0, 0, micros, 1_000_000, 0, n, largest, 0xFFFFFFFF, 0, 0, 0, width, height)
    form = struct.pack("<IiiHH4sIiiII", 40, width, height, 1, 24, b"MJPG", width * height * 3, 0, 0, 0, 0)
    head = _chunk(b"LIST", b"hdrl", _chunk(b"avih", main), _chunk(b"LIST", b"strl", _chunk(b"strh", stream), _chunk(b"strf", form)))
    movie = [_chunk(b"00dc", f) for f in frames]
    places = 4 + np.concatenate([[0], np.cumsum([len(m) for m in movie])])
    index = b"".join(b"00dc" + struct.pack("<III", 0x10, at, len(f)) for f, at in zip(frames, places.tolist(), strict=False))
    return _chunk(b"RIFF", b"AVI ", head, _chunk(b"LIST", b"INFO", _chunk(b"ICMT", comment)), _chunk(b"LIST", b"movi", *movie), _chunk(b"idx1", index))


# ---------------------------------------------------------------- reading


@dataclass
class Movie:
    """What a file's headers and index say; ``places`` are start and size of each video frame."""

    micros: int = 0
    width: int = 0
    height: int = 0
    comment: bytes = b""
    places: list[tuple[int, int]] = field(default_factory=list)


def _walk(data: bytes, start: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """Name, start and end of the chunks of a list."""
    while start + 8 <= end:
        name, size = data[start : start + 4], struct.unpack_from("<I", data, start + 4)[0]
        yield name, start + 8, min(start + 8 + size, end)
        start += 8 + size + size % 2


def read_avi(data: bytes) -> Movie:
    """Headers and frame places, by the index where there is one, else from the movie's chunks."""
    if data[:4] != b"RIFF" or data[8:12] != b"AVI ":
        raise FormatError("not an AVI file")
    out, movie, index, stream, number = Movie(), None, None, -1, 0
    lists = [(12, len(data))]
    while lists:
        for name, start, end in _walk(data, *lists.pop(0)):
            kind = data[start : start + 4] if name == b"LIST" else b""
            if kind == b"movi":
                movie = (start, end)
            elif name == b"LIST":
                lists.append((start + 4, end))
            elif name == b"avih":
                out.micros, out.width, out.height = struct.unpack_from("<I", data, start)[0], *struct.unpack_from("<II", data, start + 32)
            elif name == b"strh":
                if data[start : start + 4] == b"vids" and stream < 0:
                    stream = number
                    if data[start + 4 : start + 8].upper() not in (b"MJPG", b"\0\0\0\0"):
                        raise FormatError("video isn't motion-JPEG")
                number += 1
            elif name == b"ICMT":
                out.comment = data[start:end]
            elif name == b"idx1":
                index = (start, end)
    if movie is None or stream < 0:
        raise FormatError("no video stream")
    own = (b"%02ddc" % stream, b"%02ddb" % stream)
    if index is None:
        out.places = [(start, end - start) for name, start, end in _walk(data, movie[0] + 4, movie[1]) if name in own]
        return out
    entries = np.frombuffer(data, "<u4", (index[1] - index[0]) // 16 * 4, index[0]).reshape(-1, 4)
    compressed, plain = np.frombuffer(b"".join(own), "<u4")
    video = (entries[:, 0] == compressed) | (entries[:, 0] == plain)
    at, sizes = entries[video, 2].astype(np.int64), entries[video, 3].astype(np.int64)
    # Offsets count from the list's name, or in some files from the file's start.
    if len(at) and data[movie[0] + at[0] : movie[0] + at[0] + 4] in own:
        at = at + movie[0]
    if len(at) and (at + 8 + sizes > len(data)).any():
        raise FormatError("index points outside the file")
    out.places = list(zip((at + 8).tolist(), sizes.tolist(), strict=True))
    return out


@dataclass(frozen=True)
class Layout:
    """A frame's headers: block components of a unit, units, restart interval, quantisers and code tables by component."""

    width: int
    height: int
    unit: tuple[int, ...]
    units: int
    restart: int
    quantisers: tuple[tuple[int, ...], ...]
    tables: tuple[tuple[tuple[tuple[int, ...], bytes], tuple[tuple[int, ...], bytes]], ...]


@lru_cache(maxsize=256)
def _layout(header: bytes) -> Layout:
    """Layout of the bytes from a frame's start up to its entropy-coded data."""
    quantisers: dict[int, tuple[int, ...]] = {}
    codes: dict[int, tuple[tuple[int, ...], bytes]] = {0: (DC_BITS, DC_SYMBOLS), 16: (AC_BITS, AC_SYMBOLS)}
    at, restart, parts, width, height = 2, 0, [], 0, 0
    while at + 4 <= len(header):
        marker, size = header[at + 1], struct.unpack_from(">H", header, at + 2)[0]
        body = header[at + 4 : at + 2 + size]
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                n = 64 * (1 + wide)
                quantisers[body[0] & 15] = tuple(np.frombuffer(body[1 : 1 + n], ">u2" if wide else "u1").tolist())
                body = body[1 + n :]
        elif marker == 0xC4:
            while body:
                bits = tuple(body[1:17])
                codes[body[0]] = (bits, body[17 : 17 + sum(bits)])
                body = body[17 + sum(bits) :]
        elif marker == 0xDD:
            restart = struct.unpack(">H", body[:2])[0]
        elif marker == 0xC0:
            _, height, width, n = struct.unpack_from(">BHHB", body)
            parts = [(body[6 + 3 * i], body[7 + 3 * i] >> 4, body[7 + 3 * i] & 15, body[8 + 3 * i]) for i in range(n)]
        elif 0xC1 <= marker <= 0xCF:
            raise FormatError("frame isn't baseline JPEG")
        elif marker == 0xDA:
            chosen = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
            if not parts or len(chosen) != len(parts):
                raise FormatError("frame's components come in several scans")
            across, down = (1, 1) if len(parts) == 1 else (max(p[1] for p in parts), max(p[2] for p in parts))
            unit = (0,) if len(parts) == 1 else tuple(i for i, p in enumerate(parts) for _ in range(p[1] * p[2]))
            units = -(-width // (8 * across)) * -(-height // (8 * down))
            tables = tuple((codes.get(chosen[p[0]] >> 4, codes[0]), codes.get(16 + (chosen[p[0]] & 15), codes[16])) for p in parts)
            return Layout(width, height, unit, units, restart, tuple(quantisers[p[3]] for p in parts), tables)
        at += 2 + size
    raise FormatError("frame without a scan")


def _split(frame: bytes) -> tuple[Layout, bytes]:
    if frame[:2] != b"\xff\xd8":
        raise FormatError("not a JPEG frame")
    at = 2
    while at + 4 <= len(frame) and frame[at + 1] != 0xDA:
        at += 2 + struct.unpack_from(">H", frame, at + 2)[0]
    if at + 4 > len(frame):
        raise FormatError("frame without a scan")
    at += 2 + struct.unpack_from(">H", frame, at + 2)[0]
    return _layout(frame[:at]), frame[at:]


def _intervals(data: bytes, layout: Layout) -> list[bytes]:
    """Entropy-coded data between restarts, without what was put in after bytes of 255."""
    end = data.rfind(b"\xff\xd9")
    data = data[:end] if end >= 0 else data
    if not layout.restart:
        return [data.replace(b"\xff\x00", b"\xff")]
    pieces, start, at = [], 0, data.find(b"\xff")
    while at >= 0:
        if at + 1 < len(data) and 0xD0 <= data[at + 1] <= 0xD7:
            pieces.append(data[start:at])
            start = at + 2
        at = data.find(b"\xff", at + 2)
    return [p.replace(b"\xff\x00", b"\xff") for p in [*pieces, data[start:]]]


def decode_frames(frames: list[bytes]) -> list[tuple[Layout, np.ndarray]]:
    """Layout and quantised coefficients (blocks, 64), in zigzag order, of each frame."""
    out: list[tuple[Layout, np.ndarray] | None] = [None] * len(frames)
    alike: dict[Layout, list[tuple[int, list[bytes]]]] = {}
    for i, frame in enumerate(frames):
        layout, data = _split(frame)
        alike.setdefault(layout, []).append((i, _intervals(data, layout)))
    for layout, own in alike.items():
        each, b = layout.restart or layout.units, len(layout.unit)
        whole = -(-layout.units // each)
        if any(len(parts) != whole for _, parts in own):
            raise FormatError("frame with missing intervals")
        lanes = [p for _, parts in own for p in parts]
        counts = np.full(len(lanes), each)
        counts[whole - 1 :: whole] = layout.units - each * (whole - 1)
        blocks = _decode(lanes, counts * b, layout)  # lanes of equal length, some with unused ends
        for c in set(layout.unit):
            places = np.flatnonzero(np.array(layout.unit) == c)
            at = (np.arange(each)[:, None] * b + places).ravel()
            blocks[:, at, 0] = np.cumsum(blocks[:, at, 0], axis=1)
        blocks = blocks.reshape(len(own), -1, 64)
        keep = np.concatenate([np.arange(n * b) + i * each * b for i, n in enumerate(counts[:whole])])
        for (i, _), frame in zip(own, blocks[:, keep] if whole > 1 else blocks, strict=True):
            out[i] = (layout, frame)
    return out


def _decode(lanes: list[bytes], counts: np.ndarray, layout: Layout) -> np.ndarray:
    """Coefficients (lanes, most blocks, 64), first ones as differences."""
    most, unit = int(counts.max(initial=0)), np.array(layout.unit)
    out = np.zeros(len(lanes) * most * 64, np.int32)
    table = np.concatenate([_lookup(*t, dc) for dcs_acs in layout.tables for t, dc in zip(dcs_acs, (True, False), strict=True)])
    # Six bytes follow each lane, so that a window never meets the next one's codes as its own.
    raw = np.frombuffer(b"".join(x for lane in lanes for x in (lane, b"\xff" * 6)), np.uint8)
    sizes = np.array([len(x) for x in lanes], np.int64)
    starts = np.cumsum(sizes + 6) - sizes - 6
    window = np.zeros(len(raw), np.int64)
    for i in range(5):
        window[: len(raw) - i] |= raw[i:].astype(np.int64) << (32 - 8 * i)
    lane = np.arange(len(lanes))
    bit, stop = starts * 8, (starts + sizes) * 8
    block, k, base = np.zeros(len(lanes), np.int64), np.zeros(len(lanes), np.int64), lane * (most * 64)
    part = np.zeros(len(lanes), np.int64)
    mask = (1 << np.arange(17)) - 1
    lowest = np.concatenate([[0], 1 << np.arange(16)])
    tables = unit * 2 << 16
    alive = counts > 0
    while True:
        if not alive.all():
            lane, bit, block, k, base, part, stop = (c[alive] for c in (lane, bit, block, k, base, part, stop))
        if not len(lane):
            return out.reshape(len(lanes), most, 64)
        last = counts[lane]
        # As long as no lane can end, none is looked for: a block takes one step at least.
        for _ in range(int((last - block).min())):
            view = window.take(bit >> 3, mode="clip") << (bit & 7)
            entry = table.take(part | ((view >> 24) & 0xFFFF))
            length, size = entry & 31, (entry >> 5) & 15
            bit += length + size
            below = mask.take(size)
            value = (view >> (40 - length - size)) & below
            value -= np.where(value < lowest.take(size), below, 0)
            k += entry >> 9
            out[base + np.minimum(k, 63)] = value
            k += 1
            done = k > 63
            if done.any():
                block += done
                base += done * 64
                k[done] = 0
                part = tables[block % len(unit)] | (k > 0) << 16
            else:
                part |= 1 << 16
            if not length.all():
                raise FormatError("frame with an unknown code")
        if (bit > stop).any():
            raise FormatError("frame ends early")
        alive = block < last
