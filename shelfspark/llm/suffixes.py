"""External suffix sorting by induction over disk-backed priority queues.

Suffix tuples (position, common prefix with the one before) leave a monotone priority queue: keys only
grow in the first pass and only fall in the second, so the queue is a row of first-in-first-out buckets by
leading symbol. What a queue holds beyond a bound goes to scratch files. A tuple's common prefix is
induced from those of the tuples scanned since the last one of its symbol, so no two suffixes are
compared but where a bucket's two kinds meet.

One induction sorts the leftmost-S substrings; there the common prefix only tells whether two are
equal, which names them. Where names repeat, the string of names is sorted by the same procedure, down to
strings that fit in memory, whose ranks are doubled. A second induction sorts all suffixes and
gives them with their common prefixes, up to a cap.
"""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow.fs as pafs

#: Bytes of suffix tuples that each queue or series holds in memory before it goes to scratch files.
MEMORY_BYTES = 4 << 20

#: Names that are ranked in memory; longer strings of names are sorted externally in their turn.
BASE_NAMES = 1 << 21

#: Tuples that one vectorised step takes.
BLOCK = 1 << 16

#: Stands for "equal" while names are given.
_EQUAL = 1 << 28


class Scratch:
    """Arrays in a folder of their own, removed at the end. ``folder``: shared storage; without one, as in tests, local."""

    def __init__(self, folder: str | None = None):
        self.own = None
        if folder is None:
            folder = self.own = tempfile.mkdtemp()
        self.fs, path = pafs.FileSystem.from_uri(folder) if ":" in folder else (pafs.LocalFileSystem(), folder)
        self.path = f"{path}/scratch-{uuid.uuid4().hex}"
        self.files = 0

    def put(self, values: np.ndarray) -> str:
        if not self.files:
            self.fs.create_dir(self.path)
        self.files += 1
        path = f"{self.path}/{self.files}"
        with self.fs.open_output_stream(path) as out:
            out.write(np.ascontiguousarray(values).tobytes())
        return path

    def get(self, path: str, start: int, n: int, kind: type = np.int64) -> np.ndarray:
        size = np.dtype(kind).itemsize
        with self.fs.open_input_file(path) as f:
            return np.frombuffer(f.read_at(size * n, size * start), kind)

    def close(self) -> None:
        if self.files:
            self.fs.delete_dir(self.path)
        if self.own:
            shutil.rmtree(self.own)


class BucketQueue:
    """A priority queue of (position, prefix) tuples by leading symbol, in order of arrival within a symbol."""

    def __init__(self, scratch: Scratch, memory: int):
        self.parts: dict[int, list[np.ndarray | tuple[str, int, int]]] = {}
        self.scratch, self.memory, self.held = scratch, memory, 0

    def push(self, leading: np.ndarray, tuples: np.ndarray) -> None:
        """Adds rows of ``tuples`` (n x 2)."""
        if not len(leading):
            return
        order = np.argsort(leading, kind="stable")
        self.push_sorted(leading[order], tuples[order])

    def push_sorted(self, by: np.ndarray, rows: np.ndarray) -> None:
        """Adds tuples whose leading symbols ``by`` rise."""
        cuts = [0, *(np.flatnonzero(np.diff(by)) + 1).tolist(), len(by)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            self.parts.setdefault(int(by[a]), []).append(rows[a:b])
        self.held += rows.nbytes
        if self.held > self.memory:
            self._spill()

    def _spill(self) -> None:
        # What a bucket holds in memory is its end: it becomes one part of one file.
        ends = {c: [x for x in part if isinstance(x, np.ndarray)] for c, part in self.parts.items()}
        path, at = self.scratch.put(np.concatenate([x for own in ends.values() for x in own])), 0
        for c, own in ends.items():
            if own:
                n = sum(map(len, own))
                self.parts[c][-len(own) :] = [(path, at, n)]
                at += n
        self.held = 0

    def pop(self, symbol: int, falling: bool = False) -> Iterator[np.ndarray]:
        """Blocks of all tuples of a symbol that have arrived since the last call, in order (or ``falling``)."""
        parts = self.parts.pop(symbol, [])
        own = [x for x in parts if isinstance(x, np.ndarray)]
        self.held -= sum(x.nbytes for x in own)
        pieces: list[np.ndarray | tuple[str, int, int]] = [x for x in parts if not isinstance(x, np.ndarray)]
        if own:
            pieces.append(np.concatenate(own) if len(own) > 1 else own[0])
        for piece in reversed(pieces) if falling else pieces:
            n = len(piece) if isinstance(piece, np.ndarray) else piece[2]
            starts = range(0, n, BLOCK)
            for a in reversed(starts) if falling else starts:
                m = min(BLOCK, n - a)
                if isinstance(piece, np.ndarray):
                    block = piece[a : a + m]
                else:
                    block = self.scratch.get(piece[0], 2 * (piece[1] + a), 2 * m).reshape(-1, 2)
                yield block[::-1] if falling else block

    def symbols(self) -> list[int]:
        return sorted(self.parts)


class Series:
    """A growing row of int64 values, in memory up to a bound."""

    def __init__(self, scratch: Scratch, memory: int):
        self.queue = BucketQueue(scratch, memory)
        self.n = 0

    def append(self, values: np.ndarray) -> None:
        pairs = np.zeros((len(values), 2), np.int64)
        pairs[:, 0] = values
        self.queue.push(np.zeros(len(values), np.int64), pairs)
        self.n += len(values)

    def drain(self, falling: bool = False) -> Iterator[np.ndarray]:
        """All values once, block by block."""
        for block in self.queue.pop(0, falling):
            yield block[:, 0]


class Text:
    """A string of symbols: an array, or pieces in scratch files of which the last few read are kept."""

    PIECE = 1 << 18

    def __init__(self, values: np.ndarray | None, scratch: Scratch | None = None, kind: type = np.int64):
        self.values, self.scratch, self.kind = values, scratch, kind
        self.n = 0 if values is None else len(values)
        self.paths: list[str] = []
        self.kept: dict[int, np.ndarray] = {}

    @staticmethod
    def stored(blocks: Iterable[np.ndarray], scratch: Scratch, kind: type = np.int64) -> Text:
        out, rest = Text(None, scratch, kind), np.zeros(0, kind)
        for block in blocks:
            rest = np.concatenate([rest, block.astype(kind)])
            whole = len(rest) // Text.PIECE * Text.PIECE
            for a in range(0, whole, Text.PIECE):
                out.paths.append(scratch.put(rest[a : a + Text.PIECE]))
            out.n += whole
            rest = rest[whole:]
        if len(rest):
            out.paths.append(scratch.put(rest))
            out.n += len(rest)
        return out

    def _piece(self, k: int) -> np.ndarray:
        if k not in self.kept:
            if len(self.kept) >= 8:
                self.kept.pop(next(iter(self.kept)))
            self.kept[k] = self.scratch.get(self.paths[k], 0, min(Text.PIECE, self.n - k * Text.PIECE), self.kind)
        return self.kept[k]

    def at(self, positions: np.ndarray) -> np.ndarray:
        if self.values is not None:
            return self.values[positions]
        out = np.empty(len(positions), self.kind)
        piece = positions // Text.PIECE
        for k in np.unique(piece).tolist():
            own = piece == k
            out[own] = self._piece(k)[positions[own] - k * Text.PIECE]
        return out

    def blocks(self) -> Iterator[tuple[int, np.ndarray]]:
        """(start, values with the one after) from the end to the start."""
        for a in reversed(range(0, self.n, BLOCK)):
            yield a, self.at(np.arange(a, min(self.n, a + BLOCK + 1)))


class _Minima:
    """Least common prefix over what has been scanned since the last push of each symbol.

    Scanned prefixes are kept as the falling minima seen from the end: as many as there are unlike values.
    """

    def __init__(self, symbols: int, cap: int):
        self.last = np.full(symbols, -1, np.int64)
        self.at, self.least = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.count, self.cap = 0, cap

    def step(self, g: np.ndarray, i: np.ndarray, c: np.ndarray) -> np.ndarray:
        """Takes a block of scanned prefixes ``g``; gives those of the tuples pushed from places ``i`` to symbols ``c``, sorted by (c, i)."""
        found = np.zeros(len(i), np.int64)
        if len(i):
            fresh = np.ones(len(c), bool)
            fresh[1:] = c[1:] != c[:-1]
            low = np.zeros(len(c), np.int64)
            low[1:] = i[:-1] + 1
            low[fresh] = 0
            found = _range_minima(g, low, i + 1)
            q = self.last[c[fresh]]
            if len(self.at):
                k = np.searchsorted(self.at, q, side="right")
                before = np.append(self.least, self.cap)[k]
                found[fresh] = np.minimum(found[fresh], before)
            found = np.minimum(found + 1, self.cap)
            found[np.flatnonzero(fresh)[q < 0]] = 0
            ends = np.append(np.flatnonzero(fresh)[1:] - 1, len(c) - 1)
            self.last[c[ends]] = self.count + i[ends]
        falling = np.minimum.accumulate(g[::-1])[::-1]
        new = np.ones(len(g), bool)
        new[:-1] = falling[:-1] < falling[1:]
        keep = self.least < falling[0]
        self.at = np.concatenate([self.at[keep], self.count + np.flatnonzero(new)])
        self.least = np.concatenate([self.least[keep], falling[new]])
        self.count += len(g)
        return found


def _range_minima(g: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """min(g[low:high]) of ranges that hold one element at least."""
    width = (high - low).astype(np.int64)
    level = np.frexp(width.astype(float))[1] - 1
    out = np.empty(len(low), np.int64)
    table, span = g, 1
    for k in range(int(level.max()) + 1):
        own = level == k
        if own.any():
            out[own] = np.minimum(table[low[own]], table[high[own] - span])
        if 2 * span <= len(g):
            table = np.minimum(table[:-span], table[span:])
        span *= 2
    return out


def _common(text: Text, a: np.ndarray, b: np.ndarray, cap: int) -> np.ndarray:
    """Common prefixes, ``cap`` at most, of the suffixes at ``a`` and ``b``."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for _ in range(cap):
        x, y = a[live] + out[live], b[live] + out[live]
        inside = (x < text.n) & (y < text.n)
        live, x, y = live[inside], x[inside], y[inside]
        same = text.at(x) == text.at(y)
        live = live[same]
        if not len(live):
            break
        out[live] += 1
    return out


class _Induction:
    """Both passes over one string. ``cap`` > 0: common prefixes up to it; 0: only "equal" or not, to give names."""

    def __init__(self, text: Text, symbols: int, cap: int, scratch: Scratch, memory: int):
        self.text, self.symbols, self.cap = text, symbols, cap
        self.kind = np.int16 if symbols < 1 << 15 else np.int64  # short keys are sorted by radix
        self.seeds = BucketQueue(scratch, memory)
        self.queue = BucketQueue(scratch, memory)
        self.large, self.small = BucketQueue(scratch, memory), BucketQueue(scratch, memory)

    def seed(self, positions: np.ndarray, g: np.ndarray) -> None:
        self.seeds.push(self.text.at(positions), np.stack([positions, g], axis=1))

    def _scan(self, minima: _Minima, block: np.ndarray, test) -> tuple[np.ndarray, np.ndarray]:
        """Pushes what a block induces; gives its positions and the symbols before them (-1 for none)."""
        p = block[:, 0]
        before = np.where(p > 0, self.text.at(np.maximum(p, 1) - 1).astype(self.kind), self.kind(-1))
        sources = np.flatnonzero((p > 0) & test(before))
        sources = sources[np.argsort(before[sources], kind="stable")]
        g = minima.step(block[:, 1], sources, before[sources])
        if len(sources):
            self.queue.push_sorted(before[sources], np.stack([p[sources] - 1, g], axis=1))
        return p, before

    def _seam(self, above: int, below: int) -> int:
        """Common prefix where a bucket's L-type suffixes end and its S-type ones begin."""
        return int(_common(self.text, np.array([above]), np.array([below]), self.cap)[0]) if self.cap else 1

    def rising(self) -> None:
        """Sorts L-type suffixes."""
        minima = _Minima(self.symbols, self.cap or _EQUAL)
        for c in self._all():
            last = -1
            while self.queue.parts.get(c):
                for block in list(self.queue.pop(c)):
                    self.large.push(np.full(len(block), c), block)
                    self._scan(minima, block, lambda x: x >= c)  # noqa: B023
                    last = int(block[-1, 0])
            for i, block in enumerate(self.seeds.pop(c)):
                if i == 0:
                    block = block.copy()
                    block[0, 1] = self._seam(last, int(block[0, 0])) if last >= 0 else 0
                self._scan(minima, block, lambda x: x > c)  # noqa: B023

    def falling(self, names=None) -> None:
        """Sorts S-type suffixes; ``names`` takes leftmost S-type positions, the largest first, and prefixes before each."""
        minima = _Minima(self.symbols, self.cap or _EQUAL)
        self.queue.push(self.text.at(np.array([self.text.n - 1])), np.array([[self.text.n - 1, 0]]))
        carry = 0
        for c in self._all(falling=True):
            last = -1
            while self.queue.parts.get(c):
                for block in list(self.queue.pop(c)):
                    self.small.push(np.full(len(block), c), block)
                    p, before = self._scan(minima, block, lambda x: x <= c)  # noqa: B023
                    last = int(p[-1])
                    if names is not None:
                        carry = names(p, block[:, 1], before > c, carry)
            first = True
            for block in self.large_of(c):
                # Reversed: each tuple's prefix is with the one scanned after it.
                scanned = block.copy()
                scanned[1:, 1] = block[:-1, 1]
                if first:
                    scanned[0, 1] = self._seam(int(block[0, 0]), last) if last >= 0 else 0
                else:
                    scanned[0, 1] = ahead
                ahead, first, carry = int(block[-1, 1]), False, 0
                self._scan(minima, scanned, lambda x: x < c)  # noqa: B023
            carry = 0

    def large_of(self, c: int) -> Iterator[np.ndarray]:
        """A bucket's L-type suffixes from the largest down; they stay for the output."""
        parts = self.large.parts.get(c)
        if parts:
            kept = list(parts)
            yield from self.large.pop(c, falling=True)
            self.large.parts[c] = kept
            self.large.held += sum(x.nbytes for x in kept if isinstance(x, np.ndarray))

    def _all(self, falling: bool = False) -> Iterator[int]:
        """Symbols in order, as queues come to hold them."""
        if self.symbols <= 1 << 16:
            yield from range(self.symbols - 1, -1, -1) if falling else range(self.symbols)
            return
        present = np.zeros(self.symbols, bool)
        for _, block in self.text.blocks():
            present[block] = True
        found = np.flatnonzero(present)
        yield from (found[::-1] if falling else found).tolist()

    def ordered(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, common prefixes with the suffix before) in order."""
        for c in self._all():
            last = -1
            for block in self.large.pop(c):
                yield block[:, 0], block[:, 1]
                last = int(block[-1, 0])
            held: tuple[np.ndarray, np.ndarray] | None = None
            for block in self.small.pop(c, falling=True):
                g = np.empty(len(block), np.int64)
                g[1:] = block[:-1, 1]
                g[0] = self._seam(last, int(block[0, 0])) if held is None and last >= 0 else 0 if held is None else held[1]
                held = (block[:, 0], block[-1, 1])
                yield block[:, 0], g


def _leftmost(text: Text) -> Iterator[np.ndarray]:
    """Leftmost S-type positions from the end to the start."""
    small_after = True
    for start, block in text.blocks():
        values, at_end = block.astype(np.int64), start + BLOCK >= text.n
        if at_end:
            values = np.append(values, -1)  # so that the last symbol has one after it
        step = np.sign(np.diff(values))
        n = len(step)
        if at_end:
            step[-1] = 1
        at = np.where(step != 0, np.arange(n), n)
        following = np.minimum.accumulate(at[::-1])[::-1]
        small = np.where(following < n, step[np.minimum(following, n - 1)] > 0, small_after)
        before = text.at(np.array([start - 1]))[0] if start else -1
        bigger = np.append(before, values[: n - 1]) > values[:n]
        # A larger symbol before makes that one L-type.
        found = np.flatnonzero(small & bigger & (np.arange(start, start + n) > 0))
        yield found[::-1] + start
        small_after = bool(small[0])


def _rank(names: np.ndarray) -> np.ndarray:
    """Suffix order of a string of names in memory, by doubling ranks."""
    rank, k, n = names.astype(np.int64) + 1, 1, len(names)
    while True:
        second = np.zeros(n, np.int64)
        second[:-k] = rank[k:]
        key = rank * (n + 2) + second
        order = np.argsort(key, kind="stable")
        new = np.concatenate([[1], 1 + np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = new
        k *= 2
        if new[-1] == n or k >= n:
            return order


def _by_position(pairs: Iterator[tuple[np.ndarray, np.ndarray]], n: int, scratch: Scratch, memory: int) -> Iterator[np.ndarray]:
    """The second values of (position, value) blocks in order of position, range by range."""
    width = max(1, memory // 16)
    ranges = BucketQueue(scratch, memory)
    for positions, values in pairs:
        ranges.push(positions // width, np.stack([positions, values], axis=1))
    for k in ranges.symbols():
        rows = np.concatenate(list(ranges.pop(k)))
        yield rows[np.argsort(rows[:, 0]), 1]


def _seed_order(text: Text, symbols: int, scratch: Scratch, memory: int, base: int) -> Iterator[np.ndarray]:
    """Leftmost S-type positions in suffix order, block by block."""
    naming = _Induction(text, symbols, 0, scratch, memory)
    places = Series(scratch, memory)  # from the end to the start
    for found in _leftmost(text):
        places.append(found)
        naming.seed(found, np.full(len(found), _EQUAL))
    naming.rising()
    ordered, differ = Series(scratch, memory), Series(scratch, memory)  # the largest substring first

    def name(p: np.ndarray, g: np.ndarray, is_seed: np.ndarray, carry: int) -> int:
        j = np.flatnonzero(is_seed)
        if len(j):
            least = np.minimum.reduceat(g[: j[-1] + 1], np.concatenate([[0], j[:-1] + 1]))
            least[0] = min(least[0], carry)
            ordered.append(p[j])
            differ.append((least < _EQUAL).astype(np.int64))
            tail = g[j[-1] + 1 :]
            return int(tail.min(initial=_EQUAL))
        return min(carry, int(g.min()))

    naming.falling(name)
    n = places.n
    positions = list(ordered.drain())
    marks = list(differ.drain())
    total = int(sum(int(m.sum()) for m in marks))
    if total == n:
        yield from (p[::-1] for p in reversed(positions))
        return
    named, at = [], total
    for m in marks:
        names = at - np.cumsum(m)
        named.append(names)
        at = int(names[-1])
    del naming
    reduced = _by_position(zip(positions, named, strict=True), text.n, scratch, memory)
    if n <= base:
        order = _rank(np.concatenate(list(reduced)))
        where = np.concatenate(list(places.drain()))[::-1]
        for a in range(0, n, BLOCK):
            yield where[order[a : a + BLOCK]]
        return
    shorter = Text.stored(reduced, scratch)
    where = Text.stored(places.drain(falling=True), scratch)
    for order, _ in suffixes(shorter, total, 0, scratch, memory, base):
        yield where.at(order)


def suffixes(
    text: Text, symbols: int, cap: int, scratch: Scratch, memory: int = MEMORY_BYTES, base: int = BASE_NAMES
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All suffixes in order as blocks of (positions, common prefixes with the suffix before, ``cap`` at most).

    The last symbol must be 0 and stand nowhere else. ``cap`` 0: the order alone.
    """
    if text.n == 1:
        yield np.zeros(1, np.int64), np.zeros(1, np.int64)
        return
    final = _Induction(text, symbols, max(cap, 1), scratch, memory)
    last = -1
    for seeds in _seed_order(text, symbols, scratch, memory, base):
        g = np.zeros(len(seeds), np.int64)
        if cap:
            g[1:] = _common(text, seeds[:-1], seeds[1:], cap)
            if last >= 0:
                g[0] = _common(text, np.array([last]), seeds[:1], cap)[0]
        last = int(seeds[-1])
        final.seed(seeds, g)
    final.rising()
    final.falling()
    yield from final.ordered()


def suffix_array(s: np.ndarray, symbols: int, memory: int = MEMORY_BYTES, base: int = BASE_NAMES) -> np.ndarray:
    """Suffix array of ``s``: values below ``symbols``, the last one 0 and nowhere else."""
    scratch = Scratch()
    try:
        return np.concatenate([p for p, _ in suffixes(Text(s), symbols, 0, scratch, memory, base)])
    finally:
        scratch.close()


class Shard:
    """Texts with their owners, in order, and the strings that repeat among them.

    Texts are joined by separators. Beyond ``memory`` bytes they go to scratch files in ``folder``; three numbers a text
    and a bit a byte stay in memory.
    """

    def __init__(self, length: int, folder: str | None = None, memory: int = 1 << 24, tuples: int = MEMORY_BYTES, base: int = BASE_NAMES):
        self.length, self.folder, self.memory, self.tuples, self.base = length, folder, memory, tuples, base
        self.owners: list[tuple[int, int]] = []
        self.sizes: list[int] = []
        self.held: list[bytes] = []
        self.size = 0
        self.scratch: Scratch | None = None
        self.stored: list[str] = []

    def add(self, owner: tuple[int, int], text: bytes) -> None:
        self.owners.append(owner)
        self.sizes.append(len(text))
        self.held.append(text)
        self.size += len(text) + 1
        if self.size > self.memory * (len(self.stored) + 1):
            self.scratch = self.scratch or Scratch(self.folder)
            self.stored.append(self.scratch.put(self._symbols()))

    def _symbols(self) -> np.ndarray:
        """What is held, as symbols: a separator is 1, a byte its value and 2."""
        sizes = np.array([len(t) for t in self.held], np.int64)
        out = np.frombuffer(b"\0".join(self.held) + b"\0", np.uint8).astype(np.uint16) + 2
        out[np.cumsum(sizes + 1) - 1] = 1
        self.held = []
        return out

    def _text(self) -> Text:
        end = np.zeros(1, np.uint16)
        if not self.stored:
            return Text(np.append(self._symbols(), end))
        kept = self.stored

        def blocks() -> Iterator[np.ndarray]:
            for path in kept:
                with self.scratch.fs.open_input_file(path) as f:
                    yield np.frombuffer(f.read(), np.uint16)
            if self.held:
                yield self._symbols()
            yield end

        return Text.stored(blocks(), self.scratch, np.uint16)

    def repeats(self) -> Iterator[tuple[tuple[int, int], np.ndarray]]:
        """(owner, starts) of texts with ``length``-byte strings that also start earlier, in an earlier text or place.

        Suffixes that follow each other with a common prefix of ``length`` or more share a string; all but the first
        place of each class are repeats.
        """
        self.scratch = self.scratch or Scratch(self.folder)
        sizes = np.array(self.sizes, np.int64)
        ends = np.cumsum(sizes + 1) - 1
        again = np.zeros(self.size + 1, bool)
        first = -1  # least place of the class that the last block ended in
        try:
            for order, common in suffixes(self._text(), 258, self.length, self.scratch, self.tuples, self.base):
                at = np.searchsorted(ends, order, side="left")
                whole = at < len(ends)
                whole[whole] = order[whole] + self.length <= ends[at[whole]]
                # What parts two whole strings is the least prefix from one to the other.
                group = np.cumsum(common < self.length)
                total, group, order = group[-1], group[whole], order[whole]
                if not len(order):
                    first = -1 if total else first
                    continue
                begin = np.concatenate([[0], np.flatnonzero(np.diff(group)) + 1])
                least = np.minimum.reduceat(order, begin)
                again[order] = True
                if group[0] == 0 and first >= 0:
                    again[max(first, least[0])] = True
                    least[0] = min(first, least[0])
                again[least] = False
                first = int(least[-1]) if group[-1] == total else -1
        finally:
            self.scratch.close()
        found = np.flatnonzero(again)
        of = np.searchsorted(ends, found, side="left")
        if not len(of):
            return
        begin = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1])
        for a, b in zip(begin, [*begin[1:], len(of)], strict=True):
            k = of[a]
            yield self.owners[k], found[a:b] - (ends[k] - sizes[k])


def repeats(texts: list[bytes], length: int, memory: int = MEMORY_BYTES, base: int = BASE_NAMES, held: int = 1 << 24) -> list[np.ndarray]:
    """For each text, the starts of ``length``-byte strings that also start earlier; scratch files are local, as in tests."""
    shard = Shard(length, None, held, memory, base)
    for i, t in enumerate(texts):
        shard.add((i, 0), t)
    found = {owner[0]: starts for owner, starts in shard.repeats()} if texts else {}
    return [found.get(i, np.zeros(0, np.int64)) for i in range(len(texts))]
