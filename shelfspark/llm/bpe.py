"""BPE encoding and decoding by prefix-sharing trie traversal.

The distinct words of a batch are walked as a trie in depth-first order (sorted words: each shares its
longest common prefix with the one before). A node's state is the last token of its prefix's encoding:
the one token that ends the prefix and may stand after the state of what is left of it. A state is
worked out when a token after it is tried. States on the shared path are kept, so a prefix is worked
out once at most; a word's tokens are read by stepping back from its final state. A token may stand
after another if no merge across their border comes before both are complete.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shelfspark.llm.util import chunks, mapped

#: Letters of the words that a generation of remembered words holds (two are kept, about 50 MB), and token pairs
#: kept with whether they may stand together (about 30 MB).
CACHE_LETTERS, CACHE_PAIRS = 900_000, 200_000

#: Bytes of the texts that share one walk.
WALK_BYTES = 2_000_000

_NEVER = 1 << 60

#: Letters at a text's end by which candidates are looked up, and the ends that each of two tables remembers (together about 12 MB).
_TAIL = 4
CACHE_ENDS = 30_000

#: In longer words states are worked out from the front, as each that is asked for may ask for one before it.
_DEEP = 200

#: The pattern whose matches are told by runs of characters of one class, and these classes.
_RUNS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_SPACE, _LETTER, _NUMBER, _OTHER = range(4)

#: Characters of words that aren't printable.
_CONTROL = regex.compile(r"[\x00-\x08\x0e-\x1f\x7f]")

#: Texts of characters below this one (Latin letters, nothing to compose) need no Unicode tables.
_PLAIN_BELOW = "\u0130"
_BEYOND = re.compile(f"[{_PLAIN_BELOW}-\U0010ffff]")


@contextmanager
def _no_cycles() -> Iterator[None]:
    """Without the search for cycles: nothing here makes any, and it would walk through all remembered words again and again."""
    on = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if on:
            gc.enable()


class TrieEncoder:
    """Encodes words of one BPE vocabulary with word ends (a ``tokenizers`` JSON file)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            text = f.read()
        spec = json.loads(text)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        self.ids: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: s for s, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: (left id, right id) -> rank; id -> its own merge.
        self.rank = {(self.ids[a], self.ids[b]): r for r, (a, b) in enumerate(pairs)}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for r, (a, b) in enumerate(pairs):
            self.parts.setdefault(self.ids[a + b], (self.ids[a], self.ids[b], r))
        self.inner = {s: i for s, i in self.ids.items() if not s.endswith(self.end)}
        self.final = {s[: -len(self.end)]: i for s, i in self.ids.items() if s.endswith(self.end)}
        self.inner_sizes, self.final_sizes = _sizes(self.inner), _sizes(self.final)
        #: End of a text -> lengths of longer tokens that end so, and (length, token) of those within it; both falling.
        self.inner_ends: dict[str, tuple[tuple[int, ...], tuple[tuple[int, int], ...]]] = {}
        self.final_ends: dict[str, tuple[tuple[int, ...], tuple[tuple[int, int], ...]]] = {}
        # Only its normaliser and splits are used, so it gets no vocabulary.
        self.library = Tokenizer.from_str(json.dumps(spec | {"model": model | {"vocab": {}, "merges": [], "unk_token": None}, "added_tokens": [], "post_processor": None}))
        splits = [p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split"]
        # White space as the library's engine has it: U+001C to U+001F are none.
        self.word = regex.compile(splits[0].replace(r"\s", r"\t-\r \x85\p{Z}"))
        #: The same for texts of characters below ``_PLAIN_BELOW``, with the classes' members spelt out: the plain engine is faster.
        self.plain_word = re.compile(_spelt(splits[0]))
        self.by_runs = splits[0] == _RUNS
        #: Characters below ``_PLAIN_BELOW``: their lower case, and its class.
        self.lower = np.array([ord(chr(c).lower()) for c in range(ord(_PLAIN_BELOW))], np.uint16)
        self.kinds = np.array([_kind(chr(c)) for c in range(ord(_PLAIN_BELOW))], np.uint8)
        self.name_of = pa.array([self.names.get(i, "") for i in range(max(self.names) + 1)], pa.string())
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.bytes_as = _byte_names()
        #: Left id in the upper, right id in the lower half of the key.
        self.may_follow: dict[int, bool] = {}
        #: Words with their tokens: those met since the last turn of generations, and those of the one before.
        self.known: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}
        self.letters = 0

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """The symbols at a token's edge over time, each with the rank of the merge that takes it up."""
        spine, until = [(token, _NEVER)], _NEVER
        while token in self.parts:
            until = self.parts[token][2]
            token = self.parts[token][side]
            spine.append((token, until))
        return spine

    def follows(self, left: int, right: int) -> bool:
        rank, others, found = self.rank, self._spine(right, 0), True
        for a, a_until in self._spine(left, 1):
            for b, b_until in others:
                r = rank.get((a, b))
                # Of merges of one rank, the one further left comes first.
                if r is not None and r < a_until and r <= b_until:
                    found = False
                    break
            if not found:
                break
        if len(self.may_follow) > CACHE_PAIRS:
            self.may_follow.clear()
        self.may_follow[left << 32 | right] = found
        return found

    def _ends(self, tail: str, table: dict[str, int], sizes: dict[str, tuple[int, ...]], ends: dict) -> tuple:
        if len(ends) > CACHE_ENDS:
            ends.clear()
        rest = tail[1:]
        # Most ends are no token, and share what is told of the rest of them.
        own = (ends.get(rest) or self._ends(rest, table, sizes, ends))[1] if rest else ()
        if (token := table.get(tail)) is not None:
            own = ((len(tail), token), *own)
        found = ends[tail] = (sizes.get(tail, ()), own)
        return found

    def _last(self, text: str, n: int, states: list[int], table: dict[str, int], sizes: dict[str, tuple[int, ...]], ends: dict) -> int:
        """State of ``text[:n]``; those of shorter prefixes that it needs and that aren't known are filled in."""
        may_follow = self.may_follow
        tail = text[n - _TAIL : n] if n > _TAIL else text[:n]
        longer, own = ends.get(tail) or self._ends(tail, table, sizes, ends)
        for size in longer:
            if size <= n and (token := table.get(text[n - size : n])) is not None:
                if size == n:
                    return token
                left = states[n - size]
                if left < 0:
                    left = states[n - size] = self._last(text, n - size, states, self.inner, self.inner_sizes, self.inner_ends)
                found = may_follow.get(left << 32 | token)
                if self.follows(left, token) if found is None else found:
                    return token
        for size, token in own:
            if size == n:
                return token
            left = states[n - size]
            if left < 0:
                left = states[n - size] = self._last(text, n - size, states, self.inner, self.inner_sizes, self.inner_ends)
            found = may_follow.get(left << 32 | token)
            if self.follows(left, token) if found is None else found:
                return token
        raise ValueError(f"no token ends {text[:n]!r}")

    def learn(self, words: list[str]) -> None:
        """Work out the tokens of distinct words (already as byte characters), in trie order."""
        states: list[int] = [-1]
        before = ""
        names, end, last = self.names, len(self.end), self._last
        inner, inner_sizes, inner_ends = self.inner, self.inner_sizes, self.inner_ends
        final, final_sizes, final_ends = self.final, self.final_sizes, self.final_ends
        for word in sorted(words):
            size = len(word)
            if (token := final.get(word)) is not None:
                # A token of its own needs no states of its prefixes.
                self.known[word] = [token]
                self.letters += size
                continue
            shared = 0
            most = min(len(before), size - 1)
            while shared < most and before[shared] == word[shared]:
                shared += 1
            del states[shared + 1 :]
            states += [-1] * (size - len(states))
            if size > _DEEP:
                for n in range(1, size):
                    if states[n] < 0:
                        states[n] = last(word, n, states, inner, inner_sizes, inner_ends)
            before = word
            token = last(word, size, states, final, final_sizes, final_ends)
            out, at = [token], size - (len(names[token]) - end)
            while at > 0:
                token = states[at]
                out.append(token)
                at -= len(names[token])
            out.reverse()
            self.known[word] = out
            self.letters += size

    def words(self, text: str) -> list[str]:
        """Normalised words of a text without special tokens."""
        if text.isascii():
            found = self.plain_word.findall(text.lower())
            return self._named(found) if _CONTROL.search(text) else found
        if _BEYOND.search(text):
            # Composition, case and classes of letters here depend on the library's Unicode version.
            whole = self.library.normalizer.normalize_str(text)
            return [w for w, _ in self.library.pre_tokenizer.pre_tokenize_str(whole)]
        as_ = self.bytes_as
        return [
            w if w.isascii() and w.isprintable() else "".join([as_[b] for b in w.encode()])
            for w in self.plain_word.findall(text.lower())
        ]

    def pieces(self, text: str) -> list[str]:
        """Words of a text; special tokens as themselves with a leading NUL."""
        if self.marks is None or "<|" not in text:
            return self.words(text)
        out = []
        for i, part in enumerate(self.marks.split(text)):
            out += ["\0" + part] if i % 2 else self.words(part)
        return out

    def _named(self, words: list[str]) -> list[str]:
        # Control characters are the ASCII bytes with other names.
        as_ = self.bytes_as
        return [w if w.isprintable() else "".join([as_[ord(c)] for c in w]) for w in words]

    def forget(self) -> None:
        """Empty the memories of words and pairs."""
        self.known, self.older, self.letters = {}, {}, 0
        self.may_follow.clear()
        self.inner_ends.clear()
        self.final_ends.clear()

    def encode_batch(self, texts: list[str | None]) -> list[tuple[list[int], str]]:
        """(ids, decoded text) of each text."""
        ends, ids, decoded = self.encode_columns(texts)
        return [(ids[a:b].tolist(), d) for a, b, d in zip(ends[:-1], ends[1:], decoded.to_pylist(), strict=True)]

    def encode_columns(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """The n + 1 offsets of the texts' ids, all ids in a row, and the decoded texts."""
        with _no_cycles():
            return self._encode(texts)

    def _encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        distinct, at, count = self._parted(texts)
        if self.letters > CACHE_LETTERS:
            # Words in use come back from the older generation, the others go.
            self.older, self.known, self.letters = self.known, {}, 0
        new = []
        for w in [w for w in distinct if w not in self.known]:
            if (before := self.older.get(w)) is not None:
                self.known[w] = before
                self.letters += len(w)
            elif w[0] == "\0":
                self.known[w] = [self.special[w[1:]]]
            else:
                new.append(w)
        self.learn(new)
        # A word is looked up once a batch; places tell what stands where.
        told = list(map(self.known.__getitem__, distinct))
        size = np.fromiter(map(len, told), np.int64, len(told))
        flat = np.fromiter(chain.from_iterable(told), np.int32, int(size.sum()))
        first, own = np.cumsum(size) - size, size[at]
        until = np.concatenate([[0], np.cumsum(own)])
        ids = flat[np.repeat(first[at] - until[:-1], own) + np.arange(until[-1])]
        words = np.concatenate([[0], np.cumsum(count)])
        texts_of = _joined(self.name_of.take(pa.array(flat)), np.append(first, len(flat))).take(pa.array(at))
        return until[words].astype(np.int32), ids, _joined(texts_of, words)

    def _parted(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The distinct pieces of all texts, the place among them of each piece, and the number of pieces of each text."""
        texts = [t or "" for t in texts]
        others = [i for i, t in enumerate(texts) if not self.by_runs or not t.isascii() and _BEYOND.search(t) or self.marks is not None and "<|" in t]
        rows = [self.pieces(texts[i]) for i in others]
        for i in others:
            texts[i] = ""
        distinct, at, count = self._runs(texts)
        if others:
            place = dict(zip(distinct, range(len(distinct)), strict=True))
            more = [place.setdefault(w, len(place)) for w in chain.from_iterable(rows)]
            held = np.repeat(np.arange(len(texts)), count)
            count[others] = [len(r) for r in rows]
            order = np.argsort(np.concatenate([held, np.repeat(others, count[others])]), kind="stable")
            distinct, at = list(place), np.concatenate([at, np.array(more, np.int32)])[order]
        return distinct, at, count

    def _runs(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The same for the words of texts without marks, of characters below ``_PLAIN_BELOW``: runs of one class, each number by itself."""
        codes = self.lower[np.frombuffer("\n".join(texts).encode("utf-16-le"), np.uint16)]
        kind = self.kinds[codes]
        held = kind != _SPACE
        starts = held.copy()
        starts[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        # A contraction takes its letters from the run after the apostrophe.
        marks = np.flatnonzero(starts & (codes == ord("'")))
        ahead = np.append(codes, np.zeros(2, np.uint16))
        a, b = ahead[marks + 1], ahead[marks + 2]
        short = np.isin(a, [ord(c) for c in "stmd"])
        long = np.isin(a, [ord(c) for c in "rv"]) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        starts[marks[short | long] + 1] = False
        until = np.concatenate([marks[short] + 2, marks[long] + 3])
        until = until[until < len(codes)]
        starts[until] = held[until]
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.searchsorted(np.flatnonzero(starts), np.cumsum(lengths + 1))
        kept, bounds = codes[held], np.append(np.flatnonzero(starts[held]), np.count_nonzero(held))
        coded = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((2 * bounds).astype(np.int32)), pa.py_buffer(kept)]).dictionary_encode()
        words = coded.dictionary
        whole, at = b"".join(words.to_pylist()).decode("utf-16-le"), np.concatenate([[0], np.cumsum(pc.binary_length(words).to_numpy() // 2)]).tolist()
        as_ = self.bytes_as
        distinct = [whole[a:b] for a, b in pairwise(at)]
        if not (whole.isascii() and whole.isprintable()):
            distinct = [w if w.isascii() and w.isprintable() else "".join([as_[c] for c in w.encode()]) for w in distinct]
        return distinct, coded.indices.to_numpy(), np.diff(ends, prepend=0)


def _joined(texts: pa.Array, bounds: np.ndarray) -> pa.Array:
    """The texts between each two bounds, with a space between them."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), texts), " ")


def _sizes(tokens: Iterable[str]) -> dict[str, tuple[int, ...]]:
    """For the last ``_TAIL`` characters of longer tokens the falling lengths of tokens that end so."""
    out: dict[str, set[int]] = {}
    for t in tokens:
        if len(t) > _TAIL:
            out.setdefault(t[-_TAIL:], set()).add(len(t))
    return {tail: (*sorted(sizes, reverse=True),) for tail, sizes in out.items()}


def _spelt(pattern: str) -> str:
    """A pattern with the members below ``_PLAIN_BELOW`` of its classes of letters, numbers and white space."""
    held = [chr(c) for c in range(ord(_PLAIN_BELOW))]
    for name, kind in ((r"\p{L}", r"\p{L}"), (r"\p{N}", r"\p{N}"), (r"\s", r"[\t-\r \x85\p{Z}]")):
        pattern = pattern.replace(name, "".join(re.escape(c) for c in held if regex.fullmatch(kind, c)))
    return pattern


def _kind(c: str) -> int:
    if regex.fullmatch(r"[\t-\r \x85\p{Z}]", c):
        return _SPACE
    return _LETTER if regex.fullmatch(r"\p{L}", c) else _NUMBER if regex.fullmatch(r"\p{N}", c) else _OTHER


def _byte_names() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next from U+0100 on."""
    names, extra = [], 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b:
            names.append(chr(b))
        else:
            names.append(chr(extra))
            extra += 1
    return names


@lru_cache(maxsize=1)
def encoder(path: str) -> TrieEncoder:
    return TrieEncoder(path)


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, ids array<int>, decoded string`` for each row; no shuffle.

    A null text counts as empty: no ids, an empty decoded text. Repeated rows give repeated rows, an
    empty table none; other columns are ignored. The tokenizer file must be at ``tokenizer_path`` on
    every executor. Special tokens inside a text become their ids, as the library does by default.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer_path)
        for batch in chunks(batches, 1, WALK_BYTES):
            ends, ids, decoded = enc.encode_columns(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids)), decoded], [id_col, "ids", "decoded"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).cast("string")).transform(mapped(run, f"`{id_col}` {kind}, ids array<int>, decoded string", lambda: encoder.cache_clear()))


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Length and digests of an encoding: ``id_col, n_tokens, ids_sha256, decoded_sha256``."""
    return encoded.select(
        id_col,
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
