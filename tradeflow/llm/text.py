"""Words of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of word bytes. Its hash depends on its bytes alone, so equal
words have equal hashes in every task. Hashes have 64 bits and are mixed after
every eight bytes and every pair of words: a sum of powers modulo 2**64 would
give a Thue-Morse string and its complement one hash, whatever its base.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 8 << 20
_SEGMENT_WORDS = 1 << 17
_LONG = 64  # words of more bytes are hashed one by one

# Words between ASCII white space, unchanged: [^\x20\x09-\x0D]+
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
# Words of letters and digits, after lower-casing A-Z: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+
ALNUM = np.zeros(256, dtype=bool)
ALNUM[list(b"0123456789abcdefghijklmnopqrstuvwxyz")] = True
ALNUM[0x80:] = True

# What text is cut into by rules of letters, digits and others: letters are those of ASCII, and U+00C0 to U+00FF in UTF-8.
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KINDS = np.full(256, _OTHER, dtype=np.uint8)
_KINDS[~NOT_SPACE] = _SPACE
_KINDS[list(b"0123456789")] = _DIGIT
_KINDS[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = _LETTER
_KINDS[0x80:0xC0] = _KINDS[0xC3] = _LETTER
# Bytes of characters whose kind isn't known here, and control characters.
_UNKNOWN = NOT_SPACE.copy()
_UNKNOWN[0x21:0x7F] = _UNKNOWN[0x80:0xC0] = _UNKNOWN[0xC3] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


_ODD = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0x2545F4914F6CDD1D)
_LEAST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number; zeros follow the last byte."""
    padded = np.append(data, np.zeros(8, np.uint8))
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One hash per word; works in segments, so that memory follows the words, not the bytes."""
    out = mix((ends - starts).astype(np.uint64) * _ODD)
    for first in range(0, len(starts), _SEGMENT_WORDS):
        last = min(first + _SEGMENT_WORDS, len(starts))
        base = int(starts[first])
        eights = _eights(data[base : ends[last - 1]])
        live, length = np.arange(first, last), (ends - starts)[first:last]
        for at in range(0, _LONG, 8):
            more = length > at
            live, length = live[more], length[more]
            if not len(live):
                break
            piece = eights[starts[live] - base + at] & _LEAST_BYTES[np.minimum(length - at, 8)]
            out[live] = mix(out[live] + piece * _ODD)
    for i in np.flatnonzero(ends - starts > _LONG):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each ``size`` consecutive words, by doubling; not yet mixed."""
    if len(words) < size:
        return np.empty(0, dtype=np.uint64)
    result, covered, block, width = None, 0, words, 1
    left = size
    while left:
        if left & 1:
            part = block[covered : covered + len(words) - size + 1]
            result = part.copy() if result is None else _joined(result, part, width)
            covered += width
        left >>= 1
        if left:
            block = _joined(block[:-width], block[width:], width)
            width *= 2
    return result


def _joined(left: np.ndarray, right: np.ndarray, width: int) -> np.ndarray:
    shift = np.uint64(pow(int(_GRAM), width, 1 << 64))
    both = left * shift + right
    both ^= both >> np.uint64(29)
    both *= _ODD
    return both


@dataclass
class Words:
    """Words of a run of texts; those of text i are ``bounds[i]`` to ``bounds[i + 1]``."""

    data: np.ndarray  # each text followed by a space
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        return word_hashes(self.data, self.starts, self.ends)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """A place of each different word, told apart by bytes, and which of them every word is."""
        _, first, which = np.unique(self.hashes(), return_index=True, return_inverse=True)
        length, to = self.ends - self.starts, first[which]
        same = length == length[to]
        eights = _eights(self.data)
        live = np.flatnonzero(same & (to != np.arange(len(to))))
        for at in range(0, _LONG, 8):
            live = live[length[live] > at]
            if not len(live):
                break
            keep = _LEAST_BYTES[np.minimum(length[live] - at, 8)]
            same[live] &= (eights[self.starts[live] + at] & keep) == (eights[self.starts[to[live]] + at] & keep)
        for i in live[length[live] > _LONG]:
            same[i] &= self.word(i) == self.word(to[i])
        others: dict[bytes, int] = {}
        more: list[int] = []
        for i in np.flatnonzero(~same):  # words of one hash
            number = others.setdefault(self.word(i), len(others))
            if number == len(more):
                more.append(i)
            which[i] = len(first) + number
        return np.append(first, np.array(more, first.dtype)), which

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()

    def words(self, places: np.ndarray) -> list[bytes]:
        data = self.data.tobytes()
        return [data[a:b] for a, b in zip(self.starts[places].tolist(), self.ends[places].tolist(), strict=True)]

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)

    def left(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.bounds[1:], self.counts) - np.arange(len(self.starts))


def split_words(texts: pa.Array, word_bytes: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """The words of each text; a null text has none."""
    column = pc.fill_null(texts.cast(pa.large_binary()), b"")
    column = pc.binary_join_element_wise(column, pa.scalar(b"", pa.large_binary()), pa.scalar(b" ", pa.large_binary()))
    _, offsets, values = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(values or b"", dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = ascii_lower(data)
    edges = np.diff(word_bytes[data].view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    return Words(data, offsets, starts, ends, np.searchsorted(starts, offsets))


def letter_runs(words: Words, whole: bytes = b"") -> Words:
    """Words cut into runs of letters, single digits and runs of others, with A-Z lower-cased.

    Words that hold a byte of ``whole`` or a character of unknown kind are left as they are.
    """
    data, keep = words.data, _UNKNOWN.copy()
    keep[list(whole)] = True
    signs = np.flatnonzero(data[:-1] == 0xC3)  # U+00D7 and U+00F7 are no letters
    signs = signs[np.isin(data[signs + 1], (0x97, 0xB7))]
    kept = np.unique(np.searchsorted(words.starts, np.append(np.flatnonzero(keep[data]), signs), "right") - 1)
    edges = np.zeros(len(data) + 1, np.int8)
    edges[words.starts[kept]] = 1
    edges[words.ends[kept]] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8).view(bool)
    kind = np.where(inside, np.uint8(_OTHER), _KINDS[data])
    alone = kind == _DIGIT
    cut = np.ones(len(kind) + 1, dtype=bool)
    cut[1:-1] = (kind[1:] != kind[:-1]) | alone[1:]
    some = kind != _SPACE
    starts, ends = np.flatnonzero(some & cut[:-1]), np.flatnonzero(some & cut[1:]) + 1
    return Words(np.where(inside, data, ascii_lower(data)), words.offsets, starts, ends, np.searchsorted(starts, words.offsets))


def chunks(batches: Iterable[pa.RecordBatch], column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of at most about ``limit`` text bytes; a longer text is a slice of its own."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < batch.num_rows:
            done = sizes[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(sizes, done + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def slices(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 for each n of ``lengths``, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def dealt(target: np.ndarray, columns: dict[str, np.ndarray], runs: np.ndarray | None = None,
          values: dict[str, np.ndarray] | None = None) -> Iterator[dict]:
    """One row per target with its part of each column as bytes.

    What goes to one partition of the next step travels as a few arrays, not as
    one row per element. ``values`` holds ``runs[i]`` elements for element i.
    """
    order = np.argsort(target, kind="stable")
    cuts = np.flatnonzero(np.diff(target[order], prepend=-1))
    bounds = np.append(cuts, len(order))
    moved = {name: column[order] for name, column in columns.items()}
    if values:
        before = np.cumsum(runs) - runs
        picked = np.repeat(before[order], runs[order]) + slices(runs[order])
        moved_values = {name: column[picked] for name, column in values.items()}
        value_ends = np.append(0, np.cumsum(runs[order]))
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        row = {"target": int(target[order[a]])} | {n: c[a:b].tobytes() for n, c in moved.items()}
        if values:
            row |= {n: c[value_ends[a] : value_ends[b]].tobytes() for n, c in moved_values.items()}
        yield row


def gathered(batches: Iterable[pa.RecordBatch], kinds: dict[str, type]) -> dict[str, np.ndarray]:
    """All parts of a partition's columns that ``dealt`` cut, put together."""
    parts: dict[str, list[bytes]] = {name: [] for name in kinds}
    for batch in batches:
        for name in kinds:
            parts[name] += [x for x in batch.column(name).to_pylist() if x]
    return {name: np.frombuffer(b"".join(parts[name]), dtype=kind) for name, kind in kinds.items()}


def free_names(taken: Iterable[str], *wanted: str) -> list[str]:
    """``wanted``, with underscores added where a column of that name is taken, whatever its case."""
    taken = {name.lower() for name in taken}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
