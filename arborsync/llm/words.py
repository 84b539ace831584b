"""Words of many texts as numpy arrays: positions and 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xBF58476D1CE4E5B9)
_LOW_BYTES = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_SHIFT = np.uint64(32)

# Texts of one slice are worked on together; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20


def byte_class(separators: bytes) -> np.ndarray:
    """Lookup table: True for bytes that belong to words, False for ``separators``."""
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


# Words are maximal runs of anything but white space.
NOT_SPACE = byte_class(b" \t\n\x0b\x0c\r")
# Words are maximal runs of ASCII digits, a-z and all non-ASCII characters.
ALPHANUMERIC = byte_class(bytes(range(0x30)) + bytes(range(0x3A, 0x61)) + bytes(range(0x7B, 0x80)))
# Words are maximal runs of ASCII letters and all non-ASCII characters.
LETTERS = byte_class(bytes(range(0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80)))
# Maps A-Z to a-z and nothing else.
ASCII_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))


def mix(values: np.ndarray) -> np.ndarray:
    """Spread uint64 values over all 64 bits."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> _SHIFT)) * _MIX
        values = (values ^ (values >> np.uint64(29))) * _FOLD
        return values ^ (values >> _SHIFT)


@dataclass
class Words:
    """Words of consecutive texts. ``bounds[i]:bounds[i + 1]`` are the words of text i."""

    hashes: np.ndarray
    bounds: np.ndarray
    data: bytes
    starts: np.ndarray
    lengths: np.ndarray

    def text(self, index: int) -> bytes:
        begin = int(self.starts[index])
        return self.data[begin : begin + int(self.lengths[index])]


def split_words(texts: list[bytes | None], table: np.ndarray, lower: bool = False) -> Words:
    """Words of ``texts`` (None has none), hashed on their bytes, by the byte classes of ``table``."""
    plain = [t or b"" for t in texts]
    # A separator behind each text, and room for reading eight bytes from any start.
    data = b"\n".join([*plain, b"\0" * 8])
    if lower:
        data = data.translate(ASCII_LOWER)
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = table[raw[:-8]] if len(raw) > 8 else np.zeros(0, dtype=bool)
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
    starts, lengths = edges[0::2], edges[1::2] - edges[0::2]
    sizes = np.fromiter((len(t) + 1 for t in plain), dtype=np.int64, count=len(plain))
    text_starts = np.concatenate(([0], np.cumsum(sizes)))
    bounds = np.searchsorted(starts, text_starts)
    return Words(hash_runs(raw, starts, lengths), bounds, data, starts, lengths)


def hash_runs(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of each run of bytes; ``raw`` must go on for eight bytes behind the last."""
    eights = np.ndarray((max(len(raw) - 7, 0),), dtype="<u8", buffer=raw.data, strides=(1,))
    out = mix(lengths.astype(np.uint64))
    left, at, rows = lengths, starts, None
    while len(at):
        piece = eights[at] & _LOW_BYTES[np.minimum(left, 8)]
        if rows is None:
            out = mix(out ^ piece)
        else:
            out[rows] = mix(out[rows] ^ piece)
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive words."""
    count = len(hashes) - width + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = mix(hashes[:count] + np.uint64(width))
    for step in range(1, width):
        out = mix(out ^ hashes[step : step + count])
    return out


def shingles(words: Words, index: int, width: int) -> np.ndarray:
    """Sorted distinct shingles of text ``index``; a shorter text, unless it has no word, is one shingle."""
    own = words.hashes[words.bounds[index] : words.bounds[index + 1]]
    return np.unique(windows(own, min(width, len(own)))) if len(own) else own


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes | None]]]:
    """(first row, texts) of consecutive rows of a binary ``column``, about ``limit`` bytes at a time."""
    values = batch.column(batch.schema.get_field_index(column))
    begin, held, size = 0, [], 0
    for row in range(len(values)):
        text = values[row].as_py()
        held.append(text)
        size += len(text or b"")
        if size >= limit:
            yield begin, held
            begin, held, size = row + 1, [], 0
    if held:
        yield begin, held
