"""Words, windows and hashes of whole texts, as numpy operations on Arrow string buffers.

A text is handled as its UTF-8 bytes. Words are maximal runs without ASCII white space
(``[^\\x20\\x09-\\x0D]+``), which is also a rule on bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 4 << 20
LONG_WORD = 64

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def binary_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A string or binary column with 64-bit offsets; null becomes empty."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(name)).cast(pa.large_binary()), b"")


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values, and the places where each begins and ends."""
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)), offsets


def text_chunks(batch: pa.RecordBatch, name: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of at most ``limit`` bytes (one row may be longer): first row, end row, bytes, offsets."""
    if not len(batch):
        return
    data, offsets = buffers(binary_column(batch, name))
    at = 0
    while at < len(offsets) - 1:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, end, data[offsets[at]: offsets[end]], offsets[at: end + 1] - offsets[at]
        at = end


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end of each word, and the number of words before each text (one more entry than texts)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    space = SPACE[data]
    before, after = np.empty(len(data), bool), np.empty(len(data), bool)
    before[0], before[1:] = True, space[:-1]
    after[-1], after[:-1] = True, space[1:]
    before[offsets[:-1][offsets[:-1] < len(data)]] = True
    after[offsets[1:][offsets[1:] > 0] - 1] = True
    starts = np.flatnonzero(~space & before)
    return starts, np.flatnonzero(~space & after) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word: FNV-1a, finalised; long words by blake2b."""
    lengths = ends - starts
    clipped = np.minimum(lengths, LONG_WORD + 1).astype(np.int16)
    order = np.argsort(-clipped, kind="stable")
    begin, size = starts[order], clipped[order]
    h = np.full(len(starts), 0xCBF29CE484222325, np.uint64)
    active = np.searchsorted(-size, -np.arange(LONG_WORD), "left")
    for step in range(LONG_WORD):
        m = int(active[step])
        if not m:
            break
        h[:m] = (h[:m] ^ data[begin[:m] + step]) * np.uint64(0x100000001B3)
    out = np.empty(len(starts), np.uint64)
    out[order] = h
    out = mix(out)
    for i in np.flatnonzero(lengths > LONG_WORD):
        digest = hashlib.blake2b(data[starts[i]: ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    return out


def fold(h: np.ndarray, size: int) -> np.ndarray:
    """The hash of each window of ``size`` neighbouring words (windows may span texts)."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for step in range(size):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[step: step + n])
    return out


def windows(h: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words inside one text, and the text of each."""
    texts = np.repeat(np.arange(len(counts)), counts)
    folded = fold(h, size)
    inside = texts[: len(folded)] == texts[size - 1:] if len(folded) else np.zeros(0, bool)
    return folded[inside], texts[: len(folded)][inside]


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Per text its sorted distinct ``size``-word shingles, A-Z lower-cased.

    A text with fewer words gives its whole sequence as one shingle, one without words none.
    """
    data = LOWER[data]
    starts, ends, first = word_bounds(data, offsets)
    h, counts = word_hashes(data, starts, ends), np.diff(first)
    shingles, owner = windows(h, counts, size)
    cut = np.searchsorted(owner, np.arange(len(counts) + 1))
    out = []
    for i, n in enumerate(counts):
        if n >= size:
            out.append(np.unique(shingles[cut[i]: cut[i + 1]]))
        else:
            out.append(fold(h[first[i]: first[i + 1]], int(n)) if n else np.zeros(0, np.uint64))
    return out


TABLE = 0x20000
_letters = np.array([chr(c).isalpha() for c in range(TABLE)])
_lower = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else c for c in range(TABLE)], np.uint32)


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, and the places where each text begins and ends."""
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    return points, leads[offsets]


def letters(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased code points, and which of them are letters."""
    low = points < TABLE
    inside = np.where(low, points, 0)
    is_letter = low & _letters[inside]
    for c in np.unique(points[~low]):
        is_letter |= (points == c) & chr(c).isalpha()
    return np.where(low, _lower[inside], points), is_letter
