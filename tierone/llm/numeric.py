"""NumPy helpers for the operators that run Python over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts of one batch are worked on in groups of about this many bytes, to bound memory.
GROUP_BYTES = 1 << 20
SPACE_CHARS = b" \t\n\x0b\x0c\r"

_LETTER = np.zeros(256, dtype=np.uint8)        # 0 space, 1 word, 2 other
_LETTER[:] = 2
_LETTER[list(SPACE_CHARS)] = 0
_LETTER[0x80:] = 1
for _a, _z in ((0x30, 0x39), (0x61, 0x7A)):
    _LETTER[_a:_z + 1] = 1

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mix64(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(29))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def text_groups(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list]]:
    """(first row, texts) of runs of rows of about GROUP_BYTES."""
    texts = batch.column(column)
    start, size, held = 0, 0, []
    for i in range(batch.num_rows):
        t = texts[i].as_py()
        held.append(t)
        size += len(t) if t else 0
        if size >= GROUP_BYTES:
            yield start, held
            start, size, held = i + 1, 0, []
    if held:
        yield start, held


def tokens(texts: list, punctuation: bool) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and text number of every token of the texts, A-Z in lower case.

    A token is a run of word characters (digits, letters, anything beyond
    ASCII) or, if ``punctuation``, a run of other visible characters.
    """
    raw = [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    kind = _LETTER[data]
    change = np.flatnonzero(kind[1:] != kind[:-1]) + 1
    starts = np.concatenate(([0], change))
    ends = np.concatenate((change, [len(data)]))
    chosen = kind[starts] != 0 if punctuation else kind[starts] == 1
    starts, ends = starts[chosen], ends[chosen]
    if not len(starts):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    lengths = ends - starts
    # Bytes of the tokens only, weighted by powers of a factor within each token.
    first = np.concatenate(([0], np.cumsum(lengths)))
    index = np.arange(first[-1]) - np.repeat(first[:-1] - starts, lengths)
    within = index - np.repeat(starts, lengths)
    longest = int(lengths.max())
    powers = np.cumprod(np.full(longest, _FACTOR, dtype=np.uint64))
    hashes = np.add.reduceat((data[index].astype(np.uint64) + np.uint64(1)) * powers[within],
                             first[:-1])
    bounds = np.cumsum([len(r) + 1 for r in raw])
    owner = np.searchsorted(bounds, starts, side="right")
    return mix64(hashes), owner
