"""Fill-in-middle transformation by content-defined chunk memoization.

A text is a run of units: code points, counted on its UTF-8 bytes. A rolling
hash over ``WINDOW`` bytes cuts the bytes where their own content says so, so
a passage that many texts share falls into the same chunks in all of them. A
chunk's summary is looked up by its whole content (equal hashes are never
taken for equal chunks): the units that begin in it and whether it holds a
mark; its first and last bytes tell what only two chunks together hold, a
character or a mark across their border. Adding up the counts locates the two
cuts of a document, and only the chunk that holds a cut is looked into. The
summaries are kept per task in two generations of at most ``MEMO_BYTES``
each; a forgotten chunk is summarised again, never wrongly. The pass is
narrow: no shuffle, and a lost executor's texts are done again alike.

Where the cuts lie and which form a document takes follow from a digest of
seed and ``doc_id``, so reruns agree. Forms: ``psm`` is <P>prefix<S>suffix<M>middle,
``spm`` is <S>suffix<P>prefix<M>middle, ``plain`` is the text itself.

Defined results: a null or empty text, or one that holds a mark, stays plain
(null counts as empty) with null cut lengths; a null ``doc_id`` is digested as
the empty string; rows that share a ``doc_id`` are cut by the same numbers;
other columns than those named in ``carry`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")
_MARKS = [m.encode() for m in MARKS]
#: Chunks: cut where the low ``CUT_BITS`` bits of the rolling hash are zero, within these bounds.
WINDOW, CUT_BITS, MIN_CHUNK, MAX_CHUNK = 32, 8, 64, 4096
#: Bytes hashed at a time, and bytes of chunks per generation of the memo.
BLOCK, MEMO_BYTES = 1 << 20, 16 << 20
#: Percent of documents left plain, and of the others turned suffix first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20

_CONTINUATION = bytes(range(0x80, 0xC0))
_FACTOR = 0x9E3779B1


def _rolling(block: np.ndarray) -> np.ndarray:
    """Polynomial hash of the ``WINDOW`` bytes up to and including each byte (fewer at the start)."""
    h = (block.astype(np.uint32) + np.uint32(1)) * np.uint32(0x85EBCA6B)
    span, power = 1, _FACTOR
    while span < WINDOW:
        h[span:] = h[span:] + h[:-span] * np.uint32(power)
        span, power = span * 2, power * power % (1 << 32)
    return h ^ (h >> np.uint32(15))


def candidates(data: bytes) -> np.ndarray:
    """Places behind which the content allows a cut."""
    found, mask = [], np.uint32((1 << CUT_BITS) - 1)
    for at in range(0, len(data), BLOCK):
        lead = min(at, WINDOW - 1)
        h = _rolling(np.frombuffer(data[at - lead:at + BLOCK], np.uint8))[lead:]
        found.append(np.flatnonzero((h & mask) == 0) + at + 1)
    return np.concatenate(found) if found else np.empty(0, np.int64)


def chunks(data: bytes) -> list[bytes]:
    """``data`` in order; every chunk but the last has MIN_CHUNK to MAX_CHUNK bytes."""
    out, start = [], 0
    for end in [*candidates(data).tolist(), len(data)]:
        while end - start > MAX_CHUNK:
            out.append(data[start:start + MAX_CHUNK])
            start += MAX_CHUNK
        if end - start >= MIN_CHUNK or (end == len(data) and end > start):
            out.append(data[start:end])
            start = end
    return out


def summary(chunk: bytes) -> tuple[int, bool]:
    """(units that begin in the chunk, whether it holds a mark)."""
    return len(chunk.translate(None, _CONTINUATION)), any(m in chunk for m in _MARKS)


class Memo:
    """Summaries by chunk content, in two generations of bounded size."""

    def __init__(self, limit: int = MEMO_BYTES):
        self.limit, self.held, self.young, self.old = limit, 0, {}, {}
        self.hits = self.misses = 0

    def __call__(self, chunk: bytes) -> tuple[int, bool]:
        known = self.young.get(chunk)
        if known is None:
            known = self.old.get(chunk)
            if known is None:
                known = summary(chunk)
                self.misses += 1
            else:
                self.hits += 1
            self.young[chunk] = known
            self.held += len(chunk)
            if self.held > self.limit:
                self.young, self.old, self.held = {}, self.young, 0
        else:
            self.hits += 1
        return known


class Sections:
    """A text as chunks with the counts that locate its units."""

    def __init__(self, data: bytes, memo: Memo):
        self.data, self.parts = data, chunks(data)
        found = [memo(c) for c in self.parts]
        self.before = [0, *accumulate(n for n, _ in found)]
        self.starts = [0, *accumulate(map(len, self.parts))]
        borders = (a[-2:] + b[:2] for a, b in zip(self.parts, self.parts[1:]))
        self.marked = any(m for _, m in found) or any(m in b for b in borders for m in _MARKS)

    @property
    def units(self) -> int:
        return self.before[-1]

    def byte_of(self, unit: int) -> int:
        """Place of the byte at which ``unit`` begins; the end for the number of units."""
        if unit == self.units:
            return len(self.data)
        i = int(np.searchsorted(self.before, unit, side="right")) - 1
        part, n = self.parts[i], unit - self.before[i]
        if self.before[i + 1] - self.before[i] == len(part):
            return self.starts[i] + n
        leads = np.flatnonzero((np.frombuffer(part, np.uint8) & 0xC0) != 0x80)
        return self.starts[i] + int(leads[n])


def rearranged(data: bytes, draws: Sequence[int], memo: Memo, plain: int = PLAIN_PERCENT,
               spm: int = SPM_PERCENT) -> tuple:
    """(units, form, prefix units, middle units, output) of one text."""
    text = Sections(data, memo)
    n = text.units
    if not data or text.marked or draws[2] % 100 >= 100 - plain:
        return n, "plain", None, None, data
    a, b = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    i, j = text.byte_of(a), text.byte_of(b)
    p, s, m = _MARKS
    prefix, middle, suffix = data[:i], data[i:j], data[j:]
    if draws[3] % 100 < spm:
        return n, "spm", a, b - a, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", a, b - a, b"".join((p, prefix, s, suffix, m, middle))


def draws(doc_id: Column, seed: int) -> Column:
    """Four unsigned 32-bit numbers from the digest of ``seed:doc_id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)])


def transform(docs: DataFrame, seed: int = 1, carry: Sequence[str] = ("doc_id",), plain: int = PLAIN_PERCENT,
              spm: int = SPM_PERCENT) -> DataFrame:
    """The columns ``carry`` of every row with n, form, prefix_chars, middle_chars and ``output``."""
    carry = list(carry)
    rows = docs.select(*carry, draws(F.col("doc_id"), seed).alias("__draws"),
                       F.coalesce("text", F.lit("")).alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo()
        for batch in batches:
            texts, numbers = batch.column("__text").cast(pa.binary()), batch.column("__draws")
            start, size, done = 0, 0, []
            for i in range(batch.num_rows):
                data = texts[i].as_py()
                done.append(rearranged(data, numbers[i].as_py(), memo, plain, spm))
                size += len(data)
                if size >= BLOCK or i + 1 == batch.num_rows:
                    n, form, a, m, out = zip(*done)
                    yield pa.RecordBatch.from_arrays(
                        [*[batch.column(c).slice(start, len(done)) for c in carry], pa.array(n, pa.int64()),
                         pa.array(form, pa.string()), pa.array(a, pa.int64()), pa.array(m, pa.int64()),
                         pa.array(out, pa.binary()).view(pa.string())],
                        names=[*carry, "n", "form", "prefix_chars", "middle_chars", "output"])
                    start, size, done = i + 1, 0, []

    kept = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]
    return rows.mapInArrow(run, ", ".join(
        [*kept, "n long, form string, prefix_chars long, middle_chars long, output string"]))


def restored(output: Column, form: Column) -> Column:
    """The text an output was made from; each mark stands once in it."""
    def between(after: str, before: str) -> Column:
        return F.substring_index(F.substring_index(output, before, 1), after, -1)

    p, s, m = MARKS
    tail = F.substring_index(output, m, -1)
    return (F.when(form == "psm", F.concat(between(p, s), tail, between(s, m)))
            .when(form == "spm", F.concat(between(p, m), tail, between(s, p)))
            .otherwise(output))
