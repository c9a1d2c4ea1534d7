"""Best-fit packing of tokenised documents into sequences by the sum-of-squares rule.

``tokenize`` turns every document into its ids and an end id and cuts longer
ones into pieces of the capacity, of which the first may be shorter. A piece
of full capacity is a sequence by itself. ``place`` packs the others: it looks
at sizes only, never at ids. With N(g) open bins of residual gap g, a piece
goes where the sum of N(g) squared over all gaps becomes smallest, into an
open bin or a new one (ties: the open bin with the smallest gap). Full bins do
not count. Pieces are dealt to groups of about ``GROUP_PIECES`` by a hash of
their row, longest first within a group, and each group is packed by one task,
so memory and the wait for one task are bounded at every size, hot sources and
copies are spread, and the cost is at most a few open bins per group.

Ids come of the public byte-level vocabulary. Texts whose characters lie in
blocks that no Unicode version has changed since 5.1 are encoded by ``tiktoken``
over the merges read from the same file, which gives the same ids in a fourth
of the time; all others by ``tokenizers``. Very long texts are encoded in
stretches cut before a blank between visible ASCII characters, where no token
of the vocabulary's splitting pattern can reach across.

Defined results: a null or empty text is its end id alone; strings of special
tokens in a text are ordinary text; repeated rows and rows with a null or
shared ``doc_id`` are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierone.llm.common import materialize

CAPACITY = 1024
END_ID = 2
#: Pieces packed together by one task.
GROUP_PIECES = 1 << 16
#: Characters encoded at a time, at least.
STRETCH = 1 << 18
#: Bytes of ids sent on at a time.
BATCH_BYTES = 1 << 22

#: The splitting pattern of the vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
#: Anything but line ends, tab, visible ASCII, Latin letters and general punctuation.
OTHER = re.compile("[^\t\n\r -~¡-ɏ‐-‧]")
SEAM = re.compile(r"(?<=[!-~])(?= [!-~])")


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Encoder:
    """Ids of texts by the vocabulary file at ``path``."""

    def __init__(self, path: str):
        self.path = path

    @cached_property
    def reference(self):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(self.path)
        tokenizer.encode_special_tokens = True
        return tokenizer

    @cached_property
    def quick(self):
        import tiktoken
        with open(self.path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        alphabet = _byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in vocabulary.items()
                 if all(c in alphabet for c in token) and not token.startswith("<|")}
        return tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        parts = [np.array(self._stretch(s), "<u4") for s in stretches(text)]
        return np.concatenate(parts) if parts else np.empty(0, "<u4")

    def _stretch(self, text: str) -> list[int]:
        if OTHER.search(text):
            return self.reference.encode(text, add_special_tokens=False).ids
        return self.quick.encode_ordinary(text)


def stretches(text: str, size: int = STRETCH) -> Iterator[str]:
    start = 0
    while start < len(text):
        seam = SEAM.search(text, start + size)
        end = seam.start() if seam else len(text)
        yield text[start:end]
        start = end


def piece_bounds(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids; all but the first are full."""
    first = n - (-(-n // capacity) - 1) * capacity
    return [(0, first), *[(s, capacity) for s in range(first, n, capacity)]]


def tokenize(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces ``rid, doc_id, piece, start, length, ids``; ids as little-endian unsigned 32-bit numbers."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    names = ["rid", "doc_id", "piece", "start", "length", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, tail = Encoder(vocabulary), np.array([end_id], "<u4")

        def emit(batch, held):
            at, piece, start, length, ids = zip(*held)
            at = pa.array(at, pa.int64())
            return pa.RecordBatch.from_arrays(
                [batch.column("rid").take(at), batch.column("doc_id").take(at), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
                names=names)

        for batch in batches:
            held, size, texts = [], 0, batch.column("text")
            for i in range(batch.num_rows):
                ids = np.concatenate((encoder.ids(texts[i].as_py() or ""), tail))
                for k, (start, length) in enumerate(piece_bounds(len(ids), capacity)):
                    held.append((i, k, start, length, ids[start:start + length].tobytes()))
                    size += 4 * length
                    if size >= BATCH_BYTES:
                        yield emit(batch, held)
                        held, size = [], 0
            if held:
                yield emit(batch, held)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"rid long, doc_id {kind}, piece int, start long, length long, ids binary")


class SumOfSquares:
    """Online packer of sizes below ``capacity``."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count = np.zeros(capacity + 1, np.int64)       # open bins by residual gap
        self.open: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bins = 0

    def put(self, size: int) -> tuple[int, int]:
        """(bin, offset in it) of the next piece."""
        n, c = self.count, self.capacity
        change = 2 * (n[:c - size + 1] - n[size:]) + 2      # of the sum, by the gap left over
        change[0] -= 1                                      # full bins do not count
        change[n[size:] == 0] = np.iinfo(np.int64).max
        left = int(np.argmin(change))
        if change[left] <= 2 * n[c - size] + 1:
            gap = left + size
            n[gap] -= 1
            bin_ = self.open[gap].pop()
        else:
            gap, left, bin_ = c, c - size, self.bins
            self.bins += 1
        if left:
            n[left] += 1
            self.open[left].append(bin_)
        return bin_, c - gap


def place(pieces: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``pieces`` (``rid``, ``piece``, ``length`` and others) with ``sequence_id`` and ``offset``.

    Read twice, so given as a written table.
    """
    full = pieces.filter(F.col("length") >= capacity).withColumns(
        {"sequence_id": -1 - F.monotonically_increasing_id(), "offset": F.lit(0).cast("long")})
    rest = pieces.filter(F.col("length") < capacity)
    groups = max(1, -(-rest.count() // group_pieces))

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by([("length", "descending"), ("rid", "ascending"), ("piece", "ascending")])
        packer, base = SumOfSquares(capacity), group["__group"][0].as_py() << 32
        where = [packer.put(size) for size in group["length"].to_pylist()]
        return (group.drop_columns("__group")
                .append_column("sequence_id", pa.array([base + b for b, _ in where], pa.int64()))
                .append_column("offset", pa.array([o for _, o in where], pa.int64())))

    packed = (rest.withColumn("__group", F.pmod(F.xxhash64("rid", "piece"), F.lit(groups)))
              .groupBy("__group").applyInArrow(pack, full.schema))
    return full.unionByName(packed)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: the packed sequences themselves."""
    parts = pieces.select("rid", "piece", "ids").join(
        placed.select("rid", "piece", "sequence_id", "offset", "length"), ["rid", "piece"])
    return (parts.groupBy("sequence_id")
            .agg(F.sum("length").alias("length"),
                 F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", "length",
                    F.aggregate("parts.ids", F.lit(b"").cast("binary"), lambda a, b: F.concat(a, b)).alias("ids")))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Where every piece of ``docs`` goes, with a checksum of its ids."""
    pieces = tokenize(docs, vocabulary, capacity).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(materialize(pieces, "pack-pieces"), capacity)
