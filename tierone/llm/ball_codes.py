"""Vector codes by ball k-means: one small codebook for each part of the vectors, in whole numbers.

A vector is scaled to integers and cut into equal consecutive parts; every
part position has a codebook that starts from the vectors of the smallest ids
and is improved by a fixed number of rounds. All distances are exact integers,
so equal distances are equal and go to the lower index.

Assignment is that of ball k-means. A part starts from a guess, the entry it
had when the table was last written; the parts that share a guess are a ball
around that entry, with the largest distance as its radius. Only entries
closer to the centre than twice the radius are neighbours. A part nearer to
its entry than half the way to the nearest neighbour lies in the stable core
and is left alone; the others lie in rings between half distances to
successive neighbours and are compared with the neighbours up to their ring
only. By the triangle inequality nothing left out can be nearer or as near, so
the codes are those of a full comparison, whatever the guess.

A round is one narrow pass over the vectors that returns, per task, count and
sums of every entry's parts; these are merged per entry by a grouping of at
most parts x entries groups, and only the new codebooks come to the driver.
The vectors are written with their codes after the rounds in ``REFRESH``, so
the guess stays good at a fixed cost in disk; a lost task is simply done again.

Defined results: rows whose vector is null, empty or holds null or non-finite
components are left out, as are those of another length than the first kept
vector, or of one that the parts do not divide; rows that share a ``vec_id``
are rows of their own and seed by (id, vector), null ids last; fewer rows than
entries give fewer entries; equal entries go to the lower index; components of
any size are exact, and errors past the long range are given as its maximum;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierone.llm.common import join_groups, materialize

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Rounds after which the table is written anew with its codes.
REFRESH = (1, 3)
#: Vectors worked on at a time.
BATCH_ROWS = 4096
#: Up to this size of a component all distances fit 64 bits.
EXACT = 1 << 26
LONG_MAX = (1 << 63) - 1


def scaled(x: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x), as 64-bit integers or, past ``EXACT``, as Python's."""
    with np.errstate(over="ignore"):
        y = np.floor(x.astype(np.float64) * scale)
    if not y.size or np.abs(y).max() <= EXACT:
        return y.astype(np.int64)
    whole = [math.floor(Fraction(v) * scale) for v in x.ravel().tolist()]
    return np.array(whole, dtype=object).reshape(x.shape)


def square_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(axis=-1)


@dataclass
class Codebook:
    """Entries of one part position, with each entry's others by distance."""

    entries: np.ndarray                                     # (entries, width), integers

    def __post_init__(self):
        if self.entries.dtype != object and self.entries.size and np.abs(self.entries).max() > EXACT:
            self.entries = self.entries.astype(object)
        k = len(self.entries)
        self.between = np.array([square_distance(self.entries, e) for e in self.entries]).reshape(k, k)
        self.others, self.reach = [], []
        for i in range(k):
            order = [j for j in np.argsort(self.between[i], kind="stable").tolist() if j != i]
            self.others.append(order)
            self.reach.append(self.between[i][order])


@dataclass
class Work:
    """Distances computed and saved; for tests and reports."""

    computed: int = 0
    stable: int = 0


def assign(points: np.ndarray, guess: np.ndarray, book: Codebook,
           work: Work | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of every point, ties to the lower index."""
    entries = book.entries
    if points.dtype != entries.dtype:
        points, entries = points.astype(object), entries.astype(object)
    code, best = guess.copy(), square_distance(points, entries[guess])
    for i in np.unique(guess).tolist():
        ball = np.flatnonzero(guess == i)
        own = best[ball]
        reach = book.reach[i]
        # Neighbours: half their distance is within the radius.
        reach = reach[:np.searchsorted(reach, 4 * own.max(), side="right")]
        rings = np.searchsorted(reach, 4 * own, side="right")
        if work:
            work.computed += len(ball)
            work.stable += int((rings == 0).sum())
        for k in range(len(reach)):
            inside = ball[rings > k]
            j = book.others[i][k]
            d = square_distance(points[inside], entries[j])
            nearer = (d < best[inside]) | ((d == best[inside]) & (j < code[inside]))
            code[inside[nearer]], best[inside[nearer]] = j, d[nearer]
            if work:
                work.computed += len(inside)
    return code, best


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("embedding").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _guess(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(batch.num_rows, -1)


def _coded(batch: pa.RecordBatch, books: list[Codebook]) -> Iterator[tuple]:
    """(first row, integers, codes, distances) of stretches of the batch."""
    parts = len(books)
    width = parts * books[0].entries.shape[1]
    for at in range(0, batch.num_rows, BATCH_ROWS):
        some = batch.slice(at, BATCH_ROWS)
        points = scaled(_vectors(some, width)).reshape(some.num_rows, parts, -1)
        found = [assign(points[:, p], g, b) for p, (g, b) in enumerate(zip(_guess(some).T, books))]
        yield at, points, np.stack([f[0] for f in found], 1).astype(np.uint8), [f[1] for f in found]


def refreshed(rows: DataFrame, books: list[Codebook]) -> DataFrame:
    """``rows`` with the codes that ``books`` give them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [row.tobytes() for _, _, found, _ in _coded(batch, books) for row in found]
            yield batch.set_column(batch.schema.get_field_index("codes"), "codes", pa.array(codes, pa.binary()))

    return rows.mapInArrow(run, rows.schema)


def entry_sums(rows: DataFrame, books: list[Codebook]) -> DataFrame:
    """``part, entry, n, sums``: parts assigned to each entry, and their sums as decimal text."""
    parts, entries = len(books), len(books[0].entries)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, books[0].entries.shape[1]), dtype=object)
        for batch in batches:
            for _, points, codes, _ in _coded(batch, books):
                for p in range(parts):
                    n[p] += np.bincount(codes[:, p], minlength=entries)
                    for e in np.unique(codes[:, p]).tolist():
                        sums[p, e] += points[codes[:, p] == e, p].sum(axis=0).astype(object)
        used = [(p, e) for p in range(parts) for e in range(entries) if n[p, e]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in used], pa.int32()), pa.array([e for _, e in used], pa.int32()),
             pa.array([int(n[u]) for u in used], pa.int64()),
             pa.array([[str(v) for v in sums[u]] for u in used], pa.list_(pa.string()))],
            names=["part", "entry", "n", "sums"])

    def merge(group: pa.Table) -> pa.Table:
        total = [sum(map(int, column)) for column in zip(*group["sums"].to_pylist())]
        return pa.table({"part": group["part"][:1], "entry": group["entry"][:1],
                         "n": pa.array([sum(group["n"].to_pylist())], pa.int64()),
                         "sums": pa.array([[str(v) for v in total]], pa.list_(pa.string()))})

    schema = "part int, entry int, n long, sums array<string>"
    return rows.mapInArrow(run, schema).groupBy("part", "entry").applyInArrow(merge, schema)


def improved(rows: DataFrame, books: list[Codebook]) -> list[Codebook]:
    """Every entry replaced by the floor of its parts' mean; unused ones stay."""
    new = [b.entries.astype(object) for b in books]
    for r in entry_sums(rows, books).collect():         # parts x entries rows
        new[r.part][r.entry] = [int(v) // r.n for v in r.sums]
    return [Codebook(_narrow(e)) for e in new]


def _narrow(entries: np.ndarray) -> np.ndarray:
    small = all(abs(v) <= EXACT for v in entries.ravel().tolist())
    return entries.astype(np.int64) if small else entries


def _usable(parts: int):
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.col("embedding").isNotNull() & (F.size("embedding") > 0) & (F.size("embedding") % parts == 0) & ok


@dataclass
class Trained:
    """Codebooks by part position, and the table they were trained on with its last codes."""

    books: list[Codebook]
    rows: DataFrame | None

    def sha256(self) -> str:
        numbers = [str(v) for b in self.books for entry in b.entries.tolist() for v in entry]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          refresh: tuple[int, ...] = REFRESH) -> Trained:
    """Codebooks from ``vectors`` (``vec_id``, ``embedding``, ``label``)."""
    kept = vectors.filter(_usable(parts)).select("vec_id", "embedding", "label")
    order = [F.col("vec_id").asc_nulls_last(), F.col("embedding")]
    lead = kept.orderBy(*order).limit(1).collect()
    if not lead:
        return Trained([], None)
    width = len(lead[0].embedding)
    kept = kept.filter(F.size("embedding") == width)
    seeds = scaled(np.array([r.embedding for r in kept.orderBy(*order).limit(entries).collect()]))
    books = [Codebook(_narrow(s.astype(object))) for s in np.split(seeds, parts, axis=1)]
    rows = kept.withColumn("codes", F.lit(bytes(parts)))
    for done in range(1, rounds + 1):
        if done in refresh:
            rows = materialize(refreshed(rows, books), f"codes-{done}")
        books = improved(rows, books)
    return Trained(books, rows)


def encode(trained: Trained) -> DataFrame:
    """``vec_id, label, code, error`` of every row the codebooks were trained on."""
    books = trained.books

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, _, codes, distances in _coded(batch, books):
                errors = sum(d.astype(object) for d in distances)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").slice(at, len(codes)), batch.column("label").slice(at, len(codes)),
                     pa.array([row.tobytes().hex() for row in codes], pa.string()),
                     pa.array([min(e, LONG_MAX) for e in errors.tolist()], pa.int64())],
                    names=["vec_id", "label", "code", "error"])

    kind = {f.name: f.dataType.simpleString() for f in trained.rows.schema.fields}
    return trained.rows.mapInArrow(
        run, f"vec_id {kind['vec_id']}, label {kind['label']}, code string, error long")


def compress(vectors: DataFrame) -> DataFrame:
    """One row per kept vector: vec_id, code, error, label_error and the digest of the codebooks."""
    trained = train(vectors)
    if trained.rows is None:
        return vectors.limit(0).select("vec_id", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                                       F.lit(0).cast("long").alias("label_error"),
                                       F.lit("").alias("codebooks_sha256"))
    coded = materialize(encode(trained), "codes")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)"))
    labels = materialize(coded.groupBy("label").agg(F.count(F.lit(1)).alias("n"),
                                                    total.cast("long").alias("label_error")), "codes-labels")
    out = join_groups(coded, labels, ["label"], "n", coded.count())
    return out.select("vec_id", "code", "error", "label_error",
                      F.lit(trained.sha256()).alias("codebooks_sha256"))
