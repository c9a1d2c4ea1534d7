"""Language identification by hyperdimensional profiles.

Every letter of any script has a random vector of +1 and -1 of its own, drawn
by hashing its code point. The vector of a trigram binds
(multiplies) its letters' vectors, each permuted (rotated) once more per place
before the end, so order matters. A document is the bundle (sum) of its
trigrams; a language prototype is the bundle of all its training documents;
the prediction is the prototype with the largest cosine.

Training reads every document with a language whose crc32 remainder is not 1;
the rest are held out. Only text enters a prediction.

Defined results: null text, or text without a letter, is ``und`` with score 0,
as is all text when nothing was learned; cosines that agree to ``DIGITS``
digits tie, and a tie goes to the first language by code point; a null
``doc_id`` is not held out; repeated rows count repeatedly.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierone.llm.numeric import mix64

DIMENSIONS = 512
SEED = 42
UNKNOWN = "und"
DIGITS = 12
#: Code 0 is any run of non-letters, 1-26 are a-z; a further letter's code is its own code point.
PLAIN = 27
#: Bits of a code in a trigram's number.
BITS = 21
#: Languages whose bundles a task holds at once; beyond it they are passed on.
HELD_LANGUAGES = 1024
#: Trigrams a task gathers before they are counted and bundled.
HELD_GRAMS = 1 << 20


@functools.cache
def letter_codes() -> np.ndarray:
    """Code of every code point; upper and lower case share one."""
    codes = np.zeros(0x110000, dtype=np.uint32)
    for cp in range(0x110000):
        ch = chr(cp)
        if ch.isalpha():
            low = ord(ch.lower()[0])
            codes[cp] = low - 96 if 97 <= low <= 122 else low
    return codes


class Profiles:
    """Vectors of letters and trigrams; trigrams of a to z and gaps are kept once made."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED):
        self.dimensions, self.seed = dimensions, seed
        self.row = np.full(PLAIN**3, -1, dtype=np.int32)
        self.table = np.empty((1024, dimensions), dtype=np.float32)
        self.used = 0

    def letters(self, codes: np.ndarray) -> np.ndarray:
        """One row of +1 and -1 per code: the bits of hashes of (seed, code, word)."""
        words = -(-self.dimensions // 64)
        at = codes.astype(np.uint64)[:, None] * np.uint64(words) + np.arange(words, dtype=np.uint64)
        hashes = mix64(mix64(at + np.uint64(1)) ^ np.uint64(self.seed)).astype("<u8")
        bits = np.unpackbits(hashes.view(np.uint8), axis=1)[:, :self.dimensions]
        return bits.astype(np.float32) * 2 - 1

    def made(self, parts: np.ndarray) -> np.ndarray:
        """Bound vectors of trigrams given as rows of three codes."""
        known, at = np.unique(parts, return_inverse=True)
        letters, at = self.letters(known), at.reshape(parts.shape)
        first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
        return first[at[:, 0]] * second[at[:, 1]] * letters[at[:, 2]]

    def vectors(self, grams: np.ndarray) -> np.ndarray:
        parts = grams[:, None] >> np.array([2 * BITS, BITS, 0]) & ((1 << BITS) - 1)
        plain = (parts < PLAIN).all(axis=1)
        out = np.empty((len(grams), self.dimensions), dtype=np.float32)
        out[~plain] = self.made(parts[~plain])
        spot = parts[plain] @ np.array([PLAIN**2, PLAIN, 1])
        fresh = self.row[spot] < 0
        if fresh.any():
            new = slice(self.used, self.used + int(fresh.sum()))
            while new.stop > len(self.table):
                self.table = np.concatenate((self.table, np.empty_like(self.table)))
            self.table[new] = self.made(parts[plain][fresh])
            self.row[spot[fresh]] = np.arange(new.start, new.stop)
            self.used = new.stop
        out[plain] = self.table[self.row[spot]]
        return out

    def bundle(self, grams: np.ndarray) -> np.ndarray:
        """Sum of the vectors of all trigrams, repeats included; exact."""
        found, counts = np.unique(grams, return_counts=True)
        total = np.zeros(self.dimensions)
        exact = np.float32 if len(grams) < 1 << 24 else np.float64
        for k in range(0, len(found), 4096):
            total += counts[k:k + 4096].astype(exact) @ self.vectors(found[k:k + 4096]).astype(exact, copy=False)
        return total


def trigrams(text: str | None, codes: np.ndarray) -> np.ndarray | None:
    """The number of every trigram in turn, or None where there is no letter."""
    raw = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), dtype="<u4")
    code = codes[raw]
    if not code.any():
        return None
    code = np.concatenate(([0], code, [0])).astype(np.int64)
    code = code[(code != 0) | (np.concatenate(([1], code[:-1])) != 0)]     # one 0 per gap
    return (code[:-2] << 2 * BITS) + (code[1:-1] << BITS) + code[2:]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def learn(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages in code point order and their prototypes (unit length)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, codes = Profiles(), letter_codes()
        bundles: dict[str, np.ndarray] = {}
        gathered: dict[str, list[np.ndarray]] = {}

        def bundle(lang: str) -> None:
            sums = profiles.bundle(np.concatenate(gathered.pop(lang)))
            bundles[lang] = bundles[lang] + sums if lang in bundles else sums

        def out() -> pa.RecordBatch:
            for lang in list(gathered):
                bundle(lang)
            rows = [(lang, v.tolist()) for lang, v in bundles.items()]
            bundles.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()),
                 pa.array([r[1] for r in rows], pa.list_(pa.float64()))], names=["lang", "v"])

        for batch in batches:
            held = 0
            for text, lang in zip(batch.column("text"), batch.column("lang"), strict=True):
                found = trigrams(text.as_py(), codes)
                if found is None:
                    continue
                gathered.setdefault(lang.as_py(), []).append(found)
                held += len(found)
                if held >= HELD_GRAMS:
                    for name in list(gathered):
                        bundle(name)
                    held = 0
                if len(bundles) + len(gathered) > HELD_LANGUAGES:
                    yield out()
                    held = 0
            for name in list(gathered):
                bundle(name)
        yield out()

    known = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sums = (known.select("text", "lang").mapInArrow(run, "lang string, v array<double>")
            .select("lang", F.posexplode("v").alias("d", "x"))
            .groupBy("lang", "d").agg(F.sum("x").alias("x")))
    # As many rows as there are languages.
    rows = (sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("d", "x"))).alias("v"))
            .select("lang", F.col("v.x").alias("v")).collect())
    rows = sorted((r["lang"], r["v"]) for r in rows)
    matrix = np.array([v for _, v in rows], dtype=np.float64).reshape(len(rows), DIMENSIONS)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return [lang for lang, _ in rows], matrix / np.where(norms, norms, 1)


def predict(docs: DataFrame, languages: list[str], prototypes: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred and score (the cosine, at least 0) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        profiles, codes = Profiles(), letter_codes()
        for batch in batches:
            names, scores = [], []
            for text in batch.column("text"):
                found = trigrams(text.as_py(), codes) if languages else None
                if found is None:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                v = profiles.bundle(found)
                cosines = np.round(prototypes @ v / max(np.linalg.norm(v), 1e-9), DIGITS)
                best = int(np.argmax(cosines))
                names.append(languages[best])
                scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
            .mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double"))


def identify(docs: DataFrame) -> DataFrame:
    languages, prototypes = learn(docs)
    return predict(docs, languages, prototypes)
