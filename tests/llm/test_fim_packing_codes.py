"""Fill-in-middle, packing and vector codes against brute force, on the small tables and on awkward rows."""

import hashlib
import math
import random
import struct
import zlib
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tierone.llm import ball_codes, fim, packing, queries, sql
from tierone.llm.common import documents, materialize

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, n long, form string, rid long, ids binary, output string"
LONG = " ".join(f"wört{i % 997}x{i % 31}" for i in range(60_000))
AWKWARD = [(1, None, 5, "x", 1, b"", "y"), (2, "", None, None, None, None, None), (3, "has <S> in it", 5, "x", 1, b"", "y"),
           (4, "é𝄞ß 漢字 words", 5, "x", 1, b"", "y"), (4, "é𝄞ß 漢字 words", 5, "x", 1, b"", "y"),
           (None, "no id here, but words enough", 5, "x", 1, b"", "y"), (5, LONG, 5, "x", 1, b"", "y"),
           (6, LONG + " end", 5, "x", 1, b"", "y"), (7, "x", 5, "x", 1, b"", "y"), (8, "<|endoftext|> <P", 5, "x", 1, b"", "y"),
           (2**62 + 1, "a big id\n\n\t  and blanks ", 5, "x", 1, b"", "y"), (9, "z" * 70_000, 5, "x", 1, b"", "y")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(AWKWARD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def reference():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.encode_special_tokens = True
    return tokenizer


def test_all_thirteen_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.parametrize("name", ["op11_fim", "op13_ball_codes"])
def test_equals_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf}/{table}.parquet')")
    result = con.execute(sql.ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    got = queries.QUERIES[name](spark, sf).select(*columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, result.fetchall()))


# ------------------------------------------------------------------ fill in the middle

def fim_by_hand(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < 20 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, a, b - a, out


def test_fim_equals_brute_force(spark, sf, odd, empty):
    for docs in (documents(spark, sf), odd):
        want = sorted(map(repr, (fim_by_hand(r.doc_id, r.text) for r in docs.collect())))
        made = fim.transform(docs)
        assert sorted(map(repr, map(tuple, made.collect()))) == want
        back = made.select(fim.restored(F.col("output"), F.col("form")).alias("t")).collect()
        assert sorted(r.t for r in back) == sorted(r.text or "" for r in docs.collect())
    assert fim.transform(empty).count() == 0
    everything = fim.transform(odd, plain=100).collect()
    assert {r.form for r in everything} == {"plain"}
    assert {r.form for r in fim.transform(odd, plain=0, spm=100).filter("prefix_chars IS NOT NULL").collect()} == {"spm"}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aé漢𝄞<P>SM ", max_size=400), st.integers(0, 400))
def test_counts_locate_every_unit(text, unit):
    data, memo = text.encode(), fim.Memo(2_000)
    for _ in range(2):                      # the second time from the memo
        found = fim.Sections(data, memo)
        assert b"".join(found.parts) == data and found.units == len(text)
        assert found.marked == any(m in text for m in fim.MARKS)
        assert data[:found.byte_of(min(unit, len(text)))].decode() == text[:unit]


def test_shared_passages_are_shared_chunks_and_borders_are_watched():
    rng = random.Random(5)
    passage = "".join(rng.choice("abcdefghé ") for _ in range(20_000)).encode()
    one, two = fim.chunks(b"first " + passage), fim.chunks(b"quite another start " + passage)
    assert len(set(one) & set(two)) >= len(one) - 3 and max(map(len, one)) <= fim.MAX_CHUNK
    memo = fim.Memo()
    fim.Sections(b"first " + passage, memo)
    seen = memo.misses
    fim.Sections(b"quite another start " + passage, memo)
    assert memo.misses - seen <= 3
    # A mark may lie anywhere, also across the border of two chunks.
    plain = bytes(rng.choice(b"abcdef") for _ in range(600))
    for at in range(600):
        assert fim.Sections(plain[:at] + b"<M>" + plain[at:], fim.Memo()).marked
    # The rolling hash does not depend on how the bytes are cut into blocks.
    whole, block = fim.candidates(passage).tolist(), fim.BLOCK
    fim.BLOCK = 1_000
    try:
        assert [c for c in fim.candidates(passage).tolist() if c >= fim.WINDOW] == [c for c in whole if c >= fim.WINDOW]
    finally:
        fim.BLOCK = block


# ------------------------------------------------------------------ packing

def pieces_by_hand(reference, rows):
    out = []
    for doc_id, text in rows:
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((doc_id, k, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    return sorted(map(repr, out))


def check_sequences(rows, capacity=1024):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing_equals_brute_force(spark, sf, odd, empty, reference):
    for docs in (documents(spark, sf), odd):
        rows = packing.pack(docs, VOCABULARY).collect()
        got = sorted(repr((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
        assert got == pieces_by_hand(reference, [(r.doc_id, r.text) for r in docs.collect()])
        bins, least = check_sequences(rows), -(-sum(r.length for r in rows) // 1024)
        assert bins <= least * 1.05 + 1
    assert packing.pack(empty, VOCABULARY).count() == 0


def test_sequences_hold_the_ids(spark, odd, reference):
    pieces = materialize(packing.tokenize(odd, VOCABULARY, capacity=64), "test-pieces")
    placed = packing.place(pieces.drop("ids"), capacity=64, group_pieces=40)
    assert check_sequences(placed.collect(), 64) == placed.select("sequence_id").distinct().count()
    placed = materialize(placed, "test-placed")
    made = {r.sequence_id: r for r in packing.sequences(pieces, placed).collect()}
    ids = {(r.rid, r.piece): r.ids for r in pieces.collect()}
    for r in placed.collect():
        whole = made[r.sequence_id]
        assert bytes(whole.ids)[4 * r.offset:4 * (r.offset + r.length)] == bytes(ids[r.rid, r.piece])
        assert len(whole.ids) == 4 * whole.length


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 19), max_size=60))
def test_each_piece_goes_where_the_squares_are_least(sizes):
    packer, gaps = packing.SumOfSquares(20), []         # gaps: residual gap of every bin

    def squares(residuals):
        return sum(residuals.count(g) ** 2 for g in set(residuals) if g)

    for size in sizes:
        options = [squares([*gaps[:b], g - size, *gaps[b + 1:]]) for b, g in enumerate(gaps) if g >= size]
        best = min([*options, squares([*gaps, 20 - size])])
        bin_, offset = packer.put(size)
        if bin_ == len(gaps):
            gaps.append(20)
        assert offset == 20 - gaps[bin_]
        gaps[bin_] -= size
        assert gaps[bin_] >= 0 and squares(gaps) == best


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab Z09'.,-!\n\t\r éßŻ…’– \u0085\x1c　漢а’sll<|endoftext|>", max_size=60))
def test_quick_ids_equal_the_tokenizers(text):
    encoder = packing.Encoder(VOCABULARY)
    for small in (packing.STRETCH, 7):
        parts = list(packing.stretches(text, small))
        assert "".join(parts) == text
        ids = [i for part in parts for i in encoder._stretch(part)]
        assert ids == encoder.reference.encode(text, add_special_tokens=False).ids


# ------------------------------------------------------------------ vector codes

def codes_by_hand(rows, parts=8, entries=16, rounds=6):
    kept = [(i, v, lab) for i, v, lab in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    width = len(kept[0][1]) // parts if kept else 0
    ints = [[math.floor(Fraction(x) * 4096) for x in v] for _, v, _ in kept]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in ints]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = defaultdict(list)
            for c in cut:
                groups[nearest(c[p], books[p])[1]].append(c[p])
            books[p] = [[sum(col) // len(groups[k]) for col in zip(*groups[k])] if k in groups else e
                        for k, e in enumerate(books[p])]
    found = [[nearest(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [min(sum(d for d, _ in f), 2**63 - 1) for f in found]
    labels = defaultdict(int)
    for (_, _, lab), e in zip(kept, errors):
        labels[lab] += e
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return sorted(repr((i, "".join(f"{k:02x}" for _, k in f), e, min(labels[lab], 2**63 - 1), digest))
                  for (i, _, lab), f, e in zip(kept, found, errors))


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, codes string, code int, n int")


def odd_vectors(seed, n, width=16, spread=0.5):
    rng = random.Random(seed)
    rows = [(i, [rng.choice((-1, 1)) * rng.random() * spread for _ in range(width)], rng.choice((0, 1, None))) for i in range(n)]
    rows += [(3, None, 1), (4, [], 1), (5, [None] * width, 1), (6, [math.nan] * width, 0), (7, [math.inf] + [0.0] * (width - 1), 0),
             (8, [0.0] * (width + 1), 0), (9, [0.0] * (2 * width), 0), (None, [0.25] * width, 2), (0, [0.125] * width, None)]
    rows += rows[:3] + [(n + i, [0.25] * width, 1) for i in range(40)]       # repeated rows, ties
    return rows


@pytest.mark.parametrize("rows", [
    odd_vectors(1, 300), odd_vectors(2, 4), odd_vectors(3, 60) + [(1000, [1e30] * 8 + [-1e30] * 8, 1), (1001, [1e305] * 16, 0)],
    [(i, [0.5] * 8, 0) for i in range(20)], [(1, None, 0)]], ids=["mixed", "few", "huge", "equal", "none"])
def test_codes_equal_brute_force(spark, rows):
    frame = vectors(spark, [(*r, "x", 1, 1) for r in rows]).repartition(4)
    got = ball_codes.compress(frame).collect()
    assert sorted(repr((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256)) for r in got) == codes_by_hand(rows)


def test_codes_of_an_empty_table(spark):
    out = ball_codes.compress(vectors(spark, []))
    assert out.count() == 0 and out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_cores_and_rings_skip_work_and_change_nothing():
    rng = np.random.default_rng(6)
    centres = rng.integers(-4000, 4000, (16, 8))
    book = ball_codes.Codebook(centres)
    points = centres[rng.integers(0, 16, 3000)] + rng.integers(-900, 900, (3000, 8))
    distance = ((points[:, None] - centres) ** 2).sum(-1)
    want = distance.argmin(1)
    for guess in (want, rng.integers(0, 16, 3000), np.zeros(3000, np.int64)):
        work = ball_codes.Work()
        code, best = ball_codes.assign(points, guess, book, work)
        assert (code == want).all() and (best == distance.min(1)).all()
        if guess is want:
            assert work.stable > 1000 and work.computed < 3000 * 8
