"""Piece-wise encoding against the library, block round trips, packing invariants."""

import random
import threading
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from learnlake.llm import packing, token_blocks
from learnlake.llm.encoding import PieceEncoder

BYTES, WORDS = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
PARTS = ["a", "The", " ", "  ", "\n", "\t", "é", "É", "ß", "'", "'s", "'T", "don't", "12", "²", "٣", ".", "..", "###",
         "漢字", "\xa0", "\x1c", "\x85", "é", "́", "İ", "ΣΑΣ", "<|endoftext|>", "<|startoftext|>", "<|end", "|>", "\U0001f600", "µ", "\r\n", "x" * 30]


def library(path):
    return Tokenizer.from_file(path)


def le(ids):
    return np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("path", [BYTES, WORDS])
def test_pieces_equal_the_library(path):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(PARTS) for _ in range(rnd.randrange(14))) for _ in range(5000)]
    texts += ["".join(rnd.choice(PARTS[:4] + PARTS[12:15]) for _ in range(rnd.randrange(40))) for _ in range(2000)]
    texts += ["a <|endoftext|> b", "<|startoftext|><|endoftext|>", "Some words,\nand 12 more.\n", "line\n\nline\n \n"]
    texts += ["some words, " * 200_000, "é " * 600_000 + "<|endoftext|>  x " * 3, "a" * 1_100_000 + " b"]
    texts += ["a" * 5000 + "." * 5000, " ".join(["word"] * 3000), "!" * 40 + "é"]
    expected = library(path).encode_batch(texts, add_special_tokens=False)
    for text, got, want in zip(texts, PieceEncoder(path).encode(texts), expected, strict=True):
        assert got == le(want.ids), repr(text)


@given(st.lists(st.one_of(st.integers(0, 60_000), st.integers(0, 20), st.integers(0, 2**32 - 1)), max_size=700))
@settings(max_examples=150, deadline=None)
def test_blocks_round_trip(ids):
    array = np.array(ids, np.uint32)
    start, data = token_blocks.pack_blocks(array)
    assert token_blocks.unpack_blocks(start, data, len(ids)).tolist() == ids
    for k in range(len(start)):
        part = token_blocks.unpack_blocks(start[k:k + 1], data, 128)
        assert part.tolist()[:len(ids) - 128 * k] == ids[128 * k:128 * k + 128]


def test_typical_ids_are_smaller_than_plain():
    rnd = np.random.default_rng(3)
    ids = np.where(rnd.random(100_000) < 0.95, rnd.integers(0, 2000, 100_000), rnd.integers(0, 50_257, 100_000))
    assert len(token_blocks.pack_blocks(ids.astype(np.uint32))[1]) < 1.7 * len(ids)


ROWS = [(5, "Hello world. " * 30), (3, None), (9, ""), (3, "same id"), (None, "no id"), (7, "x " * 9000),
        (9, ""), (-4, "negative"), (8, "Straße naïve"), (11, "tokens and more tokens\n" * 700)]


def frame(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr(
        "*", "1 as place", "2 as start", "3 as ids", "4 as sequence_id")


def test_files_give_back_every_document(spark, monkeypatch):
    monkeypatch.setattr(token_blocks, "SEGMENT_IDS", 300)
    got = token_blocks.read_tokens(token_blocks.write_tokens(frame(spark), BYTES), with_ids=True).collect()
    tokenizer = library(BYTES)
    want = sorted((d if d is not None else -99, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (2,))
                  for d, t in ROWS)
    assert sorted((r.doc_id if r.doc_id is not None else -99, tuple(r.ids)) for r in got) == want
    assert all(r.ids_crc32 == zlib.crc32(le(r.ids)) and r.n_tokens == len(r.ids) for r in got)
    place = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == place
        place += r.n_tokens
    order = [r.doc_id if r.doc_id is not None else -99 for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    assert token_blocks.round_trip(frame(spark).limit(0), BYTES).count() == 0


@pytest.mark.parametrize("classes", [100, 300])
def test_column_generation_ends_beside_a_session(spark, classes):
    """Threads of a linear algebra library may wait for ever in the driver; none is used there."""
    spark.range(10).count()
    rnd = random.Random(classes)
    demand = {s: rnd.randrange(1, 400) for s in rnd.sample(range(1, 513), classes)}
    done = []
    search = threading.Thread(target=lambda: done.append(packing.column_generation(demand, 512, 1500)), daemon=True)
    search.start()
    search.join(120)
    assert done and sum(s * a * n for p, n in done[0] for s, a in p.items()) == sum(s * n for s, n in demand.items())


def test_inverse():
    matrix = np.random.default_rng(1).integers(0, 4, (60, 60)) + 5.0 * np.eye(60)[::-1]
    assert np.allclose(packing.inverse_of(matrix) @ matrix, np.eye(60))


def test_column_generation_covers_demand_exactly():
    rnd = random.Random(0)
    for _ in range(60):
        capacity = rnd.choice([8, 16, 30])
        demand = {s: rnd.randrange(9) for s in range(1, capacity + 1)}
        plan, got = packing.column_generation(demand, capacity), {}
        for pattern, times in plan:
            assert times > 0 and sum(s * a for s, a in pattern.items()) <= capacity
            for s, a in pattern.items():
                got[s] = got.get(s, 0) + a * times
        assert got == {s: n for s, n in demand.items() if n}
        fluid = -(-sum(s * n for s, n in demand.items()) // capacity)
        assert sum(t for _, t in plan) <= 1.35 * fluid + 2
    early = packing.column_generation({3: 10**6, 5: 77}, 16, most_rounds=0)
    assert sum(p.get(3, 0) * t for p, t in early) == 10**6
    assert packing.column_generation({}, 16) == []


def test_knapsack_is_best():
    prices = np.array([0, 0.1, 0.3, 0.2, 0.55, 0, 0.9])
    value, pattern = packing.best_pattern(prices, 6)
    best = max(sum(prices[s] * a for s, a in zip((1, 2, 3, 4, 6), n, strict=True))
               for n in np.ndindex(7, 4, 3, 2, 2) if np.dot((1, 2, 3, 4, 6), n) <= 6)
    assert abs(value - best) < 1e-12 and abs(prices @ pattern - best) < 1e-12


def check_packing(rows, tokens_by_doc):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for members in by_sequence.values():
        place = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == place
            place += r.length
        assert place <= 4096


def test_packing_places_every_token_once(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 3)
    docs = frame(spark)
    rows = packing.packed(docs, WORDS, with_ids=True)
    got = rows.collect()
    tokenizer = library(WORDS)
    want = sorted(str(tokenizer.encode(t or "", add_special_tokens=False).ids + [2]) for _, t in ROWS)
    check_packing(got, want)
    docs_back, open_docs = [], {}
    for r in sorted(got, key=lambda r: (str(r.doc_id), r.doc_tokens, r.start)):
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(le(r.ids))
        ids = open_docs.setdefault((r.doc_id, r.doc_tokens), [])
        assert r.start == len(ids) % r.doc_tokens
        ids += r.ids
    for (_, n), ids in open_docs.items():
        docs_back += [str(ids[i:i + n]) for i in range(0, len(ids), n)]
    assert sorted(docs_back) == want
    whole = packing.sequences(rows).collect()
    assert sum(r.n_tokens for r in whole) == sum(r.length for r in got)
    assert all(len(r.ids) == (r.n_tokens if r.n_tokens.bit_count() == 1 else 4096) for r in whole)
    assert packing.packed(docs.limit(0), WORDS).count() == 0


def test_little_padding(spark):
    rows = packing.packed(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), WORDS).collect()
    check_packing(rows, None)
    assert sum(r.length for r in rows) > 0.97 * 4096 * (max(r.sequence_id for r in rows) + 1)
