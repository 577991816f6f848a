"""Removal of repeated byte strings against looking up every string of 200 bytes."""

import hashlib
import random
from itertools import groupby

import numpy as np
import pytest

from learnlake.llm import longest_previous as lp
from learnlake.llm.queries import QUERIES


def brute(texts, least=lp.MIN_BYTES):
    """(bytes, removed, runs, digest of the rest) of each text."""
    starts = {}
    for i, t in enumerate(texts):
        for p in range(len(t) - least + 1):
            starts.setdefault(t[p:p + least], []).append((i, p))
    covered = [np.zeros(len(t), bool) for t in texts]
    for places in starts.values():
        if len(places) > 1:
            for i, p in places:
                covered[i][p:p + least] = True
    out = []
    for t, c in zip(texts, covered, strict=True):
        rest = np.frombuffer(t, np.uint8)[~c].tobytes()
        out.append((len(t), int(c.sum()), sum(k for k, _ in groupby(c.tolist())), hashlib.sha256(rest).hexdigest()))
    return out


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 8))) for _ in range(n))


def corpus(seed, rows=120):
    """Passages of several lengths in many texts, copies with edits, periodic and long texts, and odd rows."""
    rnd = random.Random(seed)
    passages = [words(rnd, n) for n in (30, 42, 48, 60, 90, 200)]
    whole = [words(rnd, 150) for _ in range(4)]
    texts = []
    for _ in range(rows):
        kind = rnd.randrange(6)
        if kind == 0:
            texts.append(words(rnd, rnd.randrange(120)))
        elif kind == 1:
            texts.append(words(rnd, rnd.randrange(20)) + rnd.choice(passages) + words(rnd, rnd.randrange(20)))
        elif kind == 2:
            texts.append(rnd.choice(passages)[rnd.randrange(40):] * rnd.randrange(1, 4))
        elif kind == 3:
            edited = list(rnd.choice(whole))
            for _ in range(rnd.randrange(4)):
                edited[rnd.randrange(len(edited))] = rnd.choice("xyz")
            texts.append("".join(edited))
        elif kind == 4:
            cut = rnd.choice(whole)
            at = rnd.randrange(len(cut) - 260)
            texts.append(words(rnd, 3) + cut[at:at + rnd.randrange(190, 230)] + words(rnd, 3))
        else:
            texts.append(rnd.choice(["a" * 150, "ab" * 130, "a" * 700, "xyz" * 99, "", "b" * 199, "c" * 200, "d" * 201]))
    return [*texts, None, None, words(rnd, 4000), passages[5] + words(rnd, 3000)]


def check(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    docs = docs.selectExpr("*", "1 AS k1", "'x' AS spans", "2 AS own", "3 AS n_bytes")
    got = lp.deduplicated_documents(docs.repartition(5)).collect()
    expected = [(i, *r) for i, r in zip(ids, brute([(t or "").encode() for t in texts]), strict=True)]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, expected))
    return expected


def test_equals_brute_force(spark):
    rows = check(spark, corpus(1))
    assert 0.2 < sum(r[2] > 0 for r in rows) / len(rows) < 0.95


def test_repeated_rows_and_ids(spark):
    texts = [t for t in corpus(2, 40) for _ in range(2)]
    check(spark, texts, [None if i % 5 == 0 else i // 4 for i in range(len(texts))])
    check(spark, ["short", None, ""])


def test_one_passage_in_a_third_of_all_rows(spark, monkeypatch):
    """Buckets that are cut up and anchors that are salted give the same result."""
    rnd = random.Random(3)
    passage = words(rnd, 60)
    texts = [words(rnd, 30) + (passage if i % 3 else "") + words(rnd, 30) for i in range(300)]
    expected = check(spark, texts)
    monkeypatch.setattr(lp, "BUCKET_CONTEXTS", 20)
    assert check(spark, texts) == expected
    check(spark, corpus(4))
    monkeypatch.setattr(lp, "FREQUENT_SHARE", 1.0)
    assert check(spark, texts) == expected


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lp.deduplicated_documents(docs).collect() == []


def test_first_copies_stay(spark):
    rnd = random.Random(6)
    passage, other = words(rnd, 80), words(rnd, 70)
    texts = [words(rnd, 20) + passage + words(rnd, 20) for _ in range(9)] + [other] * 4 + [words(rnd, 90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = lp.without_repeats(docs, ["doc_id", "text"], keep_first=True).collect()
    kept = [bytes(r.kept) for r in rows]
    assert sum(passage.encode() in k for k in kept) == 1 and sum(other.encode() in k for k in kept) == 1
    assert all(r.n_bytes - r.n_removed == len(r.kept) for r in rows)
    assert brute(kept) == [(len(k), 0, 0, hashlib.sha256(k).hexdigest()) for k in kept]


@pytest.mark.parametrize("chunk", [300, 1 << 21])
def test_contexts_hold_every_suffix_once(monkeypatch, chunk):
    monkeypatch.setattr(lp, "CHUNK", chunk)
    monkeypatch.setattr(lp, "_powers", [])
    texts = [t.encode() for t in corpus(5, 30) if t]
    ends = np.cumsum([len(t) for t in texts])
    _, first, last, anchor = lp.contexts(np.frombuffer(b"".join(texts), np.uint8), ends)
    suffixes = [s for a, b in zip(first, last, strict=True) for s in range(a, b + 1)]
    begins = [0, *ends[:-1].tolist()]
    assert suffixes == [p for b, e in zip(begins, ends.tolist(), strict=True) for p in range(b, e - lp.MIN_BYTES + 1)]
    assert all(a >= b and a - f < lp.GRAMS for f, b, a in zip(first, last, anchor, strict=True))


def test_longest_previous_factors():
    rnd = random.Random(7)
    for _ in range(200):
        n = rnd.randrange(1, 40)
        x = np.array([rnd.randrange(3) for _ in range(n)])
        order, lcp = lp.suffix_array(x)

        def match(i, j):
            k = 0
            while max(i, j) + k < n and x[i + k] == x[j + k]:
                k += 1
            return k

        for sign in (1, -1):
            got = np.empty(n, np.int64)
            got[order] = lp.longest_previous_factors(sign * order, lcp)
            others = [range(i) if sign == 1 else range(i + 1, n) for i in range(n)]
            assert got.tolist() == [max([match(i, j) for j in js], default=0) for i, js in enumerate(others)]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op11_suffix_array_dedup"](spark, sf).collect()}
    assert [got[r.doc_id] for r in rows] == brute([(r.text or "").encode() for r in rows])
