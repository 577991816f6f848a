"""Merkle manifest against a plain recursion over lists."""

import hashlib
import random
import sys
import zlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from learnlake.llm import merkle
from learnlake.llm.queries import ORACLES, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from oracle_check import compare, duck  # noqa: E402


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(*values):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(digests, fanout):
    """Root and, per leaf, the siblings level by level as (before, after)."""
    paths, groups, nodes = [[] for _ in digests], [[i] for i in range(len(digests))], digests
    while len(nodes) > 1:
        above, merged = [], []
        for at in range(0, len(nodes), fanout):
            run = nodes[at:at + fanout]
            for k, members in enumerate(groups[at:at + fanout]):
                for i in members:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1:])))
            above.append(digest(*run))
            merged.append([i for members in groups[at:at + fanout] for i in members])
        nodes, groups = above, merged
    return nodes[0], paths


def plain_manifest(rows, fanout=16):
    """rows: (doc_id, source, lang, n_chars, text); one tuple of the query's columns per row."""
    def order(r):
        return (r[0] is not None, r[0] or 0, leaf(*r))

    by_source = {}
    for r in sorted(rows, key=order):
        by_source.setdefault(r[1], []).append(r)
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    lower = {s: plain_tree([leaf(*r) for r in by_source[s]], fanout) for s in sources}
    root, upper = plain_tree([lower[s][0] for s in sources], fanout)
    out = []
    for k, s in enumerate(sources):
        for r, path in zip(by_source[s], lower[s][1], strict=True):
            whole = path + upper[k]
            text = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf(*r[:4], text)
            for before, after in whole:
                folded = digest(before, folded, after)
            out.append((r[0], leaf(*r), lower[s][0], root, digest(*[b + a for b, a in whole]), folded, folded == root))
    return out


def odd_rows():
    rnd = random.Random(5)
    rows = [(i, rnd.choice(["a", "a", "a", "b", "é", "", None, f"host{i % 40}"]), rnd.choice(["en", None]), i % 7,
             rnd.choice(["Some Text", "no capitals", "", None, "ÀÉ Ab\n" * 50])) for i in range(700)]
    rows += [(None, "a", None, None, f"Null id {i % 3}") for i in range(9)] + [(5, "a", "en", 1, "Same")] * 20
    return rows


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def test_manifest_equals_plain_recursion(spark):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS tree", "2 AS number", "'x' AS digest", "3 AS path")
    got = [tuple(r) for r in merkle.manifest_of_documents(docs.repartition(7)).collect()]
    expected = plain_manifest(rows)
    assert sorted(map(repr, got)) == sorted(map(repr, expected))
    assert {r[-1] for r in expected} == {True, False}


@pytest.mark.parametrize("fanout", [2, 3])
def test_other_fanouts(spark, fanout):
    rows = [(i, "ab"[i % 2] if i % 5 else None, f"{i * i}") for i in range(23)]
    docs = spark.createDataFrame(rows, "id int, part string, hash string").select(
        "id", "part", F.sha2("hash", 256).alias("hash"))
    got = merkle.proofs(docs, "part", ["id"], "hash", fanout).select(
        "*", merkle.fold(F.col("hash"), F.col("path")).alias("folded")).collect()
    parts = {p: [hashlib.sha256(h.encode()).hexdigest() for i, q, h in rows if q == p] for p in (None, "a", "b")}
    roots = {p: plain_tree(hashes, fanout)[0] for p, hashes in parts.items()}
    root = plain_tree(list(roots.values()), fanout)[0]
    assert len(got) == 23
    assert all(r.folded == r.root == root and r.subroot == roots[r.part] for r in got)


def test_one_row_and_none(spark):
    docs = spark.createDataFrame([(1, None, None, None, None)], SCHEMA)
    (row,) = merkle.manifest_of_documents(docs).collect()
    own = leaf(1, None, None, None, None)
    assert tuple(row) == (1, own, own, own, digest(), own, True)
    assert merkle.manifest_of_documents(docs.limit(0)).collect() == []


def test_query_equals_sql(spark):
    sf, name = "/root/testdata/sf0.001", "op12_merkle_manifest"
    assert compare(spark, duck(sf), sf, QUERIES[name], ORACLES[name]) == ""
