"""Mixing: targets against repeated resharing, copies, and edge cases."""

import sys
from pathlib import Path

from learnlake.llm import mixing
from learnlake.llm.queries import ORACLES, QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
from oracle_check import compare, duck  # noqa: E402

SF = "/root/testdata/sf0.001"


def reshared(sizes):
    """Targets by giving the excess away again and again, as stated."""
    weights = {s: i % 3 + 1 for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in fixed]
        share = sum(weights[s] for s in free)
        target = {s: weights[s] * (total - sum(fixed.values())) / share for s in free}
        above = [s for s in free if target[s] > 3 * sizes[s]]
        if not above:
            return {**fixed, **target}
        fixed.update({s: 3 * sizes[s] for s in above})


def check(spark, sizes):
    rows = [(s, n) for s, n in sizes.items()]
    got = {r.source: r.target for r in mixing.source_targets(
        spark.createDataFrame(rows, "source string, size long")).collect()}
    want = reshared(sizes)
    assert got.keys() == want.keys()
    for s in want:
        assert abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]), (s, got, want)


def test_targets(spark):
    check(spark, {"a": 10, "b": 1000, "c": 3, None: 500})
    check(spark, {"a": 1, "b": 1, "c": 1, "d": 10_000, "e": 0})
    check(spark, {"only": 7})
    check(spark, {"é": 5, "z": 5, "Z": 5, None: 0})


def test_mix_and_edge_rows(spark):
    rows = [(1, "a b c", "x"), (2, None, "x"), (3, "", None), (3, "", None), (None, "w " * 50, None), (4, "q", "y"),
            (None, None, "z"), (5, "word " * 400, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr(
        "*", "1 as size", "2 as target", "3 as copies", "4 as mix_source")
    got = mixing.mix_of_documents(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        assert r.target <= 3 * r.source_size
    assert {r.target for r in got if r.doc_id is None and r.size == 0} == {0.0}
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_of_documents(docs).collect()))
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    words = sum(len((r.text or "").split()) for r in mix.collect())
    assert words == sum(r.taken for r in got)
    assert mixing.mix_of_documents(docs.limit(0)).count() == 0 and mixing.mixed(docs.limit(0)).count() == 0


def test_words_taken_come_near_the_targets(spark):
    got = mixing.mix_of_documents(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert abs(got.selectExpr("sum(taken) / sum(size)").first()[0] - 1) < 0.1


def test_queries_equal_their_sql(spark):
    con = duck(SF)
    for name, sql in ORACLES.items():
        if name != "pipeline":
            assert compare(spark, con, SF, QUERIES[name], sql) == "", name
