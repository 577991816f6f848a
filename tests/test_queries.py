"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as entry
from oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
# Too few sequences to learn from at the smallest scale.
LARGER = {"train_seq_score": "/root/testdata/sf0.01"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    sf = LARGER.get(name, SF)
    problem = compare(spark, con if sf == SF else duck(sf), sf, entry.queries()[name], entry.oracle_sql()[name])
    # A few selective queries may find nothing at this scale.
    assert problem in ("", "no rows at all")


def test_only_corpus_queries_lack_sql():
    lacking = set(entry.queries()) - set(entry.oracle_sql())
    assert all(name == "pipeline" or name.startswith("op") for name in lacking)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
