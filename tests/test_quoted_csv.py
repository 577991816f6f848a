"""Parallel reading of quoted line breaks against reading whole files."""

import random

import pytest
from pyspark.sql import functions as F

from learnlake.sources import quoted_csv, tables


def written(spark, folder, seed, rows, longest):
    rnd = random.Random(seed)
    parts = ["a", "word", '"', "\n", "\n\n", ",", "é", " ", "\r", '""', "line\n"]
    data = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randrange(longest))) or None, rnd.choice(["x", None, "1\n2", '"'])) for i in range(rows)]
    spark.createDataFrame(data, "id long, text string, other string").coalesce(2).write.options(header=True, escape='"').csv(folder)
    return data


@pytest.mark.parametrize(("seed", "rows", "longest"), [(1, 400, 12), (2, 60, 400), (3, 12, 3000)])
def test_splits_equal_whole_files(spark, tmp_path, seed, rows, longest):
    folder = str(tmp_path / "csv")
    written(spark, folder, seed, rows, longest)
    whole = tables.read_csv(spark, folder, infer=False, multi_line=True)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "512")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        lines = spark.read.option("lineSep", "\n").text(folder)
        assert lines.rdd.getNumPartitions() > 4
        split = tables.read_csv(spark, folder, infer=False, multi_line="split").collect()
        found = quoted_csv.records(spark, folder).where("NOT header")
        order = [r.record for r in found.orderBy("path", "block", "seq").collect()]
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = whole.collect()
    assert sorted(map(repr, split)) == sorted(map(repr, expected)) and len(expected) == rows
    ids = [int(r.split(",")[0]) for r in order]
    assert sorted(ids) == list(range(rows)) and sum(a > b for a, b in zip(ids, ids[1:])) <= 1


def test_types_and_empty_files(spark, tmp_path):
    folder = str(tmp_path / "one")
    spark.createDataFrame([(1, "a\nb"), (2, None)], "id long, text string").write.options(header=True, escape='"').csv(folder)
    typed = tables.read_csv(spark, folder, "id long, text string", multi_line="split")
    assert sorted((r.id, r.text) for r in typed.collect()) == [(1, "a\nb"), (2, None)]
    none = str(tmp_path / "none")
    spark.createDataFrame([("id", "text")], "a string, b string").coalesce(1).write.csv(none)
    assert tables.read_csv(spark, none, multi_line="split", infer=False).where(F.lit(True)).collect() == []
