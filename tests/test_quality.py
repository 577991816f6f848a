import pytest
from pyspark.sql import functions as F

from learnlake.functions.columns import WHITESPACE, cast_or_null, strip
from learnlake.operators import clean, contracts, encode, profile
from learnlake.operators.contracts import (
    ContractViolation, duplicate_keys, load_contract, missingness_profile, parse_contract)


def test_trim_then_critical_nulls(spark):
    df = spark.createDataFrame([(1, " alice "), (None, "bob"), (3, "  cara")], "id_student long, name string")
    rows = clean.clean(df, ["id_student"]).orderBy("id_student").collect()
    assert [r.name for r in rows] == ["alice", "cara"]


def test_strip_matches_python_on_all_white_space(spark):
    text = WHITESPACE + "a" + WHITESPACE + "b" + WHITESPACE
    assert all(c.isspace() for c in WHITESPACE)
    row = spark.createDataFrame([(text,), (None,), (WHITESPACE,)], "t string").select(strip(F.col("t")).alias("t")).collect()
    assert [r.t for r in row] == [text.strip(), None, ""]


def test_critical_nulls_ignore_absent_columns(spark):
    df = spark.createDataFrame([(1,), (None,)], "a long")
    assert clean.drop_critical_nulls(df, ["zzz"]).count() == 2
    assert clean.drop_critical_nulls(df, ["a", "zzz"]).count() == 1


@pytest.mark.parametrize("keep,want", [("last", "b"), ("first", "a")])
def test_deduplicate(spark, keep, want):
    df = spark.createDataFrame([(1, "a", 0), (1, "b", 1), (2, "c", 2)], "k long, v string, pos long")
    rows = {r.k: r.v for r in clean.deduplicate(df, ["k", "absent"], ["pos"], keep).collect()}
    assert rows == {1: want, 2: "c"}


def test_deduplicate_null_keys_and_no_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k long, pos long")
    assert {(r.k, r.pos) for r in clean.deduplicate(df, ["k"], ["pos"]).collect()} == {(None, 2), (1, 3)}
    assert clean.deduplicate(df, ["absent"], ["pos"]).count() == 3


def test_deduplicate_copies_of_one_row(spark):
    df = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS k", "id AS pos")
    out = clean.deduplicate(df, ["k"], ["pos"])
    assert out.count() == 6001 and out.filter("k = 0").first().pos == 8997


def test_label(student_info):
    rows = clean.encode_label(student_info).orderBy("id_student").collect()
    assert [r.final_result_binary for r in rows] == [0, 1, 0]
    blank = student_info.withColumn("final_result", F.lit(None).cast("string"))
    assert {r.final_result_binary for r in clean.encode_label(blank).collect()} == {0}


def test_contract_accepts_and_widens(student_info):
    checked = load_contract("student_info").enforce(student_info.withColumn("id_student", F.col("id_student").cast("string")))
    assert dict(checked.dtypes)["id_student"] == "bigint" and checked.count() == 3


def test_contract_lists_all_violations(student_info):
    bad = student_info.withColumns({"gender": F.lit("X"), "studied_credits": F.lit(601)}).drop("region")
    with pytest.raises(ContractViolation) as error:
        load_contract("student_info").enforce(bad)
    text = str(error.value)
    assert "gender" in text and "studied_credits" in text and "'region'" in text and "3 rows" in text
    assert isinstance(error.value, ValueError)


def test_contract_optional_column_may_be_absent(student_info):
    assert "imd_band" not in load_contract("student_info").enforce(student_info.drop("imd_band")).columns


def test_contract_unknown_type():
    with pytest.raises(ValueError):
        parse_contract("{name: t, columns: [{name: a, type: decimal}]}")


def test_quarantine_splits_all_rows(student_info):
    mixed = student_info.withColumn("gender", F.when(F.col("id_student") == 2, "X").otherwise(F.col("gender")))
    good, bad = load_contract("student_info").quarantine(mixed)
    assert good.count() == 2 and [list(r._violations) for r in bad.collect()] == [["gender:allowed"]]


@pytest.mark.parametrize("text,want", [
    ("3", 3), (" 4 ", 4), ("3.0", 3), ("3.7", None), ("x", None), ("9007199254740993", 9007199254740993), (None, None)])
def test_cast_text_to_long(spark, text, want):
    df = spark.createDataFrame([(text,)], "a string")
    assert df.select(cast_or_null(F.col("a"), "string", "integer").alias("a")).first().a == want


def test_cast_double_to_long(spark):
    df = spark.createDataFrame([(3.0,), (3.7,), (float("nan"),), (1e30,)], "a double")
    assert [r.a for r in df.select(cast_or_null(F.col("a"), "double", "long").alias("a")).collect()] == [3, None, None, None]


def test_fill_strategies(spark):
    df = spark.createDataFrame(
        [(1, "b", None, "x"), (2, "a", 5, None), (4, "a", None, "x"), (None, None, None, None), (8, "b", None, "x")],
        "m long, o string, z long, t string")
    row = clean.fill_missing(df, {"m": "median", "o": "mode", "z": "zero", "t": "gone", "absent": "zero"})
    filled = row.collect()[3]
    assert (filled.m, filled.o, filled.z, filled.t) == (3.0, "a", 0, "gone")


def test_fill_all_null_column_stays_null(spark):
    df = spark.createDataFrame([(None, None)], "m double, o string")
    assert clean.fill_missing(df, {"m": "median", "o": "mode"}).first() == (None, None)


def test_outliers(spark):
    df = spark.createDataFrame([(float(x),) for x in [*range(10), 1000]] + [(None,)], "x double")
    assert sorted(r.x for r in clean.remove_outliers_iqr(df, "x").collect()) == [float(x) for x in range(10)]
    assert clean.remove_outliers_iqr(df, "x", approx=True).count() == 10
    assert clean.remove_outliers_iqr(df, "absent").count() == 12


def test_categories_do_not_chain(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "x string")
    rows = clean.standardise_categories(df, {"x": {"a": "b", "b": "a"}, "absent": {"q": "r"}}).collect()
    assert [r.x for r in rows] == ["b", "a", "c"]


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a"), (None, "a"), (3, None), (4, "b")], "n long, s string")
    assert {r["column"]: r.n_null for r in missingness_profile(df).collect()} == {"n": 1, "s": 1}
    shares = {r.s: r.share for r in profile.distribution(df, "s").collect()}
    assert shares == {"a": pytest.approx(2 / 3), "b": pytest.approx(1 / 3)}
    assert [tuple(r) for r in duplicate_keys(df, ["s"]).collect()] == [("a", 2)]
    assert profile.table_shapes({"t": df}).first() == ("t", 4, 2)


def test_fingerprint_ignores_order_but_not_content(spark):
    df = spark.range(1000).selectExpr("id", "nullif(id % 3, 0) AS x")
    same = profile.fingerprint(df.repartition(7)).first()
    assert profile.fingerprint(df).first() == same
    assert profile.fingerprint(df.withColumn("x", F.lit(1))).first() != same


def test_one_hot(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "id long, c string")
    fitted = encode.fit_one_hot(df, ["c"])
    assert fitted == {"c": ["UNK", "a", "b"]}
    other = spark.createDataFrame([(9, "zzz"), (8, "a")], "id long, c string")
    out = encode.apply_one_hot(other, fitted)
    assert out.columns == ["id", "c_UNK", "c_a", "c_b"]
    assert {tuple(r) for r in out.collect()} == {(9, 0.0, 0.0, 0.0), (8, 0.0, 1.0, 0.0)}


def test_ordinal_of_many_categories(spark):
    words = spark.range(5000).selectExpr("concat('w', lpad(cast(id * 7 % 3001 as string), 4, '0')) AS c")
    expected = {v: i for i, v in enumerate(sorted({r.c for r in words.collect()}))}
    assert {r.value: r.position for r in encode.fit_ordinal(words, ["c"]).collect()} == expected
    coded = encode.apply_ordinal(spark.createDataFrame([("w0001",), ("no",)], "c string"), encode.fit_ordinal(words, ["c"]), ["c"])
    assert {r.c: r.c_ord for r in coded.collect()} == {"w0001": 1, "no": -1}


def test_one_hot_vectors_equal_columns(spark):
    df = spark.createDataFrame([(1, "b", "x"), (2, "a", None), (3, None, "y")], "id long, c string, d string")
    fitted = encode.fit_ordinal(df, ["c", "d"])
    other = df.unionByName(spark.createDataFrame([(9, "zzz", "x")], "id long, c string, d string"))
    wide = encode.apply_one_hot(other, encode.fit_one_hot(df, ["c", "d"]))
    got = {r.id: (r.one_hot.toArray().tolist(), len(r.one_hot.indices)) for r in encode.one_hot_vectors(other, fitted, ["c", "d"]).collect()}
    assert got == {r.id: (list(r[1:]), int(sum(r[1:]))) for r in wide.collect()}
    with pytest.raises(ValueError, match="one_hot_vectors"):
        encode.fit_one_hot(df, ["c", "d"], most=3)


def test_dictionary_of_a_million_categories(spark):
    """The same plan for any size: nothing of the dictionary reaches the driver."""
    words = spark.range(0, 1_000_000, 1, 8).selectExpr("concat('w', lpad(cast(id as string), 7, '0')) AS c")
    fitted = encode.fit_ordinal(words, ["c"])
    row = fitted.selectExpr("count(*) AS n", "sum(int(substr(value, 2) = position)) AS same").first()
    assert tuple(row) == (1_000_000, 1_000_000)
    last = encode.one_hot_vectors(spark.createDataFrame([("w0999999",)], "c string"), fitted, ["c"]).first().one_hot
    assert last.size == 1_000_000 and last.indices.tolist() == [999_999]


def test_modes_of_many_columns_in_one_job(spark):
    rows = [(1, 1.5, "b", True), (1, float("nan"), "a", None), (2, 2.5, "a", False), (2, 2.5, "b", False), (None, None, None, None)]
    df = spark.createDataFrame(rows, "i long, f double, s string, b boolean").withColumn("d", F.lit(None).cast("date"))
    filled = clean.fill_missing(df, dict.fromkeys(df.columns, "mode")).where("s IS NOT NULL AND i IS NOT NULL").collect()
    assert clean._modes(df, df.columns) == {"i": "1", "f": "2.5", "s": "a", "b": "false", "d": None}
    assert filled[-1].d is None and {r.b for r in filled} == {True, False}
    big = spark.createDataFrame([(9007199254740993,), (9007199254740992,)], "i long")
    assert clean._modes(big, ["i"]) == {"i": "9007199254740992"}


KEYED = """
name: keyed
primary_key: [a, b]
unique_key: true
columns:
  - {name: a, type: long}
  - {name: b, type: string}
  - {name: c, type: double, min: 0}
"""


def test_key_rule(spark):
    contract = contracts.parse_contract(KEYED)
    rows = [("1", "x", 1.0), ("01", "x", 2.0), ("2", None, -1.0), ("2", None, 3.0), ("3", "y", 4.0), ("4", "z", -5.0)]
    df = spark.createDataFrame(rows, "a string, b string, c double")
    assert {(r["column"], r.rule): r.bad for r in contract.report(df).collect() if r.bad} == {("a,b", "key"): 4, ("c", "min"): 2}
    with pytest.raises(contracts.ContractViolation, match="column 'a,b': 4 rows break the unique key"):
        contract.enforce(df)
    good, bad = contract.quarantine(df)
    assert [tuple(r) for r in good.collect()] == [(3, "y", 4.0)]
    assert sorted((r.a, r.b, r.c, tuple(r._violations)) for r in bad.collect() if r.b) == [
        ("01", "x", 2.0, ("a,b:key",)), ("1", "x", 1.0, ("a,b:key",)), ("4", "z", -5.0, ("c:min",))]
    assert sorted(tuple(r._violations) for r in bad.where("b IS NULL").collect()) == [("a,b:key",), ("c:min", "a,b:key")]
    assert contract.enforce(df.where("a = '3'")).count() == 1
    assert contract.report(df.drop("b")).where("rule = 'key'").count() == 0
    empty = contract.quarantine(df.limit(0))
    assert [x.count() for x in empty] == [0, 0]
