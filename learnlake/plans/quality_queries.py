"""Silver queries: contracts, cleaning, duplicates, profiles, encoders and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake import KEYS
from learnlake.operators import clean, encode, profile, split
from learnlake.operators.contracts import duplicate_keys, load_contract, missingness_profile, parse_contract
from learnlake.plans.register import Views, query

K = ", ".join(KEYS)

DIRTY_CONTRACT = """
name: dirtyPart
primary_key: [p_partkey]
columns:
  - {name: p_partkey, type: long, nullable: false}
  - {name: raw_num, type: integer, nullable: false}
  - {name: size, type: double, min: 5, max: 45}
  - {name: p_type, type: string, nullable: false, allowed: [ECONOMY, PROMO]}
"""
_RAW_LONG = """coalesce(try_cast(CASE WHEN regexp_full_match(raw_num, '[+-]?[0-9]+') THEN raw_num END AS BIGINT),
  CASE WHEN try_cast(raw_num AS DOUBLE) = floor(try_cast(raw_num AS DOUBLE)) THEN try_cast(try_cast(raw_num AS DOUBLE) AS BIGINT) END)"""


@query("contract_cast", f"""
    SELECT p_partkey, name, CAST(size AS DOUBLE) AS size, {_RAW_LONG} AS raw_num, p_type FROM v_dirty_part""")
def contract_cast(v: Views) -> DataFrame:
    return parse_contract(DIRTY_CONTRACT).cast(v.dirty_part)


@query("contract_violations", f"""
    WITH c AS (SELECT *, {_RAW_LONG} AS n FROM v_dirty_part)
    SELECT 'p_partkey' AS "column", 'cast' AS rule, CAST(0 AS BIGINT) AS bad
    UNION ALL SELECT 'p_partkey', 'not_null', count(*) FILTER (p_partkey IS NULL) FROM c
    UNION ALL SELECT 'raw_num', 'cast', count(*) FILTER (raw_num IS NOT NULL AND n IS NULL) FROM c
    UNION ALL SELECT 'raw_num', 'not_null', count(*) FILTER (n IS NULL) FROM c
    UNION ALL SELECT 'size', 'cast', 0
    UNION ALL SELECT 'size', 'min', count(*) FILTER (size < 5) FROM c
    UNION ALL SELECT 'size', 'max', count(*) FILTER (size > 45) FROM c
    UNION ALL SELECT 'p_type', 'cast', 0
    UNION ALL SELECT 'p_type', 'not_null', count(*) FILTER (p_type IS NULL) FROM c
    UNION ALL SELECT 'p_type', 'allowed', count(*) FILTER (p_type NOT IN ('ECONOMY', 'PROMO')) FROM c""")
def contract_violations(v: Views) -> DataFrame:
    return parse_contract(DIRTY_CONTRACT).report(v.dirty_part)


@query("contract_quarantine", """
    SELECT id_student, code_module, code_presentation, studied_credits,
      CASE WHEN studied_credits > 600 THEN 'studied_credits:max' ELSE '' END AS violations
    FROM v_student_info""")
def contract_quarantine(v: Views) -> DataFrame:
    columns = [*KEYS, F.col("studied_credits").cast("int").alias("studied_credits")]
    good, bad = load_contract("student_info").quarantine(v.student_info)
    return good.select(*columns, F.lit("").alias("violations")).unionByName(
        bad.select(*columns, F.array_join("_violations", ",").alias("violations")))


KEY_CONTRACT = """
name: registration
primary_key: [id_student, code_module, code_presentation]
unique_key: true
columns:
  - {name: id_student, type: long, nullable: false}
  - {name: code_module, type: string, nullable: false}
"""


@query("contract_key_rule", f"""
    SELECT {K}, ord, CASE WHEN count(*) OVER (PARTITION BY {K}) > 1
      THEN 'id_student,code_module,code_presentation:key' ELSE '' END AS violations FROM v_registration""")
def contract_key_rule(v: Views) -> DataFrame:
    """Rows that share a key are kept apart from those whose key is theirs alone."""
    good, bad = parse_contract(KEY_CONTRACT).quarantine(v.registration)
    columns = [*KEYS, "ord"]
    return good.select(*columns, F.lit("").alias("violations")).unionByName(
        bad.select(*columns, F.array_join("_violations", ",").alias("violations")))


@query("pk_violations", """
    SELECT id_student, code_module, code_presentation, id_site, date, count(*) AS n_rows
    FROM v_student_vle GROUP BY ALL HAVING count(*) > 1""")
def pk_violations(v: Views) -> DataFrame:
    return load_contract("student_vle").duplicate_keys(v.student_vle)


@query("pk_violations_compound", """
    SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM v_student_assessment GROUP BY ALL HAVING count(*) > 1""")
def pk_violations_compound(v: Views) -> DataFrame:
    return duplicate_keys(v.student_assessment, ["l_orderkey", "l_linenumber"])


@query("trim_strings", r"""
    SELECT p_partkey, trim(name, E' \t\n\r') AS name, size, trim(raw_num, E' \t\n\r') AS raw_num,
      trim(p_type, E' \t\n\r') AS p_type FROM v_dirty_part""")
def trim_strings(v: Views) -> DataFrame:
    return clean.trim_strings(v.dirty_part)


@query("drop_critical_nulls", "SELECT * FROM v_dirty_part WHERE name IS NOT NULL AND size IS NOT NULL")
def drop_critical_nulls(v: Views) -> DataFrame:
    return clean.drop_critical_nulls(v.dirty_part, ["name", "size", "not_there"])


_MODE = "(SELECT name FROM v_dirty_part WHERE name IS NOT NULL GROUP BY name ORDER BY count(*) DESC, name LIMIT 1)"


@query("fill_missing", f"""
    WITH d AS (SELECT *, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_partkey END AS part_zero,
                 CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_type END AS kind FROM v_dirty_part)
    SELECT p_partkey, coalesce(name, {_MODE}) AS name,
      round(coalesce(CAST(size AS DOUBLE), (SELECT quantile_cont(size, 0.5) FROM v_dirty_part)), 6) AS size,
      raw_num, p_type, coalesce(part_zero, 0) AS part_zero, coalesce(kind, 'missing') AS kind FROM d""")
def fill_missing(v: Views) -> DataFrame:
    holes = v.dirty_part.withColumns({
        "part_zero": F.when(F.col("p_partkey") % 3 != 0, F.col("p_partkey")),
        "kind": F.when(F.col("p_partkey") % 4 != 0, F.col("p_type")),
    })
    return clean.fill_missing(holes, {"name": "mode", "size": "median", "part_zero": "zero", "kind": "missing"})


@query("silver_clean", f"""
    WITH t AS (SELECT p_partkey, trim(name, E' \\t\\n\\r') AS name, size, raw_num, p_type FROM v_dirty_part),
    kept AS (SELECT * FROM t WHERE name IS NOT NULL)
    SELECT p_partkey, name,
      coalesce(CAST(size AS DOUBLE), (SELECT quantile_cont(size, 0.5) FROM kept)) AS size, raw_num, p_type FROM kept""")
def silver_clean(v: Views) -> DataFrame:
    return clean.clean(v.dirty_part, ["p_partkey", "name"], {"size": "median"})


@query("outliers_iqr", """
    WITH q AS (SELECT quantile_cont(sum_click, 0.25) AS q1, quantile_cont(sum_click, 0.75) AS q3 FROM v_student_vle)
    SELECT s.* FROM v_student_vle s CROSS JOIN q
    WHERE sum_click >= q1 - 0.5 * (q3 - q1) AND sum_click <= q3 + 0.5 * (q3 - q1)""")
def outliers_iqr(v: Views) -> DataFrame:
    return clean.remove_outliers_iqr(v.student_vle, "sum_click", 0.5)


@query("outliers_iqr_price", """
    WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem)
    SELECT l_orderkey, l_linenumber, round(l_extendedprice, 6) AS l_extendedprice FROM lineitem CROSS JOIN q
    WHERE l_extendedprice >= q1 - 0.1 * (q3 - q1) AND l_extendedprice <= q3 + 0.1 * (q3 - q1)""")
def outliers_iqr_price(v: Views) -> DataFrame:
    prices = v.spark.read.parquet(f"{v.sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_extendedprice")
    return clean.remove_outliers_iqr(prices, "l_extendedprice", 0.1)


@query("standardise_categories", """
    SELECT id_student, CASE gender WHEN 'M' THEN 'F' WHEN 'F' THEN 'M' ELSE gender END AS gender,
      CASE final_result WHEN 'Distinction' THEN 'Pass' WHEN 'Pass' THEN 'Passed' ELSE final_result END AS final_result
    FROM v_student_info""")
def standardise_categories(v: Views) -> DataFrame:
    mapping = {"gender": {"M": "F", "F": "M"}, "final_result": {"Distinction": "Pass", "Pass": "Passed"}}
    return clean.standardise_categories(v.student_info.select("id_student", "gender", "final_result"), mapping)


@query("encode_label", f"""
    SELECT {K}, final_result, CASE WHEN final_result IN ('Fail', 'Withdrawn') THEN 1 ELSE 0 END AS final_result_binary
    FROM v_student_info""")
def encode_label(v: Views) -> DataFrame:
    return clean.encode_label(v.student_info.select(*KEYS, "final_result"))


VLE_KEYS = [*KEYS, "id_site", "date"]


def _dedup_sql(direction: str) -> str:
    return f"""
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY {', '.join(VLE_KEYS)} ORDER BY ord {direction}) AS rn
      FROM v_student_vle) WHERE rn = 1"""


@query("dedup_keep_last", _dedup_sql("DESC"))
def dedup_keep_last(v: Views) -> DataFrame:
    return clean.deduplicate(v.student_vle, VLE_KEYS, ["ord"], "last")


@query("dedup_keep_first", _dedup_sql("ASC"))
def dedup_keep_first(v: Views) -> DataFrame:
    return clean.deduplicate(v.student_vle, VLE_KEYS, ["ord"], "first")


@query("missingness_profile", """
    WITH d AS (SELECT count(*) AS n, count(p_partkey) AS a, count(name) AS b, count(size) AS c, count(raw_num) AS d,
                 count(p_type) AS e FROM v_dirty_part)
    SELECT "column", n - k AS n_null, round((n - k) / CAST(n AS DOUBLE), 6) AS null_share FROM (
      SELECT 'p_partkey' AS "column", n, a AS k FROM d UNION ALL SELECT 'name', n, b FROM d
      UNION ALL SELECT 'size', n, c FROM d UNION ALL SELECT 'raw_num', n, d FROM d
      UNION ALL SELECT 'p_type', n, e FROM d)""")
def missingness(v: Views) -> DataFrame:
    return missingness_profile(v.dirty_part)


@query("outcome_distribution", """
    SELECT final_result, count(*) AS n,
      round(count(*) / CAST((SELECT count(*) FROM v_student_info WHERE final_result IS NOT NULL) AS DOUBLE), 6) AS share
    FROM v_student_info WHERE final_result IS NOT NULL GROUP BY final_result""")
def outcome_distribution(v: Views) -> DataFrame:
    return profile.distribution(v.student_info, "final_result")


@query("clicks_per_day", """
    SELECT date, CAST(sum(sum_click) AS BIGINT) AS clicks FROM v_student_vle GROUP BY date""")
def clicks_per_day(v: Views) -> DataFrame:
    return profile.clicks_per_day(v.student_vle)


@query("table_profile", """
    SELECT 'student_info' AS "table", count(*) AS n_rows, 12 AS n_columns FROM v_student_info
    UNION ALL SELECT 'student_vle', count(*), 7 FROM v_student_vle
    UNION ALL SELECT 'student_assessment', count(*), 7 FROM v_student_assessment""")
def table_profile(v: Views) -> DataFrame:
    return profile.table_shapes({n: getattr(v, n) for n in ("student_info", "student_vle", "student_assessment")})


@query("table_head", """
    SELECT id_student, region, final_result FROM v_student_info ORDER BY id_student LIMIT 5""")
def table_head(v: Views) -> DataFrame:
    return profile.head(v.student_info.select("id_student", "region", "final_result"), ["id_student"])


@query("dataset_fingerprint", """
    WITH r AS (
      SELECT md5('{"l_orderkey":"' || CAST(l_orderkey AS VARCHAR) || '","l_partkey":"' || CAST(l_partkey AS VARCHAR)
        || '","l_suppkey":"' || CAST(l_suppkey AS VARCHAR) || '","l_linenumber":"' || CAST(l_linenumber AS VARCHAR)
        || '","l_quantity":"' || CAST(l_quantity AS VARCHAR) || '","l_extendedprice":"' || CAST(l_extendedprice AS VARCHAR)
        || '","l_discount":"' || CAST(l_discount AS VARCHAR) || '","l_tax":"' || CAST(l_tax AS VARCHAR)
        || '","l_returnflag":"' || l_returnflag || '","l_linestatus":"' || l_linestatus
        || '","l_shipdate":"' || CAST(l_shipdate AS VARCHAR) || '"}') AS h FROM lineitem)
    SELECT count(*) AS n_rows, CAST(sum(CAST(CAST('0x' || substr(h, 1, 16) AS UBIGINT) AS HUGEINT)) AS VARCHAR) || '-'
      || CAST(sum(CAST(CAST('0x' || substr(h, 17, 16) AS UBIGINT) AS HUGEINT)) AS VARCHAR) AS digest
    FROM r""")
def dataset_fingerprint(v: Views) -> DataFrame:
    return profile.fingerprint(v.spark.read.parquet(f"{v.sf_dir}/lineitem.parquet"))


_ONE_HOT = {
    "gender": ["F", "M"], "age_band": ["0-35", "35-55", "55<="], "disability": ["N", "Y"],
    "region": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
}


@query("one_hot", f"""
    SELECT {K}, imd_band, {', '.join(
        f'''CAST(CASE WHEN {c} = '{x}' THEN 1 ELSE 0 END AS DOUBLE) AS "{c}_{x}"''' for c, xs in _ONE_HOT.items() for x in xs)}
    FROM v_student_info""")
def one_hot(v: Views) -> DataFrame:
    students = v.student_info.select(*KEYS, "imd_band", *_ONE_HOT)
    return encode.apply_one_hot(students, encode.fit_one_hot(students, list(_ONE_HOT)))


@query("ordinal_encode", """
    WITH fitted AS (
      SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS pos
      FROM (SELECT DISTINCT coalesce(imd_band, 'UNK') AS v FROM v_student_info WHERE gender = 'M')),
    edu AS (
      SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS pos
      FROM (SELECT DISTINCT highest_education AS v FROM v_student_info WHERE gender = 'M'))
    SELECT id_student, imd_band, highest_education, coalesce(f.pos, -1) AS imd_band_ord,
      coalesce(e.pos, -1) AS highest_education_ord
    FROM v_student_info LEFT JOIN fitted f ON coalesce(imd_band, 'UNK') = f.v LEFT JOIN edu e ON highest_education = e.v""")
def ordinal_encode(v: Views) -> DataFrame:
    students = v.student_info.select("id_student", "imd_band", "highest_education", "gender")
    columns = ["imd_band", "highest_education"]
    seen = students.filter("gender = 'M'")
    return encode.apply_ordinal(students, encode.fit_ordinal(seen, columns), columns).drop("gender")


_HASH = "md5(concat_ws(':', '{seed}', CAST(id_student AS VARCHAR), code_module, code_presentation))"
_LABELLED = f"""l AS (
      SELECT {K}, CASE WHEN final_result IN ('Fail', 'Withdrawn') THEN 1 ELSE 0 END AS final_result_binary
      FROM v_student_info)"""


def _labelled(v: Views) -> DataFrame:
    return clean.encode_label(v.student_info).select(*KEYS, "final_result_binary")


@query("stratified_split", f"""
    WITH {_LABELLED}, r AS (
      SELECT *, row_number() OVER (PARTITION BY final_result_binary ORDER BY {_HASH.format(seed=42)}) AS rn,
        count(*) OVER (PARTITION BY final_result_binary) AS n FROM l)
    SELECT {K}, final_result_binary, rn <= round(n * 0.2) AS is_test FROM r""")
def stratified_split(v: Views) -> DataFrame:
    return split.stratified_split(_labelled(v), "final_result_binary", 0.2, 42)


@query("stratified_folds", f"""
    WITH {_LABELLED}
    SELECT {K}, final_result_binary,
      CAST(ntile(5) OVER (PARTITION BY final_result_binary ORDER BY {_HASH.format(seed=42)}) AS INT) AS fold FROM l""")
def stratified_folds(v: Views) -> DataFrame:
    return split.stratified_folds(_labelled(v), "final_result_binary", 5, 42)


@query("seeded_sample", f"""
    SELECT {K}, region FROM v_student_info ORDER BY {_HASH.format(seed=0)} LIMIT 100""")
def seeded_sample(v: Views) -> DataFrame:
    return split.seeded_sample(v.student_info.select(*KEYS, "region"), 100, 0)
