"""Learning tables expressed over the star-schema tables the queries are registered on.

One SQL body per view. ``@DAYS(a; b)`` (whole days from b to a) and ``@JSONK(x)`` (member ``k`` of a
JSON text) are the only places where Spark SQL and ANSI/DuckDB SQL spell things differently.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ["region", "nation", "customer", "part", "orders", "lineitem", "events", "documents", "labels"]

VIEWS = {
    "student_info": """
        SELECT c_custkey AS id_student, 'M' || CAST(c_custkey % 4 AS STRING) AS code_module,
          'P' || CAST(c_custkey % 3 AS STRING) AS code_presentation,
          CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender, r_name AS region, n_name AS highest_education,
          CASE WHEN c_acctbal >= 0 THEN CAST(CAST(floor(c_acctbal / 1000) AS INT) AS STRING) || '0%' END AS imd_band,
          CASE c_custkey % 3 WHEN 0 THEN '0-35' WHEN 1 THEN '35-55' ELSE '55<=' END AS age_band,
          CAST(c_custkey % 4 AS INT) AS num_of_prev_attempts, CAST(floor(abs(c_acctbal) / 20) AS INT) AS studied_credits,
          CASE WHEN c_custkey % 10 = 0 THEN 'Y' ELSE 'N' END AS disability,
          CASE c_mktsegment WHEN 'FURNITURE' THEN 'Fail' WHEN 'MACHINERY' THEN 'Withdrawn'
                            WHEN 'BUILDING' THEN 'Distinction' ELSE 'Pass' END AS final_result
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "registration": """
        SELECT o_custkey AS id_student, 'M' || CAST(o_custkey % 4 AS STRING) AS code_module,
          'P' || CAST(o_custkey % 3 AS STRING) AS code_presentation,
          @DAYS(o_orderdate; DATE '1998-01-01') AS date_registration,
          CASE WHEN o_orderstatus = 'F' THEN @DAYS(o_orderdate; DATE '1998-01-01') + 100 END AS date_unregistration,
          o_orderkey AS ord
        FROM orders""",
    "assessments": """
        SELECT 'M' || CAST(p_partkey % 4 AS STRING) AS code_module, 'P' || CAST(p_partkey % 3 AS STRING) AS code_presentation,
          p_partkey AS id_assessment,
          CASE p_partkey % 3 WHEN 0 THEN 'TMA' WHEN 1 THEN 'CMA' ELSE 'Exam' END AS assessment_type,
          CASE WHEN p_size < 50 THEN p_size * 4 END AS date, CAST(p_size AS DOUBLE) AS weight
        FROM part""",
    "student_assessment": """
        SELECT l_partkey AS id_assessment, o_custkey AS id_student,
          abs(@DAYS(l_shipdate; o_orderdate)) % 240 AS date_submitted, 0 AS is_banked,
          CASE WHEN l_discount > 0 THEN l_quantity * 2 END AS score, l_orderkey, l_linenumber
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "student_vle": """
        SELECT 'M' || CAST(user_id % 4 AS STRING) AS code_module, 'P' || CAST(user_id % 3 AS STRING) AS code_presentation,
          user_id AS id_student, CAST(@JSONK(props) AS INT) AS id_site, @DAYS(ts; DATE '2024-01-03') AS date,
          CAST(floor(value) AS INT) AS sum_click, event_id AS ord
        FROM events""",
    "vle": "SELECT p_partkey AS id_site, p_type AS activity_type FROM part",
    "scored": """
        SELECT doc_id, quality AS y, least(n_chars / CAST(20000 AS DOUBLE), CAST(1 AS DOUBLE)) AS s,
          lang AS slice, source, toxic
        FROM labels JOIN documents USING (doc_id)""",
    "drift": """
        SELECT CASE WHEN l_shipdate < TIMESTAMP '1998-01-01 00:00:00' THEN 'train' ELSE 'serve' END AS side,
          l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem""",
    "dirty_part": """
        SELECT p_partkey, CASE WHEN p_partkey % 7 <> 0 THEN '  ' || p_name || chr(9) END AS name,
          CASE WHEN p_partkey % 5 <> 0 THEN p_size END AS size,
          CASE WHEN p_partkey % 11 = 0 THEN 'x' WHEN p_partkey % 13 = 0 THEN '3.7' ELSE CAST(p_size AS STRING) END AS raw_num,
          p_type
        FROM part""",
}

_SPARK = {
    "DAYS": "datediff(CAST({0} AS DATE), CAST({1} AS DATE))",
    "JSONK": "get_json_object({0}, '$.k')",
}
_DUCKDB = {
    "DAYS": "CAST(date_diff('day', CAST({1} AS DATE), CAST({0} AS DATE)) AS INT)",
    "JSONK": "json_extract_string({0}, '$.k')",
}


def _expand(sql: str, macros: dict[str, str]) -> str:
    def fill(match: re.Match) -> str:
        return macros[match[1]].format(*(arg.strip() for arg in match[2].split(";")))

    return re.sub(r"@(\w+)\(([^)]*)\)", fill, sql)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One learning table as a lazy frame over the parquet tables in ``sf_dir``."""
    sql = _expand(VIEWS[name], _SPARK)
    used = [t for t in TABLES if re.search(rf"(FROM|JOIN) {t}\b", sql)]
    frames = {t: table(spark, sf_dir, t) for t in used}
    for t in used:
        sql = re.sub(rf"(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
    return spark.sql(sql, **frames)


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the views it mentions (as ``v_<name>``), in DuckDB spelling."""
    used = [name for name in VIEWS if re.search(rf"\bv_{name}\b", sql)]
    ctes = [f"v_{name} AS ({_expand(VIEWS[name], _DUCKDB)})" for name in used]
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body
