"""Source and sink queries: CSV and parquet round trips, provenance, event parsing and streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from learnlake import KEYS
from learnlake.operators.clean import deduplicate
from learnlake.plans.feature_queries import gold, gold_sql
from learnlake.plans.register import Views, query
from learnlake.session import shared_path
from learnlake.sources import events, tables
from learnlake.streaming import bronze


def _csv_folder(v: Views, df: DataFrame) -> str:
    path = shared_path(v.spark, "csv")
    df.write.option("header", True).csv(path)
    return path


@query("csv_roundtrip", "SELECT * FROM v_student_info")
def csv_roundtrip(v: Views) -> DataFrame:
    students = v.student_info
    return tables.read_csv(v.spark, _csv_folder(v, students), students.schema)


@query("csv_inferred_types", """
    SELECT * REPLACE (CAST(num_of_prev_attempts AS BIGINT) AS num_of_prev_attempts,
                      CAST(studied_credits AS BIGINT) AS studied_credits) FROM v_student_info""")
def csv_inferred_types(v: Views) -> DataFrame:
    return tables.read_csv(v.spark, _csv_folder(v, v.student_info))


@query("provenance_stamp", """
    SELECT *, 'studentRegistration.csv' AS _source_file, 'course_csv' AS _source_system, true AS stamped
    FROM v_registration""")
def provenance_stamp(v: Views) -> DataFrame:
    rows = v.registration
    raw = tables.read_csv(v.spark, _csv_folder(v, rows), rows.schema)
    stamped = tables.stamp_provenance(raw, "course_csv", "studentRegistration.csv")
    place = F.col("_ingest_ts").isNotNull() & F.col("_source_block").isNotNull() & F.col("_ingest_seq").isNotNull()
    return stamped.withColumn("stamped", place).drop(
        "_ingest_ts", "_source_path", "_source_block", "_ingest_seq")


@query("bronze_file_order_dedup", """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY id_student ORDER BY ord DESC) AS rn FROM v_registration) WHERE rn = 1""")
def bronze_file_order_dedup(v: Views) -> DataFrame:
    """Keep-last over a CSV written in ``ord`` order: file order must equal ``ord`` order."""
    rows = v.registration
    path = shared_path(v.spark, "ordered-csv")
    rows.orderBy("ord").write.option("header", True).csv(path)
    stamped = tables.stamp_provenance(tables.read_csv(v.spark, path, rows.schema), "course_csv")
    return deduplicate(stamped, ["id_student"], tables.FILE_ORDER).select(*rows.columns)


@query("csv_quoted_fields", """
    SELECT doc_id, CASE WHEN doc_id % 7 > 0 THEN 'say "' || replace(text, chr(10), ' ') || '", you' END AS txt,
      CASE WHEN doc_id % 5 > 0 THEN n_chars END AS n_chars FROM documents""")
def csv_quoted_fields(v: Views) -> DataFrame:
    """Quotes, commas and missing-value texts survive the way through a file, and the columns next to them too.

    Whole texts with their line breaks make that way, one task per file; here the breaks become spaces afterwards.
    """
    return quoted_texts(v, True).withColumn("txt", F.replace("txt", F.lit("\n"), F.lit(" ")))


def quoted_texts(v: Views, multi_line: bool | str) -> DataFrame:
    """(doc_id, txt, n_chars) of the documents, written as CSV and read again."""
    docs = v.spark.read.parquet(f"{v.sf_dir}/documents.parquet")
    path = shared_path(v.spark, "quoted-csv")
    docs.select(
        "doc_id", F.when(F.col("doc_id") % 7 > 0, F.concat(F.lit('say "'), "text", F.lit('", you'))).otherwise("NA").alias("txt"),
        F.when(F.col("doc_id") % 5 > 0, F.col("n_chars").cast("string")).otherwise("NaN").alias("n_chars"),
    ).write.options(header=True, escape='"').csv(path)
    return tables.read_csv(v.spark, path, multi_line=multi_line)


@query("csv_whole_texts", """
    SELECT doc_id, CASE WHEN doc_id % 7 > 0 THEN 'say "' || text || '", you' END AS txt,
      CASE WHEN doc_id % 5 > 0 THEN n_chars END AS n_chars FROM documents""")
def csv_whole_texts(v: Views) -> DataFrame:
    """The same on whole texts with their line breaks, by splits of the files."""
    return quoted_texts(v, "split")


@query("csv_long_ids", """
    SELECT 1234567890123456000 + doc_id AS id, '9876543210987654321' || doc_id AS beyond FROM documents""")
def csv_long_ids(v: Views) -> DataFrame:
    """Ids of 19 digits are read exactly; numbers beyond a long stay text."""
    docs = v.spark.read.parquet(f"{v.sf_dir}/documents.parquet")
    path = shared_path(v.spark, "long-ids-csv")
    beyond = F.concat(F.lit("9876543210987654321"), F.col("doc_id").cast("string"))
    docs.select((F.lit(1234567890123456000) + F.col("doc_id")).alias("id"), beyond.alias("beyond")).write.csv(path, header=True)
    return tables.read_csv(v.spark, path)


@query("bronze_parts_keep_last", """
    SELECT * EXCLUDE (rn) FROM (
      SELECT *, row_number() OVER (PARTITION BY id_student ORDER BY ord DESC) AS rn FROM v_registration) WHERE rn = 1""")
def bronze_parts_keep_last(v: Views) -> DataFrame:
    """Keep-last over a landed folder whose later parts are larger, which Spark reads first."""
    rows = v.registration
    root = shared_path(v.spark, "parts")
    padded = rows.orderBy("ord").withColumn("pad", F.repeat(F.lit("x"), F.spark_partition_id() * 50))
    padded.write.option("header", True).csv(f"{root}/registration.csv")
    landed = tables.ingest_csv(v.spark, root, f"{root}/bronze", ["registration.csv"], {"registration": padded.schema})
    bronze = tables.read_parquet(v.spark, landed["registration"])
    return deduplicate(bronze, ["id_student"], tables.FILE_ORDER).select(*rows.columns)


@query("gold_partitioned_roundtrip", gold_sql(
    f"SELECT {', '.join(KEYS)}, region, total_clicks, n_assessments_submitted, final_result_binary FROM gold"))
def gold_partitioned_roundtrip(v: Views) -> DataFrame:
    path = tables.write_gold(gold(v), shared_path(v.spark, "gold"))
    return tables.read_gold(v.spark, path).select(
        *KEYS, "region", "total_clicks", "n_assessments_submitted", "final_result_binary")


def _messages(v: Views) -> DataFrame:
    """Event messages as JSON text, every thirteenth cut short, from the events table."""
    clicks = v.student_vle.join(
        v.spark.read.parquet(f"{v.sf_dir}/events.parquet").selectExpr("event_id AS ord", "ts", "event_type"), "ord")
    text = F.to_json(F.struct(
        "id_student", "event_type", "code_module", "code_presentation", "id_site",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"),
        F.to_json(F.struct(F.col("sum_click").alias("duration"))).alias("payload")))
    return clicks.select(F.when(F.col("ord") % 13 == 0, F.substring(text, 1, 20)).otherwise(text).alias("value"))


_PARSED_SQL = """
    SELECT CASE WHEN ok THEN id_student END AS id_student, CASE WHEN ok THEN event_type END AS event_type,
      CASE WHEN ok THEN code_module END AS code_module, CASE WHEN ok THEN code_presentation END AS code_presentation,
      CASE WHEN ok THEN CAST(id_site AS BIGINT) END AS id_site,
      CASE WHEN ok THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS ts,
      CASE WHEN ok THEN CAST(sum_click AS BIGINT) END AS duration, NOT ok AS is_bad
    FROM (SELECT s.*, e.ts, e.event_type, s.ord % 13 <> 0 AS ok FROM v_student_vle s JOIN events e ON e.event_id = s.ord)"""


def _flat(parsed: DataFrame, *extra: str) -> DataFrame:
    return parsed.select(
        "id_student", "event_type", "code_module", "code_presentation", "id_site",
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("ts"), F.col("payload.duration").alias("duration"),
        F.col("_bad_message").isNotNull().alias("is_bad"), *extra)


@query("event_payload_parse", _PARSED_SQL)
def event_payload_parse(v: Views) -> DataFrame:
    return _flat(events.parse_events(_messages(v)))


def landed_events(v: Views) -> str:
    """Run the stream to its end over a folder of message files; returns the Bronze path."""
    inbox, target = shared_path(v.spark, "inbox"), shared_path(v.spark, "bronze-events")
    _messages(v).write.text(inbox)
    stream = bronze.bronze_events(bronze.file_source(v.spark, inbox), "lms.events")
    bronze.land(stream, target, shared_path(v.spark, "stream-checkpoint"), available_now=True).awaitTermination()
    return target


@query("stream_bronze_landing", f"""
    SELECT *, 'lms.events' AS _source_file, 'lms_events' AS _source_system FROM ({_PARSED_SQL})""")
def stream_bronze_landing(v: Views) -> DataFrame:
    return _flat(tables.read_parquet(v.spark, landed_events(v)), "_source_file", "_source_system")
