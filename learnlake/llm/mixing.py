"""Mixing sources to target weights by repetition rates.

Tokens are summed per source, each source gets a target, and the ratio of both is how often its documents are
repeated: floor(rate) times, plus once more with the fraction as probability, drawn from a hash of the document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from learnlake.llm.common import fresh, word_count, written

WEIGHTS = (1, 2, 3)
MAX_REPEATS = 3
SEED = "mix-1"


def _exact(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(38,0)")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from rows (source, size): one row per source, null being one of them.

    Sources by code point, null last, weigh ``WEIGHTS`` in turn and share the sum of all sizes. No target exceeds
    ``MAX_REPEATS`` times its source's size; the excess goes to the others by weight. With sources in the order of
    limit / weight this fills up from the left: a source is at its limit where the level (what is left over the
    weights left) lies above its own ratio. Only one row per source is ordered.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = F.row_number().over(by_name)
    weights = F.array(*map(F.lit, WEIGHTS))
    ranked = totals.withColumn("place", place).withColumn(
        "weight", F.element_at(weights, F.pmod(F.col("place") - 1, F.lit(len(WEIGHTS))) + 1))
    ranked = ranked.withColumn("most", F.col("source_size") * MAX_REPEATS)
    by_ratio = Window.orderBy(F.col("most") / F.col("weight"), "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ranked.select(
        "*", (F.sum(_exact("source_size")).over(everything)
              - F.coalesce(F.sum(_exact("most")).over(before), F.lit(0))).alias("left"),
        F.sum("weight").over(by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("weights_left"))
    limited = (_exact("most") * _exact("weights_left")).cast("double") < (
        _exact("weight") * F.col("left")).cast("double")
    marked = level.withColumn("limited", limited)
    first = F.min(F.when(~F.col("limited"), F.struct(
        F.col("most") / F.col("weight"), "place", "left", "weights_left"))).over(everything)
    shared = (F.col("weight") * first["left"]).cast("double") / first["weights_left"].cast("double")
    return marked.select(
        "source", "source_size", F.when(F.col("limited"), F.col("most").cast("double")).otherwise(shared).alias("target"))


def _draw(doc_id: Column, text: Column) -> Column:
    """A number in [0, 1) from the seed and the id, or the text where there is no id."""
    name = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.md5(F.coalesce(text, F.lit("")))))
    return F.conv(F.substring(F.md5(name), 1, 13), 16, 10).cast("double") / float(1 << 52)


def with_copies(docs: DataFrame, size: Column) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with size, source_size, target and copies, and the names these got.

    ``copies`` is how often the mix takes the row. Rows with the same id are drawn alike.
    """
    names = ("size", "source_size", "target", "copies")
    new = dict(zip(names, fresh(docs, *names), strict=True))
    # Written first, so that Spark knows its size: a table of few sources is broadcast, a large one shuffled.
    targets = written(source_targets(docs.select("source", size.alias("size"))), "source-targets")
    (source,) = fresh(docs, "mix_source")
    targets = targets.toDF(source, new["source_size"], new["target"])
    joined = docs.join(targets, docs["source"].eqNullSafe(targets[source])).drop(source)
    rate = F.when(F.col(new["source_size"]) > 0, F.col(new["target"]) / F.col(new["source_size"])).otherwise(F.lit(0.0))
    extra = (_draw(F.col("doc_id"), F.col("text")) < rate - F.floor(rate)).cast("long")
    return joined.withColumns({new["size"]: size, new["copies"]: F.floor(rate) + extra}), new


def mix_of_documents(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken (size times copies) of every row; sizes are words, null text 0.

    A source without words has target 0. An empty table gives no rows.
    """
    rows, new = with_copies(docs.select("doc_id", "text", "source"), word_count(F.col("text")))
    taken = F.col(new["size"]) * F.col(new["copies"])
    return rows.select("doc_id", *[F.col(new[c]).alias(c) for c in ("size", "source_size", "target")],
                       taken.alias("taken"))


def mixed(docs: DataFrame) -> DataFrame:
    """The mix itself: every document, all columns, as many times as the plan takes it."""
    rows, new = with_copies(docs, word_count(F.col("text")))
    repeated = rows.withColumn(new["copies"], F.explode(F.array_repeat(F.lit(1), F.col(new["copies"]).cast("int"))))
    return repeated.select(*docs.columns)


SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), totals AS (
  SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
  FROM sized GROUP BY source
), ranked AS (
  SELECT *, 1 + (place - 1) % 3 AS weight, 3 * source_size AS most FROM totals
), level AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, place
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights_left
  FROM ranked
), marked AS (
  SELECT *, most * weights_left < weight * rest AS limited FROM level
), targets AS (
  SELECT source, source_size, CASE WHEN limited THEN CAST(most AS DOUBLE) ELSE CAST(weight *
      first_value(rest) OVER (ORDER BY limited, most / weight, place) AS DOUBLE)
      / CAST(first_value(weights_left) OVER (ORDER BY limited, most / weight, place) AS DOUBLE) END AS target
  FROM marked
), rated AS (
  SELECT s.doc_id, s.text, s.size, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN t.target / CAST(t.source_size AS DOUBLE) ELSE 0 END AS rate
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
  CAST(size * (floor(rate) + CASE WHEN CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(doc_id AS VARCHAR),
    md5(coalesce(text, '')))), 1, 13) AS BIGINT) / 4503599627370496.0 < rate - floor(rate) THEN 1 ELSE 0 END)
    AS BIGINT) AS taken
FROM rated
"""
