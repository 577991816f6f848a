"""Evaluation queries: metrics, fairness, calibration, drift, and attribution of a linear score."""

from __future__ import annotations

from pyspark.sql import DataFrame

from learnlake.operators import drift, metrics, split
from learnlake.plans.register import Views, query

# All metrics in SQL over a table m(<by>, y, s); midranks by counting, average precision by running sums.
def metrics_sql(source: str, by: str, select: str, before: str = "") -> str:
    cols = f"{by}, " if by else ""
    part = f"PARTITION BY {by}" if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
    WITH {before} m AS ({source}),
    t AS (SELECT {cols} s, sum(y) AS pos, sum(1 - y) AS neg FROM m GROUP BY {cols} s),
    c AS (SELECT *, sum(pos) OVER w AS tp_to, sum(neg) OVER w AS fp_to FROM t WINDOW w AS ({part} ORDER BY s DESC)),
    a AS (SELECT {cols} sum(CASE WHEN s >= 0.5 THEN pos ELSE 0 END) AS tp, sum(CASE WHEN s >= 0.5 THEN neg ELSE 0 END) AS fp,
            sum(pos) AS p, sum(neg) AS q, sum(neg * (tp_to - pos * CAST(0.5 AS DOUBLE))) AS wins,
            sum(CAST(pos AS DOUBLE) * tp_to / (tp_to + fp_to)) AS ap,
            sum(pos * (1 - s) * (1 - s) + neg * s * s) AS sq FROM c {group}),
    r AS (SELECT {cols} CAST(p + q AS BIGINT) AS n, CAST(tp + q - fp AS DOUBLE) / (p + q) AS accuracy,
            coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
            coalesce(CAST(tp AS DOUBLE) / nullif(p, 0), 0) AS recall,
            coalesce(CAST(2 * tp AS DOUBLE) / nullif(p + tp + fp, 0), 0) AS f1,
            wins / nullif(CAST(p AS DOUBLE) * q, 0) AS roc_auc, coalesce(ap / nullif(p, 0), 0) AS pr_auc,
            sq / (p + q) AS brier FROM a)
    {select}"""


ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in metrics.METRICS)


@query("classification_metrics", metrics_sql("SELECT y, s FROM v_scored", "", f"SELECT n, {ROUNDED} FROM r"))
def classification_metrics(v: Views) -> DataFrame:
    return metrics.classification_metrics(v.scored, "y", "s")


@query("roc_auc", metrics_sql("SELECT y, s FROM v_scored", "", "SELECT round(roc_auc, 6) AS roc_auc FROM r"))
def roc_auc(v: Views) -> DataFrame:
    return metrics.classification_metrics(v.scored, "y", "s").select("roc_auc")


@query("pr_auc", metrics_sql("SELECT y, s FROM v_scored", "", "SELECT round(pr_auc, 6) AS pr_auc FROM r"))
def pr_auc(v: Views) -> DataFrame:
    return metrics.classification_metrics(v.scored, "y", "s").select("pr_auc")


_SHIPPED = """SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y, l_extendedprice / 105000.0 AS s,
    l_linestatus AS slice FROM lineitem"""


def _line_scores(v: Views) -> DataFrame:
    lines = v.spark.read.parquet(f"{v.sf_dir}/lineitem.parquet")
    return lines.selectExpr(
        "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y", "l_extendedprice / 105000D AS s", "l_linestatus AS slice")


@query("ranking_metrics_lines", metrics_sql(
    _SHIPPED.replace("105000.0", "CAST(105000 AS DOUBLE)"), "slice",
    "SELECT slice, n, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc, round(brier, 6) AS brier FROM r"))
def ranking_metrics_lines(v: Views) -> DataFrame:
    scored = metrics.classification_metrics(_line_scores(v), "y", "s", by=["slice"])
    return scored.select("slice", "n", "roc_auc", "pr_auc", "brier")


@query("fairness_by_slice", metrics_sql("""
      SELECT 'slice' AS slice_col, slice AS slice_value, y, s FROM v_scored WHERE slice IS NOT NULL
      UNION ALL SELECT 'source', source, y, s FROM v_scored WHERE source IS NOT NULL
      UNION ALL SELECT 'toxic', CAST(toxic AS VARCHAR), y, s FROM v_scored WHERE toxic IS NOT NULL""",
    "slice_col, slice_value", f"SELECT slice_col, slice_value, n, {ROUNDED} FROM r"))
def fairness_by_slice(v: Views) -> DataFrame:
    return metrics.fairness_metrics(v.scored, "y", "s", ["slice", "source", "toxic"])


_FOLDED = """folded AS (
      SELECT y, s, ntile(5) OVER (PARTITION BY y ORDER BY md5(concat_ws(':', '7', CAST(doc_id AS VARCHAR)))) AS fold
      FROM v_scored),"""


@query("cv_summary", metrics_sql("SELECT fold, y, s FROM folded", "fold", " UNION ALL ".join(
    f"SELECT '{m}' AS metric, round(avg({m}), 6) AS mean, round(stddev_samp({m}), 6) AS std FROM r" for m in metrics.METRICS
), before=_FOLDED))
def cv_summary(v: Views) -> DataFrame:
    folded = split.stratified_folds(v.scored, "y", 5, 7, ["doc_id"])
    return metrics.cv_summary(metrics.classification_metrics(folded, "y", "s", by=["fold"]))


@query("calibration_table", """
    WITH e AS (SELECT quantile_cont(s, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS edges FROM v_scored),
    b AS (SELECT y, s, len(list_filter(list_distinct(edges), lambda x: x <= s)) AS k FROM v_scored CROSS JOIN e)
    SELECT CAST(k + 1 AS INT) AS bin, count(*) AS n, round(avg(s), 6) AS mean_score, round(avg(y), 6) AS positive_share
    FROM b GROUP BY k""")
def calibration_table(v: Views) -> DataFrame:
    return metrics.calibration_table(v.scored, "y", "s")


FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_EDGES = "[0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]"
BINS_SQL = f"""
    e AS ({' UNION ALL '.join(
        f"SELECT '{c}' AS feature, quantile_cont({c}, {_EDGES}) AS edges FROM v_drift WHERE side = 'train'" for c in FEATURES)}),
    long AS ({' UNION ALL '.join(f"SELECT side, '{c}' AS feature, {c} AS x FROM v_drift WHERE {c} IS NOT NULL" for c in FEATURES)}),
    hits AS (SELECT feature, len(list_filter(edges, lambda q: q <= x)) AS bin, side FROM long JOIN e USING (feature)),
    bins AS (
      SELECT feature, CAST(b.bin AS INT) AS bin, count(*) FILTER (side = 'train') AS n_expected,
        count(*) FILTER (side = 'serve') AS n_actual
      FROM e CROSS JOIN range(0, 10) b(bin) LEFT JOIN hits USING (feature, bin) GROUP BY ALL),
    psi AS (
      SELECT feature, sum((a - x) * ln(a / x)) AS psi FROM (
        SELECT feature, n_expected / CAST(sum(n_expected) OVER f AS DOUBLE) + 1e-9 AS x,
          n_actual / CAST(sum(n_actual) OVER f AS DOUBLE) + 1e-9 AS a
        FROM bins WINDOW f AS (PARTITION BY feature)) GROUP BY feature)"""


def _sides(v: Views) -> tuple[DataFrame, DataFrame]:
    lines = v.drift
    return lines.filter("side = 'train'").drop("side"), lines.filter("side = 'serve'").drop("side")


@query("psi_bins", f"WITH {BINS_SQL} SELECT * FROM bins")
def psi_bins(v: Views) -> DataFrame:
    return drift.psi_bins(*_sides(v), FEATURES)


@query("psi", f"WITH {BINS_SQL} SELECT feature, round(psi, 6) AS psi FROM psi")
def psi(v: Views) -> DataFrame:
    return drift.psi(*_sides(v), FEATURES)


@query("drift_report", f"""
    WITH {BINS_SQL} SELECT feature, round(psi, 6) AS psi, psi >= 0.00005 AS drifted FROM psi ORDER BY psi DESC""")
def drift_report(v: Views) -> DataFrame:
    return drift.drift_report(*_sides(v), threshold=0.00005)
