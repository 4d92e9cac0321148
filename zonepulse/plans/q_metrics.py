"""Queries for evaluation metrics on the ``scored`` view (rows 89-96)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..sources.tables import load_view
from .registry import register

R = 8  # doubles are rounded to 8 places on both sides

CONF = """(SELECT CAST(count(*) FILTER (WHERE label = 0 AND pred = 0) AS BIGINT) AS tn,
  CAST(count(*) FILTER (WHERE label = 0 AND pred = 1) AS BIGINT) AS fp,
  CAST(count(*) FILTER (WHERE label = 1 AND pred = 0) AS BIGINT) AS fn,
  CAST(count(*) FILTER (WHERE label = 1 AND pred = 1) AS BIGINT) AS tp FROM scored)"""


def _d(a, b):
    return f"CASE WHEN ({b}) = 0 THEN 0.0 ELSE ({a}) / CAST(({b}) AS DOUBLE) END"


def _round(df):
    return df.select(*[F.round(c, R).alias(c) if t == "double" else F.col(c)
                       for c, t in df.dtypes])


@register("met_confusion", f"SELECT * FROM {CONF}", ("scored",))
def met_confusion(spark, sf):
    return M.confusion(load_view(spark, sf, "scored"))


@register("met_basic", f"""
SELECT round({_d('tp + tn', 'tn + fp + fn + tp')}, {R}) AS accuracy,
  round({_d('tp', 'tp + fp')}, {R}) AS precision, round({_d('tp', 'tp + fn')}, {R}) AS recall,
  round({_d('2 * tp', '2 * tp + fp + fn')}, {R}) AS f1 FROM {CONF}""", ("scored",))
def met_basic(spark, sf):
    return _round(M.basic(load_view(spark, sf, "scored")))


CLASS_SQL = f"""
WITH c AS (SELECT *, tn + fp + fn + tp AS n,
  {_d('tp', 'tp + fp')} AS p1, {_d('tp', 'tp + fn')} AS r1, {_d('2 * tp', '2 * tp + fp + fn')} AS f1,
  {_d('tn', 'tn + fn')} AS p0, {_d('tn', 'tn + fp')} AS r0, {_d('2 * tn', '2 * tn + fp + fn')} AS f0,
  tp + fn AS s1, tn + fp AS s0 FROM {CONF})
SELECT '0' AS class, round(p0, {R}) AS precision, round(r0, {R}) AS recall, round(f0, {R}) AS f1_score,
  CAST(s0 AS DOUBLE) AS support FROM c
UNION ALL SELECT '1', round(p1, {R}), round(r1, {R}), round(f1, {R}), CAST(s1 AS DOUBLE) FROM c
UNION ALL SELECT 'accuracy', NULL, NULL, round({_d('tp + tn', 'n')}, {R}), CAST(n AS DOUBLE) FROM c
UNION ALL SELECT 'macro avg', round((p0 + p1) / 2, {R}), round((r0 + r1) / 2, {R}),
  round((f0 + f1) / 2, {R}), CAST(n AS DOUBLE) FROM c
UNION ALL SELECT 'weighted avg', round({_d('p0 * s0 + p1 * s1', 'n')}, {R}),
  round({_d('r0 * s0 + r1 * s1', 'n')}, {R}), round({_d('f0 * s0 + f1 * s1', 'n')}, {R}),
  CAST(n AS DOUBLE) FROM c"""


@register("met_class_report", CLASS_SQL, ("scored",))
def met_class_report(spark, sf):
    return _round(M.class_report(load_view(spark, sf, "scored")))


@register("met_class_pr", f"SELECT class, precision, recall FROM ({CLASS_SQL}) WHERE class IN ('0', '1')",
          ("scored",))
def met_class_pr(spark, sf):
    return _round(M.class_pr(load_view(spark, sf, "scored")))


@register("met_roc_auc", f"""
SELECT round(sum(CASE WHEN p.p1 > n.p1 THEN 1.0 WHEN p.p1 = n.p1 THEN 0.5 ELSE 0.0 END)
             / (count(DISTINCT p.record_id) * count(DISTINCT n.record_id)), {R}) AS roc_auc
FROM (SELECT * FROM scored WHERE label = 1) p, (SELECT * FROM scored WHERE label = 0) n""",
          ("scored",))
def met_roc_auc(spark, sf):
    return _round(M.roc_auc(load_view(spark, sf, "scored")))


CUM = """(SELECT p1 AS score,
   sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg,
   sum(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)) OVER (ORDER BY p1 DESC) AS tp,
   sum(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END)) OVER (ORDER BY p1 DESC) AS fp,
   sum(sum(CASE WHEN label = 1 THEN 1 ELSE 0 END)) OVER () AS P,
   sum(sum(CASE WHEN label = 1 THEN 0 ELSE 1 END)) OVER () AS N
 FROM scored GROUP BY p1)"""


@register("met_avg_precision", f"""
SELECT round(sum(pos / P * (tp / (tp + fp))), {R}) AS avg_precision FROM {CUM}""", ("scored",))
def met_avg_precision(spark, sf):
    return _round(M.avg_precision(load_view(spark, sf, "scored")))


@register("met_roc_curve", f"""
SELECT round(fp / N, {R}) AS fpr, round(tp / P, {R}) AS tpr, score AS threshold FROM {CUM}""",
          ("scored",))
def met_roc_curve(spark, sf):
    return _round(M.roc_curve(load_view(spark, sf, "scored")))


@register("met_pr_curve", f"""
SELECT round(tp / (tp + fp), {R}) AS precision, round(tp / P, {R}) AS recall, score AS threshold
FROM {CUM}""", ("scored",))
def met_pr_curve(spark, sf):
    return _round(M.pr_curve(load_view(spark, sf, "scored")))
