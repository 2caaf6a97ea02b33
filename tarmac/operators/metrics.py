"""Classification metrics as aggregates.

``binary_metrics``: confusion counts by ``sum(when)`` and ratios with
zero-division → 0, optionally per segment.
``roc_auc``: exact Mann–Whitney AUC with half credit for ties. Scores
are aggregated to (score → positives, negatives); negatives below each
score come from ``running_total`` (bounded windows over score
ranges), so no task holds all distinct scores of a segment. All sums
are integers (DECIMAL, as twice positives times negatives passes 2^63 at a few
billion rows); the single division happens last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.tiers import round4
from tarmac.operators.running import running_total


def _ratio(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def binary_metrics(df: DataFrame, label: str, pred: str, by: list[str] | None = None) -> DataFrame:
    by = by or []
    y, p = F.col(label), F.col(pred)
    counts = (df.groupBy(*by) if by else df.groupBy()).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
        F.sum(((y == 0) & (p == 1)).cast("long")).alias("fp"),
        F.sum(((y == 1) & (p == 0)).cast("long")).alias("fn"),
        F.sum(((y == 0) & (p == 0)).cast("long")).alias("tn"),
    )
    tp, fp, fn, tn, n = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn", "n"))
    precision = _ratio(tp, tp + fp)
    recall = _ratio(tp, tp + fn)
    f1 = _ratio(2 * tp, 2 * tp + fp + fn)
    return counts.select(*by, "n", "tp", "fp", "fn", "tn",
                         round4(_ratio(tp + tn, n)).alias("accuracy"),
                         round4(precision).alias("precision"),
                         round4(recall).alias("recall"),
                         round4(f1).alias("f1"))


def roc_auc(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """(by…, positives, negatives, auc) — any real-valued score."""
    by = by or []
    y = F.col(label)
    per_score = (df.where(F.col(score).isNotNull() & y.isNotNull())
                 .groupBy(*by, score).agg(F.sum((y == 1).cast("long")).alias("pos"),
                                          F.sum((y != 1).cast("long")).alias("neg")))
    return _auc_from_scores(per_score, by, score, [])


def _auc_from_scores(per_score: DataFrame, by: list[str], score: str, extra: list[str]) -> DataFrame:
    """Mann–Whitney sum over a (by…, score) → pos, neg (+ extra counts) table."""
    r = running_total(per_score, by, score, ["neg"])
    below = F.col("cum_neg") - F.col("neg")                  # negatives with a lower score
    wide = "decimal(19,0)"
    u2 = F.col("pos").cast(wide) * (2 * below.cast("decimal(18,0)") + F.col("neg")).cast(wide)  # ties: half
    agg = (r.groupBy(*by) if by else r.groupBy()).agg(
        F.sum("pos").cast("long").alias("positives"),
        F.sum("neg").cast("long").alias("negatives"),
        *[F.sum(c).cast("long").alias(c) for c in extra],
        F.sum(u2.cast("decimal(38,0)")).alias("_u2"))
    auc = F.try_divide(F.col("_u2").cast("double"),
                       2.0 * F.col("positives").cast("double") * F.col("negatives").cast("double"))
    return agg.select(*by, "positives", "negatives", *extra, round4(auc).alias("auc"))


def positive_rate(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.sum(F.col(label)).cast("long").alias("positives"),
                  round4(F.avg(F.col(label).cast("double"))).alias("positive_rate"))


def batch_summary(pred: DataFrame, delayed: str = "delayed") -> DataFrame:
    return pred.agg(F.count(F.lit(1)).alias("total"),
                    F.coalesce(F.sum(delayed), F.lit(0)).cast("long").alias("delayed_count"))


def classification_report(df: DataFrame, label: str, score: str, pred: str,
                          by: list[str] | None = None) -> DataFrame:
    """Confusion counts, ratios and AUC in one aggregation chain (one row per segment).

    The per-score table carries the confusion counts of its rows, so the
    final aggregate yields both the counts and the Mann–Whitney sum.
    """
    by = by or []
    y, p = F.col(label), F.col(pred)
    per_score = (df.where(F.col(score).isNotNull() & y.isNotNull())
                 .groupBy(*by, score).agg(
                     F.sum((y == 1).cast("long")).alias("pos"),
                     F.sum((y != 1).cast("long")).alias("neg"),
                     F.sum(((y == 1) & (p == 1)).cast("long")).alias("tp"),
                     F.sum(((y != 1) & (p == 1)).cast("long")).alias("fp"),
                     F.sum(((y == 1) & (p != 1)).cast("long")).alias("fn"),
                     F.sum(((y != 1) & (p != 1)).cast("long")).alias("tn")))
    g = _auc_from_scores(per_score, by, score, ["tp", "fp", "fn", "tn"])
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    return g.select(*by, n.cast("long").alias("n"), "tp", "fp", "fn", "tn",
                    round4(_ratio(tp + tn, n)).alias("accuracy"),
                    round4(_ratio(tp, tp + fp)).alias("precision"),
                    round4(_ratio(tp, tp + fn)).alias("recall"),
                    round4(_ratio(2 * tp, 2 * tp + fp + fn)).alias("f1"),
                    "auc")
