"""Column profiles and exact quantiles.

``feature_profile``: one aggregate over all features → one row per feature.
``exact_quantiles``: value histogram (partial-aggregated) → cumulative
counts per feature (``running_total``: bounded windows, no feature in one
task) → smallest value whose cumulative count reaches ``ceil(p·n)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.running import running_total

from tarmac.schema import FEATURE_COLS

QUANTILES = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]


def _qname(p: float) -> str:
    return "p" + f"{int(round(p * 100)):02d}"


def feature_profile(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature, mean, std, min, max, null_pct) over present columns, 4 decimals."""
    cols = [c for c in (cols or FEATURE_COLS) if c in df.columns]
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.avg(F.col(c).isNull().cast("double")).alias(f"{c}__null")]
    one = df.agg(*aggs)
    r = lambda name: F.bround(F.col(name), 4)
    rows = [F.struct(F.lit(c).alias("feature"), r(f"{c}__mean").alias("mean"),
                     r(f"{c}__std").alias("std"), r(f"{c}__min").alias("min"),
                     r(f"{c}__max").alias("max"), r(f"{c}__null").alias("null_pct"))
            for c in cols]
    return one.select(F.inline(F.array(*rows)))


def _long_values(df: DataFrame, cols: list[str]) -> DataFrame:
    wide = df.select([F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot([], cols, "feature", "value")


def cumulative_counts(long: DataFrame) -> DataFrame:
    """(feature, value, cnt, cum, n): rows of each non-missing value, up to it and of its feature."""
    hist = (long.where(F.col("value").isNotNull())
            .groupBy("feature", "value").agg(F.count(F.lit(1)).alias("cnt")))
    return (running_total(hist, ["feature"], "value", ["cnt"])
            .withColumnsRenamed({"cum_cnt": "cum", "total_cnt": "n"}))


def quantile(p: float) -> Column:
    """Inverted-CDF quantile of a feature's ``cumulative_counts`` (an aggregate)."""
    return F.min(F.when(F.col("cum") >= F.greatest(F.ceil(F.lit(p) * F.col("n")), F.lit(1)), F.col("value")))


def exact_quantiles(df: DataFrame, cols: list[str] | None = None,
                    probs: list[float] = QUANTILES) -> DataFrame:
    """(feature, n, p01 … p99): inverted-CDF quantiles over non-missing values."""
    cols = [c for c in (cols or FEATURE_COLS) if c in df.columns]
    return quantiles_of(cumulative_counts(_long_values(df, cols)), probs)


def quantiles_of(cum: DataFrame, probs: list[float] = QUANTILES) -> DataFrame:
    """``exact_quantiles`` from ``cumulative_counts``."""
    return cum.groupBy("feature").agg(F.max("n").cast("long").alias("n"),
                                      *[quantile(p).alias(_qname(p)) for p in probs])


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(column, nulls, all_null) per column — one aggregate job."""
    cols = cols or df.columns
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols])
    rows = [F.struct(F.lit(c).alias("column"), F.col(c).cast("long").alias("nulls"),
                     (F.col(c) == F.col("_n")).alias("all_null")) for c in cols]
    return one.select(F.inline(F.array(*rows)))


def type_rules(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature, integral): are all values of a column whole numbers (false without values)."""
    cols = [c for c in (cols or FEATURE_COLS) if c in df.columns]
    x = {c: F.col(c).cast("double") for c in cols}
    one = df.agg(*[F.every(x[c] == F.floor(x[c])).alias(c) for c in cols])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.coalesce(c, F.lit(False)).alias("integral"))
                                         for c in cols])))


def baseline_constraints(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """(feature, completeness, non_negative, min, max): the rules a baseline suggests."""
    cols = [c for c in (cols or FEATURE_COLS) if c in df.columns]
    one = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(c).alias(f"{c}__nn") for c in cols],
                 *[F.min(F.col(c).cast("double")).alias(f"{c}__min") for c in cols],
                 *[F.max(F.col(c).cast("double")).alias(f"{c}__max") for c in cols])
    rows = [F.struct(F.lit(c).alias("feature"),
                     F.bround(F.try_divide(F.col(f"{c}__nn"), F.col("_n")), 4).alias("completeness"),
                     F.coalesce(F.col(f"{c}__min") >= 0, F.lit(True)).alias("non_negative"),
                     F.col(f"{c}__min").alias("min"), F.col(f"{c}__max").alias("max"))
            for c in cols]
    return one.select(F.inline(F.array(*rows)))
