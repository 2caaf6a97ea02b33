"""Label creation and the feature projection (row count is preserved)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions import features as fx
from tarmac.operators.encode import FrequencyModel, fit_frequencies
from tarmac.schema import FEATURE_COLS, TARGET_COL
from tarmac.sources.csv_landing import normalize_columns


def create_target(df: DataFrame) -> DataFrame:
    """Drop cancelled flights (ARR_DELAY missing) and add ``delayed``."""
    return (df.where(F.col("ARR_DELAY").isNotNull() & ~F.isnan("ARR_DELAY"))
              .withColumn(TARGET_COL, fx.delayed_label()))


CODE_COLS = ("OP_CARRIER", "ORIGIN", "DEST")


def base_features(df: DataFrame, canonicalise: bool = True) -> DataFrame:
    """All features that need no fitted state, as one projection. Codes are trimmed and
    upper-cased, as for scoring, unless ``canonicalise`` is off."""
    df = normalize_columns(df)
    if canonicalise:
        df = df.withColumns({c: fx.canonical_code(c) for c in CODE_COLS if c in df.columns})
    d = fx.parse_flight_date("FL_DATE")
    return (df.withColumn("_date", d)
              .withColumns({
                  "dep_hour": fx.dep_hour("CRS_DEP_TIME"),
                  "dep_day_of_week": fx.day_of_week("_date"),
                  "dep_month": fx.month_of("_date"),
              })
              .withColumns({
                  "is_weekend": fx.weekend_flag("dep_day_of_week"),
                  "is_holiday_season": fx.holiday_flag("dep_month"),
                  "dep_time_bucket": fx.time_bucket("dep_hour"),
                  "route": fx.route_key("ORIGIN", "DEST"),
                  "route_distance_km": fx.distance_km("DISTANCE"),
                  "is_hub_origin": fx.hub_flag("ORIGIN"),
                  "is_hub_dest": fx.hub_flag("DEST"),
              })
              .withColumn("scheduled_elapsed_min",
                          fx.elapsed_minutes("CRS_ELAPSED_TIME", "route_distance_km"))
              .drop("_date"))


def engineer_features(df: DataFrame, encoder: FrequencyModel | None = None,
                      keep: list[str] | None = None) -> DataFrame:
    """Raw rows → ``keep`` + FEATURE_COLS (+ ``delayed`` when present).

    With no ``encoder`` the frequencies are fitted on ``df`` itself (the
    per-frame behaviour); pass a fitted model to encode with train counts.
    """
    keep = [c for c in (keep or []) if c in df.columns]
    base = base_features(df)
    model = encoder or fit_frequencies(base)
    enc = model.transform(base)
    out = keep + FEATURE_COLS + ([TARGET_COL] if TARGET_COL in enc.columns else [])
    return enc.select(*out)
