"""Column names, feature order and domain constants.

Values under "fixed values" must stay equal to the behaviour being
reproduced (model input order, hub list, thresholds); they are listed
plainly and in their natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ── fixed values ───────────────────────────────────────────────────────
RAW_REQUIRED_COLS = [
    "FL_DATE", "OP_CARRIER", "ORIGIN", "DEST",
    "CRS_DEP_TIME", "CRS_ARR_TIME", "CRS_ELAPSED_TIME",
    "DISTANCE", "DEP_DELAY", "ARR_DELAY",
]

FEATURE_COLS = [
    "dep_hour", "dep_day_of_week", "dep_month",
    "is_weekend", "is_holiday_season",
    "carrier_encoded", "origin_encoded", "dest_encoded",
    "route_distance_km", "scheduled_elapsed_min",
    "dep_time_bucket",
    "is_hub_origin",
    "is_hub_dest",
    "route_id_encoded",
]

TARGET_COL = "delayed"
DELAY_THRESHOLD_MIN = 15.0

HUB_AIRPORTS = [
    "ATL", "ORD", "LAX", "DFW", "DEN", "JFK", "SFO",
    "SEA", "LAS", "MCO", "EWR", "CLT", "PHX", "MIA",
]

HOLIDAY_MONTHS = [6, 7, 11, 12]

HOUR_MIN, HOUR_MAX = 0, 23
TIME_BUCKET_BELOW = [6, 12, 18]     # hour < 6 → 0, < 12 → 1, < 18 → 2, else 3
WEEKEND_FROM_DOW = 5                # Monday = 0: Saturday and Sunday

COLUMN_ALIASES = {"AIRLINE_CODE": "OP_CARRIER"}

MILES_TO_KM = 1.60934
FALLBACK_KM_PER_MIN = 12.0          # elapsed-time fallback: km / 12

# validation thresholds
MIN_ROWS = 100
NOT_ALL_NULL_COLS = ["OP_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME"]
DEP_TIME_MIN, DEP_TIME_MAX = 0, 2359

# scoring tiers (applied to the probability rounded to 4 decimals)
RISK_LOW_BELOW = 0.25
RISK_MEDIUM_BELOW = 0.55
CONFIDENCE_HIGH_FROM = 0.35
CONFIDENCE_MEDIUM_FROM = 0.15

# champion / challenger
MODEL_GROUP = "flight-delay-model-group"
METRIC_TO_COMPARE = "val_f1"
IMPROVEMENT_THRESHOLD = 0.01

# model hyper-parameters (defaults of the training job)
GBT_PARAMS = {"n_estimators": 200, "max_depth": 5, "learning_rate": 0.08,
              "min_samples_leaf": 50, "random_state": 42}

# split / sample defaults
VAL_SIZE = 0.15
TEST_SIZE = 0.15
RANDOM_STATE = 42
REFERENCE_SAMPLE_ROWS = 5000

# quality gates
GATE_ACCURACY, GATE_F1, GATE_AUC = 0.70, 0.55, 0.70

# behaviour check: P(evening flight) ≥ 0.8 × P(morning flight), buckets 1 and 3
BEHAVIOUR_RATIO = 0.8
# ───────────────────────────────────────────────────────────────────────

RAW_SCHEMA = T.StructType([
    T.StructField("FL_DATE", T.StringType()),
    T.StructField("OP_CARRIER", T.StringType()),
    T.StructField("ORIGIN", T.StringType()),
    T.StructField("DEST", T.StringType()),
    T.StructField("CRS_DEP_TIME", T.IntegerType()),
    T.StructField("CRS_ARR_TIME", T.IntegerType()),
    T.StructField("CRS_ELAPSED_TIME", T.DoubleType()),
    T.StructField("DISTANCE", T.DoubleType()),
    T.StructField("DEP_DELAY", T.DoubleType()),
    T.StructField("ARR_DELAY", T.DoubleType()),
])

REQUEST_COLS = ["FL_DATE", "OP_CARRIER", "ORIGIN", "DEST", "CRS_DEP_TIME",
                "CRS_ARR_TIME", "CRS_ELAPSED_TIME", "DISTANCE"]

INT_FEATURES = [c for c in FEATURE_COLS if c != "route_distance_km"]
LONG_FEATURES = ["carrier_encoded", "origin_encoded", "dest_encoded", "route_id_encoded"]
