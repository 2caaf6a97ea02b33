"""Feature expressions: the boundary cases of the original feature tests."""

from pyspark.sql import functions as F

from conftest import base_row, raw_rows
from tarmac.operators.featurize import base_features, create_target, engineer_features
from tarmac.schema import FEATURE_COLS, TARGET_COL


def test_label_boundaries(spark):
    df = raw_rows(spark, [base_row(ARR_DELAY=v) for v in (15.0, 14.9, -20.0, None)])
    out = create_target(df).select("ARR_DELAY", TARGET_COL).collect()
    assert sorted((r[0], r[1]) for r in out) == [(-20.0, 0), (14.9, 0), (15.0, 1)]


def test_nan_arr_delay_is_cancelled(spark):
    df = raw_rows(spark, [base_row(ARR_DELAY=float("nan")), base_row(ARR_DELAY=20.0)])
    assert create_target(df).count() == 1


def test_dep_hour(spark):
    df = raw_rows(spark, [base_row(CRS_DEP_TIME=t) for t in (0, 900, 1430, 2359)])
    got = [r[0] for r in base_features(df).select("dep_hour").collect()]
    assert sorted(got) == [0, 9, 14, 23]


def test_time_buckets(spark):
    hours = [0, 3, 5, 6, 11, 12, 17, 18, 23]
    df = raw_rows(spark, [base_row(CRS_DEP_TIME=h * 100) for h in hours])
    got = sorted((r[0], r[1]) for r in base_features(df).select("dep_hour", "dep_time_bucket").collect())
    assert [b for _, b in got] == [0, 0, 0, 1, 1, 2, 2, 3, 3]


def test_missing_hour_bucket_is_evening(spark):
    df = raw_rows(spark, [base_row(CRS_DEP_TIME=None)])
    r = base_features(df).select("dep_hour", "dep_time_bucket").first()
    assert r[0] is None and r[1] == 3


def test_weekend(spark):
    df = raw_rows(spark, [base_row(FL_DATE="17-02-2024"), base_row(FL_DATE="19-02-2024")])
    got = {r[0]: r[1] for r in base_features(df).select("FL_DATE", "is_weekend").collect()}
    assert got == {"17-02-2024": 1, "19-02-2024": 0}


def test_day_of_week_monday_zero(spark):
    df = raw_rows(spark, [base_row(FL_DATE="19-02-2024")])
    assert base_features(df).select("dep_day_of_week").first()[0] == 0


def test_months_and_holiday(spark):
    rows = [base_row(FL_DATE=f"15-{m:02d}-2024") for m in range(1, 13)]
    got = dict(base_features(raw_rows(spark, rows)).select("dep_month", "is_holiday_season").collect())
    assert {m for m, h in got.items() if h == 1} == {6, 7, 11, 12}
    assert set(got) == set(range(1, 13))


def test_bad_date(spark):
    r = base_features(raw_rows(spark, [base_row(FL_DATE="not-a-date")])).first()
    assert r["dep_day_of_week"] is None and r["dep_month"] is None
    assert r["is_weekend"] == 0 and r["is_holiday_season"] == 0


def test_iso_date_not_swapped(spark):
    r = base_features(raw_rows(spark, [base_row(FL_DATE="2024-02-05")])).first()
    assert r["dep_month"] == 2


def test_hubs(spark):
    rows = [base_row(ORIGIN=a, DEST=a) for a in ("ATL", "ORD", "JFK", "LAX", "DFW", "BZN")]
    got = dict(base_features(raw_rows(spark, rows)).select("ORIGIN", "is_hub_origin").collect())
    assert got == {"ATL": 1, "ORD": 1, "JFK": 1, "LAX": 1, "DFW": 1, "BZN": 0}


def test_km(spark):
    r = base_features(raw_rows(spark, [base_row(DISTANCE=1000.0)])).first()
    assert r["route_distance_km"] == 1609.3


def test_elapsed_fallback_half_even(spark):
    # 18.0 km / 12 = 1.5 → half-to-even 2 ; elapsed given → kept
    rows = [base_row(CRS_ELAPSED_TIME=None, DISTANCE=18.0 / 1.60934), base_row(CRS_ELAPSED_TIME=90.0)]
    got = sorted(r[0] for r in base_features(raw_rows(spark, rows)).select("scheduled_elapsed_min").collect())
    assert got[1] == 90


def test_route_null_when_side_missing(spark):
    r = base_features(raw_rows(spark, [base_row(DEST=None)])).first()
    assert r["route"] is None


def test_output_contract(spark):
    rows = [base_row(OP_CARRIER=c, ORIGIN=o, ARR_DELAY=float(i))
            for i, (c, o) in enumerate([("AA", "JFK"), ("AA", "ORD"), ("UA", "JFK"), ("DL", "BZN")])]
    df = create_target(raw_rows(spark, rows))
    out = engineer_features(df)
    assert out.columns == FEATURE_COLS + [TARGET_COL]
    assert out.count() == df.count()
    enc = {(r["carrier_encoded"], r["origin_encoded"]) for r in out.collect()}
    assert enc == {(2, 2), (2, 1), (1, 2), (1, 1)}
    nulls = out.select([F.sum(F.col(c).isNull().cast("int")) for c in FEATURE_COLS]).first()
    assert sum(nulls) == 0


def test_missing_key_encodes_zero(spark):
    df = create_target(raw_rows(spark, [base_row(OP_CARRIER=None), base_row()]))
    got = sorted(r[0] for r in engineer_features(df).select("carrier_encoded").collect())
    assert got == [0, 1]


def test_alias_column(spark):
    df = raw_rows(spark, [base_row()]).withColumnRenamed("OP_CARRIER", "AIRLINE_CODE")
    out = engineer_features(create_target(df))
    assert out.first()["carrier_encoded"] == 1
