import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, base_row, raw_rows
from tarmac.operators import quality as qx
from tarmac.sources.tables import load_flights


def _rows(n, **kw):
    return [base_row(CRS_DEP_TIME=(i * 37) % 2400 // 100 * 100, **kw) for i in range(n)]


def test_too_small_raises(spark):
    with pytest.raises(ValueError, match="min_rows"):
        qx.validate_raw_data(raw_rows(spark, _rows(5)))


def test_invalid_time_raises(spark):
    rows = _rows(150)
    rows[3]["CRS_DEP_TIME"] = 2500
    with pytest.raises(ValueError, match="dep_time_max"):
        qx.validate_raw_data(raw_rows(spark, rows))


def test_missing_column_raises(spark):
    df = raw_rows(spark, _rows(150)).drop("OP_CARRIER")
    with pytest.raises(ValueError, match="required_columns"):
        qx.validate_raw_data(df)


def test_all_null_column_raises(spark):
    df = raw_rows(spark, _rows(150, ORIGIN=None))
    with pytest.raises(ValueError, match="not_all_null_ORIGIN"):
        qx.validate_raw_data(df)


def test_valid_passes(spark):
    rep = qx.validate_raw_data(raw_rows(spark, _rows(150)))
    assert rep.where(~F.col("passed")).count() == 0


def test_report_rules_on_flights(spark):
    rep = {r["rule"]: r for r in qx.quality_report(load_flights(spark, SF_SMALL).drop("flight_id")).collect()}
    assert len(rep) == 20
    assert rep["min_rows"]["passed"] and rep["not_all_null_OP_CARRIER"]["passed"]
    assert rep["duplicate_fraction"]["observed"] == 0.0


def test_duplicates_count_null_rows_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a")], "a int, b string")
    r = qx.duplicate_stats(df).first()
    assert (r["n_rows"], r["n_distinct"], r["dup_rows"]) == (3, 2, 1)


def _dup_tuple(df, **kw):
    r = qx.duplicate_stats(df, **kw).first()
    return (r["n_rows"], r["n_distinct"], r["dup_rows"], r["dup_fraction"])


def _grouped(df):
    """The same by one grouping over all columns."""
    n, k = df.count(), df.groupBy(*df.columns).count().count()
    return (n, k, n - k, round((n - k) / n, 6))


def test_duplicate_passes_agree_on_nulls_zeros_and_nan(spark):
    rows = [(1, None, 0.0), (1, None, -0.0), (1, None, 0.0), (2, "a", float("nan")),
            (2, "a", float("nan")), (None, None, None), (None, None, None), (3, "b", 1.5),
            (3, "b", None), (None, "b", 1.5)]
    df = spark.createDataFrame(rows, "a int, b string, c double")
    plain = _grouped(df)
    assert plain[:3] == (10, 6, 4)
    assert _dup_tuple(df) == plain
    assert _dup_tuple(df, max_broadcast=0) == plain


def test_duplicate_hot_row_and_no_copies(spark):
    from pyspark.sql import functions as F
    base = spark.range(3000).select(F.col("id"), (F.col("id") % 7).alias("k"))
    # a third of all rows are copies of one row
    hot = base.select(F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("id"), "k")
    hot = hot.withColumn("k", F.when(F.col("id") == -1, F.lit(0)).otherwise(F.col("k")))
    assert _dup_tuple(hot) == _grouped(hot)
    assert _dup_tuple(hot)[:3] == (3000, 2001, 999)
    assert _dup_tuple(base) == (3000, 3000, 0, 0.0)


def test_request_quarantine(spark):
    rows = [base_row(), base_row(OP_CARRIER="  "), base_row(ORIGIN="X"), base_row(CRS_ARR_TIME=2400),
            base_row(DISTANCE=0.0), base_row(CRS_ELAPSED_TIME=None), base_row(ORIGIN=" jfk ")]
    valid, bad = qx.split_requests(raw_rows(spark, rows))
    errs = sorted(";".join(r["errors"]) for r in bad.collect())
    assert errs == sorted(["empty_OP_CARRIER", "code_length_ORIGIN", "range_CRS_ARR_TIME",
                           "nonpositive_DISTANCE", "missing_CRS_ELAPSED_TIME"])
    assert sorted(r["ORIGIN"] for r in valid.collect()) == ["JFK", "JFK"]


from hypothesis import given, settings, strategies as st  # noqa: E402

_VALS = st.one_of(st.none(), st.sampled_from([0.0, -0.0, 1.5, float("nan")]))


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),
                          st.one_of(st.none(), st.sampled_from(["a", "b"])), _VALS),
                min_size=1, max_size=40),
       st.sampled_from([0, 1, 1_000_000]))
def test_duplicates_equal_one_grouping(spark, rows, cap):
    df = spark.createDataFrame(rows, "a int, b string, c double")
    assert _dup_tuple(df, max_broadcast=cap) == _grouped(df)
