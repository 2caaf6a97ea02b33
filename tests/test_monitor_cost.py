"""What a run of the monitor computes for each captured value, and that it is still right (F5)."""

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac.operators import drift as dx
from tarmac.operators import profile as px
from tarmac.operators.encode import fit_frequencies
from tarmac.operators.featurize import base_features
from tarmac.plans import jobs
from tarmac.sources.tables import load_flights

LONG = "captured_at timestamp, feature string, value double, text string"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_values_are_placed_in_generated_code_and_texts_are_not_made(spark):
    flights = load_flights(spark, SF_SMALL).withColumn("captured_at", F.lit("2024-01-01").cast("timestamp"))
    long = jobs.capture_features(flights, fit_frequencies(base_features(flights)))
    bins = spark.createDataFrame([("dep_hour", [float(k) for k in range(9)])], "feature string, edges array<double>")
    plan = plan_of(dx.partial_stats(long, bins, 9))
    assert "lambda" not in plan and "as string" not in plan
    row = long.where("feature = 'dep_hour' and value is not null").first()   # a reader still gets the texts
    assert row["text"] == str(int(row["value"])) and row["wrong"] is False


def test_the_baseline_counts_its_values_once(spark, tmp_dir, monkeypatch):
    spark.createDataFrame([(k % 100, None if k % 3 else float(k)) for k in range(2000)],
                          "dep_hour int, route_distance_km double").write.parquet(f"{tmp_dir}/ref")
    calls = []
    total = px.running_total
    monkeypatch.setattr(px, "running_total", lambda *a: calls.append(a) or total(*a))
    monkeypatch.setattr("tarmac.operators.running.running_total", px.running_total)
    jobs.baseline_job(spark, f"{tmp_dir}/ref", f"{tmp_dir}/base")
    assert len(calls) == 1
    ref = spark.read.parquet(f"{tmp_dir}/ref")
    cols = ["dep_hour", "route_distance_km"]
    bins = {r["feature"]: (r["edges"], r["counts"]) for r in jobs.read_bins(spark, f"{tmp_dir}/base").collect()}
    edges = {r["feature"]: r["edges"] for r in dx.baseline_edges(px._long_values(ref, cols)).collect()}
    for c in cols:
        values = [r[0] for r in ref.where(F.col(c).isNotNull()).select(c).collect()]
        below = [sum(e < v for e in edges[c]) for v in values]
        assert bins[c] == (edges[c], [below.count(k) for k in range(10)])
    told = {r["feature"]: r for r in spark.read.parquet(f"{tmp_dir}/base/statistics").collect()}
    for r in px.exact_quantiles(ref, cols).collect():
        assert all(told[r["feature"]][k] == v for k, v in r.asDict().items())


@pytest.mark.parametrize("binned", [True, False])
def test_partial_statistics_of_rows_with_nothing_in_them(spark, binned):
    d1, d2 = dt.datetime(2024, 1, 1, 23, 59, 59), dt.datetime(2024, 1, 2)
    a = [1.0, 2.5, 2.5, 7.0, -3.0, 100.0]
    rows = ([(d1, "a", v, str(v)) for v in a] + [(d1, "a", None, None), (d1, "a", None, "x"), (d2, "a", None, "x"),
            (None, "a", 5.0, "5"), (d2, "b", float("nan"), "NaN"), (d2, "b", 4.0, "4")])
    long = spark.createDataFrame(rows, LONG)
    bins = spark.createDataFrame([("a", [2.0, 2.5, 8.0])], "feature string, edges array<double>") if binned else None
    got = {(r["day"].day, r["feature"]): r for r in dx.partial_stats(long, bins, 3).collect()}
    assert set(got) == {(1, "a"), (2, "a"), (2, "b")}                 # a row captured at no time has no day
    r = got[1, "a"]
    assert (r["n"], r["nulls"], r["type_errors"], r["fractions"], r["k"]) == (8, 2, 1, 2, 6)
    assert (r["min"], r["max"]) == (-3.0, 100.0) and r["m"] == pytest.approx(statistics.fmean(a))
    assert r["q"] == pytest.approx(statistics.pvariance(a) * 6)
    r = got[2, "a"]
    assert [r[c] for c in ("n", "nulls", "type_errors", "fractions", "k", "m", "q", "min", "max")] == [
        1, 1, 1, 0, 0, None, None, None, None]
    assert (got[2, "b"]["fractions"], got[2, "b"]["k"], got[2, "b"]["min"]) == (1, 2, 4.0)
    if binned:                                                         # without edges all are in the first bin
        assert [got[k]["bins"] for k in ((1, "a"), (2, "a"), (2, "b"))] == [[2, 2, 1, 1], [0] * 4, [2, 0, 0, 0]]
