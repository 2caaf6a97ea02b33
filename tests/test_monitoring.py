"""Published batches, stored bins and the incremental monitor."""

import bisect
import datetime as dt
import glob
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac.operators import drift as dx
from tarmac.operators.encode import fit_frequencies
from tarmac.operators.featurize import base_features
from tarmac.plans import jobs
from tarmac.schema import FEATURE_COLS
from tarmac.sources import committed as cm
from tarmac.sources.tables import load_flights

ROWS = "x long, day date"
D1, D2, D3 = (dt.date(2024, 1, k) for k in (1, 2, 3))


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), ROWS)


def seen(spark, root, **kw):
    got = cm.read_committed(spark, root, "day", **kw)
    return None if got is None else sorted((r["x"], r["day"]) for r in got.collect())


def test_a_batch_is_seen_as_a_whole_or_not_at_all(spark, tmp_dir, monkeypatch):
    root = f"{tmp_dir}/t"
    assert seen(spark, root) is None
    assert cm.publish(rows(spark, (1, D1), (2, D2)), root, "day", 0)
    with monkeypatch.context() as m:                                   # dies between files and commit
        m.setattr(cm, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            cm.publish(rows(spark, (3, D1), (4, D3)), root, "day", 1)
    assert len(glob.glob(f"{root}/data/day=*/attempt=1-*")) == 2 and seen(spark, root) == [(1, D1), (2, D2)]
    assert cm.publish(rows(spark, (3, D1), (4, D3)), root, "day", 1)
    assert seen(spark, root) == [(1, D1), (2, D2), (3, D1), (4, D3)]
    assert not cm.publish(rows(spark, (9, D1)), root, "day", 1)        # run again: nothing more
    assert cm.publish(rows(spark), root, "day", 2)                     # a batch without rows
    assert not cm.publish(rows(spark, (9, D1)), root, "day", 2)
    assert seen(spark, root) == [(1, D1), (2, D2), (3, D1), (4, D3)]
    assert [(r["batch"], r["day"], r["rows"]) for r in cm.commits(spark, root).orderBy("batch", "day").collect()] == [
        ("0", D1, 1), ("0", D2, 1), ("1", D1, 1), ("1", D3, 1), ("2", None, 0)]


def test_days_prune_partitions(spark, tmp_dir):
    cm.publish(rows(spark, (1, D1), (2, D2), (3, D3)), tmp_dir, "day", "a")
    got = cm.read_committed(spark, tmp_dir, "day", [D2])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert seen(spark, tmp_dir, days=[D2]) == [(2, D2)]


def test_two_writers_of_one_batch_count_once(spark, tmp_dir, monkeypatch):
    nothing = cm.commits(spark, tmp_dir)
    with monkeypatch.context() as m:                                   # neither sees the other's commit
        m.setattr(cm, "commits", lambda *a: nothing)
        assert cm.publish(rows(spark, (1, D1)), tmp_dir, "day", 0) and cm.publish(rows(spark, (1, D1)), tmp_dir, "day", 0)
    assert seen(spark, tmp_dir) == [(1, D1)]


def test_bins_by_halving(spark):
    rng = random.Random(4)
    cases = [(sorted(float(rng.randint(0, 6)) for _ in range(n)), float(rng.randint(-1, 7))) for n in (1, 2, 3, 8, 9) * 20]
    df = spark.createDataFrame(cases + [([1.0], None)], "edges array<double>, value double")
    got = df.select("edges", "value", dx.bin_of(F.col("value"), F.col("edges"), 9).alias("bin")).collect()
    for r in got:
        assert r["bin"] == (None if r["value"] is None else bisect.bisect_left(r["edges"], r["value"]))


@pytest.fixture(scope="module")
def served(spark, tmp_path_factory):
    """(flights, encoder, baseline folder): the baseline is that of all labelled flights."""
    d = str(tmp_path_factory.mktemp("served"))
    flights = load_flights(spark, SF_SMALL).where(F.col("ARR_DELAY").isNotNull() & (F.col("flight_id") % 2 == 0))
    encoder = fit_frequencies(base_features(flights))
    encoder.transform(base_features(flights)).select(*FEATURE_COLS).write.parquet(f"{d}/ref")
    assert jobs.baseline_job(spark, f"{d}/ref", f"{d}/base")
    return flights, encoder, f"{d}/base"


def capture(flights, day):
    at = F.lit(f"{day} 10:00:00").cast("timestamp")
    return flights.withColumns({"captured_at": at, "capture_date": F.lit(day).cast("date")})


def table(spark, path):
    cols = ["day", "feature", "check", "failed", F.bround("observed", 3).alias("o"), F.bround("baseline", 3).alias("b")]
    return sorted((tuple(r) for r in spark.read.parquet(path).select(*cols).collect()), key=str)


def test_each_run_reads_only_what_is_new(spark, served, tmp_dir, monkeypatch):
    flights, encoder, base = served
    cap, out = f"{tmp_dir}/cap", f"{tmp_dir}/out"
    read = []
    features = jobs.capture_features
    monkeypatch.setattr(jobs, "capture_features", lambda rows, *a: read.append(rows) or features(rows, *a))
    assert jobs.monitor_new(spark, cap, encoder, base, out) is None
    third = F.pmod("flight_id", F.lit(3))
    cm.publish(capture(flights.where(third > 0), D1), cap, "capture_date", 0)
    assert jobs.monitor_new(spark, cap, encoder, base, out).count() == 1
    cm.publish(capture(flights, D2), cap, "capture_date", 1)
    alarm = jobs.monitor_new(spark, cap, encoder, base, out)
    assert [(r["day"], r["alarm"]) for r in alarm.orderBy("day").collect()][1] == (D2, False)
    # a run's scan is pruned to the days and batches that are new
    def scanned(k):
        plan = read[k]._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: [")[1].split("]")[0]
        assert "capture_date#" in filters and "attempt#" in filters
        attempts = cm.commits(spark, cap).select("attempt").collect()
        return read[k].count(), "2024-01-02" in plan, sorted(r["attempt"][0] for r in attempts if r["attempt"] in plan)
    assert scanned(1) == (flights.count(), True, ["1"])
    # rows that come late for the first day, and nothing at all
    cm.publish(capture(flights.where(third == 0), D1), cap, "capture_date", 2)
    jobs.monitor_new(spark, cap, encoder, base, out)
    assert scanned(2) == (flights.where(third == 0).count(), False, ["2"])
    jobs.monitor_new(spark, cap, encoder, base, out)
    assert len(read) == 3
    # the same checks as of all captured rows at once
    whole = capture(flights, D1).unionByName(capture(flights, D2))
    jobs.monitor_job(spark, features(whole, encoder), base, f"{tmp_dir}/whole")
    assert table(spark, f"{out}/checks") == table(spark, f"{tmp_dir}/whole/checks")
    assert spark.read.parquet(f"{out}/alarm").where("alarm").count() == 0


def test_a_run_that_died_is_made_up_for(spark, served, tmp_dir, monkeypatch):
    flights, encoder, base = served
    cap, out = f"{tmp_dir}/cap", f"{tmp_dir}/out"
    cm.publish(capture(flights, D1), cap, "capture_date", 0)
    lost = lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost"))
    for place in ((cm, "commit"), (dx, "checks")):                      # before and after its parts count
        with monkeypatch.context() as m:
            m.setattr(*place, lost)
            with pytest.raises(RuntimeError, match="lost"):
                jobs.monitor_new(spark, cap, encoder, base, out)
    jobs.monitor_new(spark, cap, encoder, base, out)
    stats = dx.merged_stats(cm.read_committed(spark, f"{out}/states", "day"))
    assert {r["n"] for r in stats.collect()} == {flights.count()}
    assert spark.read.parquet(f"{out}/checks").select("day").distinct().count() == 1


def long_rows(spark, values, day):
    return spark.createDataFrame([(f"{day} 09:00:00", "dep_hour", float(v), str(v)) for v in values],
                                 "at string, feature string, value double, text string") \
        .select(F.col("at").cast("timestamp").alias("captured_at"), "feature", "value", "text")


def test_a_change_of_shape_alone_raises_the_alarm(spark, tmp_dir):
    spark.createDataFrame([(k % 100,) for k in range(2000)], "dep_hour int").write.parquet(f"{tmp_dir}/ref")
    jobs.baseline_job(spark, f"{tmp_dir}/ref", f"{tmp_dir}/base")
    bins = jobs.read_bins(spark, f"{tmp_dir}/base").first()
    assert len(bins["edges"]) == 9 and bins["counts"] == [200] * 10
    days = long_rows(spark, [k % 100 for k in range(500)], D1) \
        .unionByName(long_rows(spark, [24, 75] * 250, D2)) \
        .unionByName(long_rows(spark, [k % 100 for k in range(499)] + [49.5], D3))
    alarm = jobs.monitor_job(spark, days, f"{tmp_dir}/base", f"{tmp_dir}/out")
    assert [(r["day"], r["drift_count"], r["alarm"]) for r in alarm.orderBy("day").collect()] == [
        (D1, 0, False), (D2, 1, True), (D3, 0, False)]
    failed = spark.read.parquet(f"{tmp_dir}/out/checks").where("failed").orderBy("day").collect()
    assert [(r["day"], r["check"]) for r in failed] == [(D2, "psi"), (D3, "data_type")]
