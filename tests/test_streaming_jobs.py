"""Streams give the batch answer; the three jobs run end to end from CSV."""

import glob
import os

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac.operators import drift as dx
from tarmac.operators import registry as rx
from tarmac.plans import catalog as C
from tarmac.plans import jobs
from tarmac.sources.csv_landing import read_raw_csv
from tarmac.sources.events import registry_from_events
from tarmac.sources.tables import load_flights, load_table
from tarmac.streaming import landing as lx
from tarmac.streaming import monitor as mnx


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_daily_stats_equal_batch(spark, tmp_dir):
    events = load_table(spark, SF_SMALL, "events")
    src = (spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet")
           .parquet(SF_SMALL))
    q = mnx.start_daily_stats_stream(spark, dx.capture_from_events(src), C.CAPTURE_FEATURES,
                                     f"{tmp_dir}/stats", f"{tmp_dir}/ck")
    q.awaitTermination()
    cols = ["day", "feature", "n", "nulls", "type_errors"]
    stream = mnx.read_daily_stats(spark, f"{tmp_dir}/stats").select(*cols, F.bround("mean", 6))
    batch = dx.daily_stats(dx.long_capture(dx.capture_from_events(events), C.CAPTURE_FEATURES))
    assert _rows(stream) == _rows(batch.select(*cols, F.bround("mean", 6)))


def test_landing_stream_picks_each_file_once(spark, tmp_dir):
    flights = load_flights(spark, SF_SMALL)
    flights.repartition(2).write.option("header", True).csv(f"{tmp_dir}/in/data/raw")
    ck = f"{tmp_dir}/ck"
    lx.start_landing_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", ck).awaitTermination()
    first = spark.read.parquet(f"{tmp_dir}/out/labelled").count()
    # a second run over the same folder finds no new file
    lx.start_landing_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", ck).awaitTermination()
    assert spark.read.parquet(f"{tmp_dir}/out/labelled").count() == first
    cancelled = flights.where(F.col("ARR_DELAY").isNull()).count()
    assert first == flights.count() - cancelled              # every labelled flight, as in the batch path


def test_landing_backlog_in_bounded_batches(spark, tmp_dir):
    flights = load_flights(spark, SF_SMALL)
    flights.repartition(3).write.option("header", True).csv(f"{tmp_dir}/in/data/raw")
    lx.start_landing_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/one", f"{tmp_dir}/ck1").awaitTermination()
    lx.start_landing_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/capped", f"{tmp_dir}/ck2",
                            max_files_per_trigger=1).awaitTermination()
    capped = spark.read.parquet(f"{tmp_dir}/capped/labelled")
    assert capped.select("batch_id").distinct().count() == 3      # one file per micro-batch
    one = spark.read.parquet(f"{tmp_dir}/one/labelled")
    assert _rows(capped.drop("batch_id")) == _rows(one.drop("batch_id"))


def test_csv_reader_types_by_name(spark, tmp_dir):
    path = f"{tmp_dir}/raw"
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write("EXTRA,ARR_DELAY,DEP_DELAY,DISTANCE,CRS_ELAPSED_TIME,CRS_ARR_TIME,CRS_DEP_TIME,"
                "DEST,ORIGIN,AIRLINE_CODE,FL_DATE\n")
        f.write("x,20.0,1.0,1000,120,1100,900,LAX,JFK,AA,15-02-2024\n")
        f.write("y,NaN,1.0,abc,120,1100,9x0,LAX,JFK,UA,16-02-2024\n")
    with open(f"{path}/notes.txt", "w") as f:
        f.write("ignored")
    df = read_raw_csv(spark, path)
    rows = sorted(df.collect(), key=lambda r: r["FL_DATE"])
    assert rows[0]["OP_CARRIER"] == "AA" and rows[0]["DISTANCE"] == 1000.0
    assert rows[1]["ARR_DELAY"] is None                       # NaN → NULL
    assert sorted(rows[1]["_type_errors"]) == ["CRS_DEP_TIME", "DISTANCE"]


def test_jobs_end_to_end(spark, tmp_dir):
    flights = load_flights(spark, SF_SMALL)
    flights.write.option("header", True).csv(f"{tmp_dir}/landing")
    raw = read_raw_csv(spark, f"{tmp_dir}/landing", keep_file=False)
    res = jobs.preprocess(raw, f"{tmp_dir}/prep", id_col="flight_id")
    assert set(res["rows"]) == {"train", "val", "test"}
    assert sum(res["rows"].values()) == flights.where(F.col("ARR_DELAY").isNotNull()).count()
    assert spark.read.json(f"{tmp_dir}/prep/feature_stats").count() == 14
    # few trees: this test checks the job wiring, not model quality
    metrics = jobs.train(spark, f"{tmp_dir}/prep", f"{tmp_dir}/models/m1",
                         params={"n_estimators": 5})
    assert 0.0 <= metrics["val_auc_roc"] <= 1.0
    assert spark.read.parquet(f"{tmp_dir}/models/runs").count() == 1
    registry_from_events(load_table(spark, SF_SMALL, "events")).write.parquet(f"{tmp_dir}/registry")
    decision = jobs.evaluate(spark, f"{tmp_dir}/prep", f"{tmp_dir}/models/m1",
                             f"{tmp_dir}/registry", f"{tmp_dir}/eval")
    r = rx.read_decision(decision).first()
    assert r["beats_value"] in (0.0, 1.0)
    assert glob.glob(f"{tmp_dir}/eval/comparison.json/part-*")


def test_baseline_written_once(spark, tmp_dir):
    f = C.q_engineer_features(spark, SF_SMALL)
    f.write.parquet(f"{tmp_dir}/ref")
    assert jobs.baseline_job(spark, f"{tmp_dir}/ref", f"{tmp_dir}/baseline") is True
    assert jobs.baseline_job(spark, f"{tmp_dir}/ref", f"{tmp_dir}/baseline") is False
    stats = spark.read.parquet(f"{tmp_dir}/baseline/statistics")
    assert stats.count() == 14 and "p50" in stats.columns


def test_evaluate_appends_registration_when_winning(spark, tmp_dir):
    flights = load_flights(spark, SF_SMALL)
    jobs.preprocess(flights.drop("flight_id"), f"{tmp_dir}/prep")     # keys made of content
    jobs.train(spark, f"{tmp_dir}/prep", f"{tmp_dir}/models/m1", params={"n_estimators": 3})
    empty = registry_from_events(load_table(spark, SF_SMALL, "events")).limit(0)
    empty.write.parquet(f"{tmp_dir}/registry")
    r = rx.read_decision(jobs.evaluate(spark, f"{tmp_dir}/prep", f"{tmp_dir}/models/m1",
                                       f"{tmp_dir}/registry", f"{tmp_dir}/eval")).first()
    reg = spark.read.parquet(f"{tmp_dir}/registry")
    # no champion → champion score 0.0; a challenger F1 ≥ 0.01 wins and is registered
    assert (reg.count() == 1) == (r["beats_value"] == 1.0)
    if r["beats_value"] == 1.0:
        assert reg.first()["status"] == "PendingManualApproval"


def test_landing_skips_files_outside_prefix(spark, tmp_dir):
    flights = load_flights(spark, SF_SMALL).limit(50)
    flights.write.option("header", True).csv(f"{tmp_dir}/in/data/raw")
    flights.write.option("header", True).csv(f"{tmp_dir}/in/models")
    lx.start_landing_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()
    kept = spark.read.parquet(f"{tmp_dir}/out/labelled").count()
    skipped = spark.read.parquet(f"{tmp_dir}/out/skipped").agg(F.sum("count")).first()[0]
    assert skipped == 50 and kept <= 50


def test_preprocess_copies_get_distinct_keys(spark, tmp_dir):
    # a third of the rows are one repeated row: keys stay unique, split sizes stay exact
    flights = load_flights(spark, SF_SMALL).drop("flight_id")
    one = flights.where(F.col("ARR_DELAY").isNotNull()).limit(1)
    n = flights.count()
    copies = spark.range(n // 2).select(*[F.lit(v).cast(t).alias(c) for c, v, t in
                                         zip(one.columns, one.first(), [f.dataType for f in one.schema])])
    raw = flights.unionByName(copies)
    res = jobs.preprocess(raw, f"{tmp_dir}/prep")
    feats = spark.read.parquet(f"{tmp_dir}/prep/features")
    assert feats.select("row_key").distinct().count() == feats.count()
    total = sum(res["rows"].values())
    assert abs(res["rows"]["test"] - 0.15 * total) <= 2


def test_numeric_rule_sees_csv_type_errors(spark, tmp_dir):
    from tarmac.operators import quality as qx
    path = f"{tmp_dir}/raw"
    os.makedirs(path)
    with open(f"{path}/a.csv", "w") as f:
        f.write("FL_DATE,OP_CARRIER,ORIGIN,DEST,CRS_DEP_TIME,CRS_ARR_TIME,CRS_ELAPSED_TIME,"
                "DISTANCE,DEP_DELAY,ARR_DELAY\n")
        f.write("15-02-2024,AA,JFK,LAX,900,1100,120,far,1.0,20.0\n")
        f.write("16-02-2024,UA,JFK,LAX,1000,1200,120,1000,1.0,2.0\n")
    rep = {r["rule"]: r for r in qx.quality_report(read_raw_csv(spark, path)).collect()}
    assert rep["numeric_DISTANCE"]["observed"] == 1.0 and not rep["numeric_DISTANCE"]["passed"]
    assert rep["numeric_CRS_DEP_TIME"]["passed"]


def test_cli_preprocess_and_train(spark, tmp_dir, monkeypatch):
    from tarmac import cli
    load_flights(spark, SF_SMALL).write.option("header", True).csv(f"{tmp_dir}/raw")
    out = cli.main(["preprocess", "--input", f"{tmp_dir}/raw", "--output", f"{tmp_dir}/prep",
                    "--id-col", "flight_id", "--test-size", "0.2"])
    total = sum(out["rows"].values())
    assert abs(out["rows"]["test"] - 0.2 * total) <= 2
    monkeypatch.setenv("N_ESTIMATORS", "3")        # env default, as the training job allows
    m = cli.main(["train", "--prep", f"{tmp_dir}/prep", "--model-dir", f"{tmp_dir}/m"])
    assert set(m) == {"val_accuracy", "val_f1", "val_precision", "val_recall", "val_auc_roc"}
