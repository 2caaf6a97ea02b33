"""Job-level behaviour: champion loop, monitoring, CSV files as found, split keys, large counts."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, base_row, raw_rows
from tarmac.operators import drift as dx
from tarmac.operators import metrics as mx
from tarmac.operators import quality as qx
from tarmac.operators import registry as rx
from tarmac.operators import split as sx
from tarmac.operators.encode import fit_frequencies
from tarmac.operators.featurize import base_features
from tarmac.plans import catalog as C
from tarmac.plans import jobs
from tarmac.schema import FEATURE_COLS, RAW_SCHEMA
from tarmac.sources.csv_landing import read_raw_csv
from tarmac.sources.tables import load_flights
from tarmac.streaming import landing as lx
from tarmac.streaming import monitor as mnx


@pytest.fixture(scope="module")
def trained(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("trained"))
    jobs.preprocess(load_flights(spark, SF_SMALL), f"{d}/prep", id_col="flight_id")
    jobs.train(spark, f"{d}/prep", f"{d}/models/m1", params={"n_estimators": 3})
    return d


def test_the_same_model_never_beats_itself(spark, trained, tmp_dir):
    reg = f"{tmp_dir}/registry"                              # nothing registered yet: no folder
    first = jobs.evaluate(spark, f"{trained}/prep", f"{trained}/models/m1", reg, f"{tmp_dir}/e1").first()["doc"]
    assert '"champion":{}' in first
    row = spark.read.parquet(reg).collect()
    assert len(row) == 1 and "val_f1" in row[0]["metrics_doc"]
    approved = spark.read.parquet(reg).withColumn("status", F.lit("Approved"))
    approved.write.parquet(f"{tmp_dir}/approved")
    again = rx.read_decision(jobs.evaluate(spark, f"{trained}/prep", f"{trained}/models/m1",
                                           f"{tmp_dir}/approved", f"{tmp_dir}/e2")).first()
    assert again["improvement"] == 0.0 and again["beats_value"] == 0.0
    assert spark.read.parquet(f"{tmp_dir}/approved").count() == 1
    # the document at the URI serves as well as the one in the registry
    approved.withColumn("metrics_doc", F.lit(None).cast("string")).write.parquet(f"{tmp_dir}/by_uri")
    by_uri = rx.read_decision(jobs.evaluate(spark, f"{trained}/prep", f"{trained}/models/m1",
                                            f"{tmp_dir}/by_uri", f"{tmp_dir}/e3")).first()
    assert by_uri["improvement"] == 0.0
    gone = approved.withColumns({"metrics_doc": F.lit(None).cast("string"), "metrics_uri": F.lit(f"{tmp_dir}/none")})
    gone.write.parquet(f"{tmp_dir}/gone")
    with pytest.raises(Exception, match="none"):
        jobs.evaluate(spark, f"{trained}/prep", f"{trained}/models/m1", f"{tmp_dir}/gone", f"{tmp_dir}/e4")


def test_metrics_document_names_the_run(spark, trained):
    doc = spark.read.text(f"{trained}/models/m1/metrics.json").first()[0]
    run = spark.read.parquet(f"{trained}/models/runs").first()["run_id"]
    assert f'"run_id": "{run}"' in doc


def test_monitoring_clean_day_corrected_day_and_constant_feature(spark, tmp_dir):
    flights = load_flights(spark, SF_SMALL).where(F.col("ARR_DELAY").isNotNull())
    encoder = fit_frequencies(base_features(flights))
    ref = encoder.transform(base_features(flights)).select(*FEATURE_COLS).withColumn("is_weekend", F.lit(0))
    ref.write.parquet(f"{tmp_dir}/ref")                      # one feature never varies
    assert jobs.baseline_job(spark, f"{tmp_dir}/ref", f"{tmp_dir}/base")
    at = F.lit("2024-03-01 10:00:00").cast("timestamp")
    long = jobs.capture_features(flights.withColumn("captured_at", at), encoder)
    same = long.withColumn("value", F.when(F.col("feature") == "is_weekend", 0.0).otherwise(F.col("value")))
    alarm = jobs.monitor_job(spark, same, f"{tmp_dir}/base", f"{tmp_dir}/out").collect()
    assert [(r["drift_count"], r["alarm"]) for r in alarm] == [(0, False)]
    moved = jobs.monitor_job(spark, long, f"{tmp_dir}/base", f"{tmp_dir}/out").collect()
    assert [(r["drift_count"], r["alarm"]) for r in moved] == [(1, True)]
    fixed = jobs.monitor_job(spark, same, f"{tmp_dir}/base", f"{tmp_dir}/out").collect()
    assert [(r["drift_count"], r["alarm"]) for r in fixed] == [(0, False)]
    less = same.where(F.col("feature") != "dep_hour")
    jobs.monitor_job(spark, less, f"{tmp_dir}/base", f"{tmp_dir}/out")
    failed = spark.read.parquet(f"{tmp_dir}/out/checks").where("failed")
    assert [(r["feature"], r["check"]) for r in failed.collect()] == [("dep_hour", "missing_feature")]


def test_late_rows_count_for_their_day(spark, tmp_dir):
    schema = "captured_at timestamp, x struct<value:double,text:string>"

    def land(name, rows):
        spark.createDataFrame([(t, (v, str(v))) for t, v in rows], "captured_at string, x struct<value:double,text:string>") \
            .withColumn("captured_at", F.col("captured_at").cast("timestamp")).write.parquet(f"{tmp_dir}/in/{name}")

    def run():
        src = spark.readStream.schema(schema).option("recursiveFileLookup", True).parquet(f"{tmp_dir}/in")
        mnx.start_daily_stats_stream(spark, src, ["x"], f"{tmp_dir}/out", f"{tmp_dir}/ck").awaitTermination()

    land("a", [("2024-01-01 10:00:00", 1.0), ("2024-01-01 11:00:00", 3.0), ("2024-01-04 11:00:00", 9.0)])
    run()
    land("b", [("2024-01-01 12:00:00", 8.0)])                # three days behind what was seen
    run()
    got = {str(r["day"]): r for r in mnx.read_daily_stats(spark, f"{tmp_dir}/out").collect()}
    assert got["2024-01-01"]["n"] == 3 and got["2024-01-01"]["mean"] == 4.0
    assert abs(got["2024-01-01"]["std"] - 13 ** 0.5) < 1e-12 and got["2024-01-04"]["std"] is None


def _write(path, header, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join([",".join(header), *rows]) + "\n")


COLS = [f.name for f in RAW_SCHEMA.fields]


def test_csv_files_as_found(spark, tmp_dir):
    values = {"FL_DATE": "15-02-2024", "OP_CARRIER": "AA", "ORIGIN": "JFK", "DEST": "LAX", "CRS_DEP_TIME": "900.0",
              "CRS_ARR_TIME": "1100", "CRS_ELAPSED_TIME": "NA", "DISTANCE": "N/A", "DEP_DELAY": "null",
              "ARR_DELAY": "20.0"}
    alias = [c.replace("OP_CARRIER", "AIRLINE_CODE") for c in COLS]
    _write(f"{tmp_dir}/in/data/raw/a.csv", COLS, [",".join(values[c] for c in COLS)])
    _write(f"{tmp_dir}/in/data/raw/b.csv", ['"X"', *alias[::-1]],
           ['"x, y",' + ",".join(values[c] for c in COLS[::-1]), ",".join(["z", *["900.5"] * 10])])
    df = read_raw_csv(spark, f"{tmp_dir}/in/data/raw")
    rows = sorted(df.collect(), key=lambda r: len(r["_type_errors"]))
    for r in rows[:2]:
        assert (r["OP_CARRIER"], r["CRS_DEP_TIME"], r["CRS_ELAPSED_TIME"], r["DISTANCE"], r["_type_errors"]) == \
            ("AA", 900, None, None, [])
    assert rows[2]["CRS_DEP_TIME"] is None and "CRS_DEP_TIME" in rows[2]["_type_errors"]
    _write(f"{tmp_dir}/in/data/raw/bad.csv", ["nothing", "known"], ["1,2"])
    _write(f"{tmp_dir}/in/other/c.csv", ["else"], ["1", "2"])
    with pytest.raises(ValueError, match="bad.csv"):
        read_raw_csv(spark, f"{tmp_dir}/in/data/raw")
    lx.start_landing_stream(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/ck", id_col=None).awaitTermination()
    rejected = spark.read.parquet(f"{tmp_dir}/out/rejected_files").collect()
    assert len(rejected) == 1 and rejected[0]["source_file"].endswith("bad.csv")
    assert spark.read.parquet(f"{tmp_dir}/out/skipped").agg(F.sum("count")).first()[0] == 2
    # the two rows without elapsed time and distance wait in quarantine, the third is kept
    assert spark.read.parquet(f"{tmp_dir}/out/quarantine").count() == 2
    assert spark.read.parquet(f"{tmp_dir}/out/labelled").count() == 1


def test_codes_are_canonical_in_training(spark):
    rows = raw_rows(spark, [base_row(OP_CARRIER=" aa "), base_row(OP_CARRIER="AA"), base_row(OP_CARRIER="UA")])
    counts = {r["key"]: r["n"] for r in fit_frequencies(base_features(rows)).counts
              .where("feature = 'carrier_encoded'").collect()}
    assert counts == {"AA": 2, "UA": 1}


def test_split_by_content_is_the_same_in_any_layout(spark):
    rows = load_flights(spark, SF_SMALL).drop("flight_id").where(F.col("ARR_DELAY").isNotNull())
    hot = rows.limit(1)
    rows = rows.withColumn("delayed", (F.col("ARR_DELAY") >= 15).cast("int"))
    many = rows.unionByName(spark.range(400).join(hot, F.lit(True)).drop("id")
                            .withColumn("delayed", (F.col("ARR_DELAY") >= 15).cast("int")))
    got = []
    for n in (2, 5):
        keyed = sx.content_key(many.repartition(n))
        assert keyed.select("row_key").distinct().count() == many.count()
        split = sx.stratified_split(keyed, "row_key")
        got.append(sorted((r["row_key"], r["split"]) for r in split.collect()))
    assert got[0] == got[1]


def test_null_labels_are_a_stratum_of_their_own(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 1) for i in range(400)], "id long, delayed int")
    counts = {(r["delayed"], r["split"]): r["count"] for r in
              sx.stratified_split(df, "id").groupBy("delayed", "split").count().collect()}
    assert counts[(None, "test")] == 30 and counts[(1, "test")] == 30 and counts[(None, "train")] == 140


def test_auc_beyond_64_bits(spark):
    n = 5 * 10 ** 9
    per = spark.createDataFrame([(0.2, 0, n), (0.8, n, 0)], "s double, pos long, neg long")
    r = mx._auc_from_scores(per, [], "s", []).first()
    assert (r["positives"], r["negatives"], r["auc"]) == (n, n, 1.0)


def test_duplicates_beyond_the_broadcast_bound(spark):
    df = spark.createDataFrame([(i % 7, "x") for i in range(50)], "a int, b string")
    a, b = (qx.duplicate_stats(df, max_broadcast=m).first() for m in (0, 100))
    assert a == b and a["n_distinct"] == 7


def test_plans_are_what_they_should_be(spark):
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    text = plan(C.q_split_assign(spark, SF_SMALL))
    assert text.count("FileScan") == 1 and "Window" not in text
    reg = C.registry(spark, SF_SMALL)
    assert "SortAggregate" not in plan(rx.latest_per_group(reg, "Approved"))
    one = qx.quality_report(load_flights(spark, SF_SMALL), include_duplicates=False, rules=qx.BLOCKING_RULES)
    assert "Expand" not in plan(one)
    for q in (C.q_time_bucket_counts, C.q_binary_metrics, C.q_batch_summary):
        assert "Join" not in plan(q(spark, SF_SMALL))
    assert plan(C.q_drift_alarm(spark, SF_SMALL)).count("FileScan") <= 3
