import datetime as dt

from pyspark.sql import functions as F

from tarmac.operators import registry as rx
from tarmac.operators import routing as ox

T0 = dt.datetime(2024, 1, 1)


def _reg(spark, rows):
    return spark.createDataFrame(
        [(pid, g, st, T0 + dt.timedelta(hours=h), f"m/{pid}", uri, doc) for pid, g, st, h, uri, doc in rows],
        "package_id long, group_name string, status string, created_at timestamp, model_uri string, "
        "metrics_uri string, metrics_doc string")


def _doc(f1):
    return '{"challenger": {"val_f1": %s}}' % f1


def test_latest_tie_breaks_on_id(spark):
    reg = _reg(spark, [(1, "g", "Approved", 5, "s3://b/k1", _doc(0.5)),
                       (2, "g", "Approved", 5, "s3://b/k2", _doc(0.6)),
                       (3, "g", "Approved", 1, "s3://b/k3", _doc(0.9))])
    assert rx.latest_per_group(reg, "Approved").first()["package_id"] == 2


def test_no_champion_scores_zero(spark):
    reg = _reg(spark, [(1, "g", "PendingManualApproval", 1, "s3://b/k", _doc(0.3))])
    cmp = rx.compare_champion(rx.latest_per_group(reg, "PendingManualApproval"),
                              rx.latest_per_group(reg, "Approved")).first()
    assert cmp["champion_score"] == 0.0 and cmp["beats_champion"]


def test_threshold_uses_unrounded_difference(spark):
    reg = _reg(spark, [(1, "g", "PendingManualApproval", 2, "s3://b/k1", _doc(0.41)),
                       (2, "g", "Approved", 1, "s3://b/k2", _doc(0.40))])
    cmp = rx.compare_champion(rx.latest_per_group(reg, "PendingManualApproval"),
                              rx.latest_per_group(reg, "Approved")).first()
    assert not cmp["beats_champion"]            # 0.41 - 0.40 < 0.01 in binary
    assert cmp["improvement"] == 0.01


def test_missing_uri_or_key_means_no_metrics(spark):
    reg = _reg(spark, [(1, "g", "PendingManualApproval", 2, "s3://b/k1", _doc(0.5)),
                       (2, "g", "Approved", 1, "", _doc(0.9))])
    cmp = rx.compare_champion(rx.latest_per_group(reg, "PendingManualApproval"),
                              rx.latest_per_group(reg, "Approved")).first()
    assert cmp["champion_score"] == 0.0


def test_decision_json_roundtrip(spark):
    reg = _reg(spark, [(1, "g", "PendingManualApproval", 2, "s3://b/k1", _doc(0.5))])
    cmp = rx.compare_champion(rx.latest_per_group(reg, "PendingManualApproval"),
                              rx.latest_per_group(reg, "Approved"))
    r = rx.read_decision(rx.decision_document(cmp)).first()
    assert r["beats_value"] == 1.0 and r["challenger_f1"] == 0.5


def test_object_routing(spark):
    def ev(bucket, key):
        return ('{"source": "aws.s3", "detail-type": "Object Created", "detail": {"bucket": '
                '{"name": "%s"}, "object": {"key": "%s", "size": 1}}}' % (bucket, key))
    df = spark.createDataFrame([(ev("b", "data/raw/x.csv"),), (ev("b", "data/raw/x.json"),),
                                (ev("", "data/raw/x.csv"),), ("{}",)], "body string")
    got = [r["outcome"] for r in ox.route_object_events(df).collect()]
    assert got == ["triggered", "skipped", "missing_bucket_or_key", "missing_bucket_or_key"]


def test_approval_routing(spark):
    def ev(arn, grp, status):
        return ('{"detail": {"ModelPackageArn": "%s", "ModelPackageGroupName": "%s", '
                '"ModelApprovalStatus": "%s"}}' % (arn, grp, status))
    df = spark.createDataFrame([(ev("a", "flight-delay-model-group", "Approved"),),
                                (ev("a", "other", "Approved"),),
                                (ev("a", "flight-delay-model-group", "Rejected"),),
                                (ev("", "flight-delay-model-group", "Approved"),)], "body string")
    got = [(r["status_code"], r["outcome"]) for r in ox.route_approval_events(df).collect()]
    assert got == [(200, "deploy"), (200, "skip_group"), (200, "skip_status"), (400, "missing_arn")]


def test_routing_on_a_stream(spark, tmp_dir):
    from conftest import SF_SMALL
    from tarmac.sources.events import approval_events
    from tarmac.sources.tables import load_table

    ev = approval_events(load_table(spark, SF_SMALL, "events"))
    ev.select("body").write.text(f"{tmp_dir}/events")
    stream = spark.readStream.text(f"{tmp_dir}/events").withColumnRenamed("value", "body")
    routed = ox.route_approval_events(stream).drop("body")
    q = (routed.writeStream.format("parquet").option("checkpointLocation", f"{tmp_dir}/ck")
         .trigger(availableNow=True).start(f"{tmp_dir}/out"))
    q.awaitTermination()
    got = dict(spark.read.parquet(f"{tmp_dir}/out").groupBy("outcome").count().collect())
    want = dict(ox.route_approval_events(ev).groupBy("outcome").count().collect())
    assert got == want and got.get("deploy", 0) > 0
