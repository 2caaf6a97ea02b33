"""Tables derived from ``events``: model registry, approval and object-created events.

Each derivation is a projection of ``events`` (one output row per event),
so these tables grow with the data. JSON texts are assembled from
integers and fixed strings so that any engine builds the same bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.routing import (APPROVAL_DETAIL_TYPE, APPROVAL_SOURCE, OBJECT_DETAIL_TYPE,
                                      OBJECT_SOURCE)

# ── fixed values: names used in the derived registry and events ───────
GROUPS = ["flight-delay-model-group", "flight-delay-model-group",
          "ranking-model-group", "churn-model-group"]          # by user_id % 4
STATUS_BY_EVENT = {"purchase": "Approved", "signup": "Rejected", "view": "PendingManualApproval",
                   "click": "PendingManualApproval", "error": "Failed"}
ARTIFACT_BUCKET = "flight-delay-artifacts"
DATA_BUCKET = "flight-delay-data"
# ───────────────────────────────────────────────────────────────────────


def _bp(x: Column) -> Column:
    """0.xxxx text of an integer in [0, 9999]."""
    return F.concat(F.lit("0."), F.lpad(x.cast("string"), 4, "0"))


def _case(col: Column, mapping: dict, default=None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def registry_from_events(events: DataFrame) -> DataFrame:
    """(package_id, group_name, status, created_at, model_uri, metrics_uri, metrics_doc)."""
    eid, uid = F.col("event_id"), F.col("user_id")
    f1 = F.floor(F.col("value") * 100) % 10000
    acc = (f1 * 7 + eid) % 10000
    auc = (f1 * 3 + uid) % 10000
    doc = F.when(eid % 11 == 0, F.lit("{}")).otherwise(F.concat(
        F.lit('{"challenger": {"val_accuracy": '), _bp(acc),
        F.lit(', "val_f1": '), _bp(f1), F.lit(', "val_auc_roc": '), _bp(auc), F.lit("}}")))
    group = _case(uid % 4, dict(enumerate(GROUPS)))
    base = f"s3://{ARTIFACT_BUCKET}"
    return events.select(
        eid.alias("package_id"),
        group.alias("group_name"),
        _case(F.col("event_type"), STATUS_BY_EVENT, "PendingManualApproval").alias("status"),
        F.col("ts").alias("created_at"),
        F.concat(F.lit(f"{base}/models/"), eid.cast("string"), F.lit("/model.tar.gz")).alias("model_uri"),
        F.when(eid % 23 == 0, F.lit("")).otherwise(
            F.concat(F.lit(f"{base}/evaluation/"), eid.cast("string"), F.lit("/comparison.json")))
        .alias("metrics_uri"),
        doc.alias("metrics_doc"),
    )


def approval_events(events: DataFrame) -> DataFrame:
    """(event_id, body): package state-change events as JSON text."""
    reg = registry_from_events(events)
    arn = F.when(F.col("package_id") % 13 == 0, F.lit("")).otherwise(F.concat(
        F.lit("arn:aws:sagemaker:us-east-1:000000000000:model-package/"),
        F.col("group_name"), F.lit("/"), F.col("package_id").cast("string")))
    body = F.concat(
        F.lit(f'{{"source": "{APPROVAL_SOURCE}", "detail-type": "{APPROVAL_DETAIL_TYPE}", '
              '"detail": {"ModelPackageArn": "'), arn,
        F.lit('", "ModelPackageGroupName": "'), F.col("group_name"),
        F.lit('", "ModelApprovalStatus": "'), F.col("status"),
        F.lit('", "ModelPackageStatus": "Completed"}}'))
    return reg.select(F.col("package_id").alias("event_id"), body.alias("body"))


def object_events(events: DataFrame) -> DataFrame:
    """(event_id, body): object-created events as JSON text."""
    eid = F.col("event_id").cast("string")
    key = (F.when(F.col("event_type") == "purchase", F.concat(F.lit("data/raw/flights_"), eid, F.lit(".csv")))
            .when(F.col("event_type") == "view", F.concat(F.lit("data/raw/flights_"), eid, F.lit(".json")))
            .when(F.col("event_type") == "click", F.concat(F.lit("models/"), eid, F.lit(".csv")))
            .when(F.col("event_type") == "signup", F.concat(F.lit("data/raw/2024/"), eid, F.lit(".csv")))
            .otherwise(F.lit("")))
    bucket = F.when(F.col("user_id") % 17 == 0, F.lit("")).otherwise(F.lit(DATA_BUCKET))
    body = F.concat(
        F.lit(f'{{"source": "{OBJECT_SOURCE}", "detail-type": "{OBJECT_DETAIL_TYPE}", '
              '"detail": {"bucket": {"name": "'),
        bucket, F.lit('"}, "object": {"key": "'), key, F.lit('", "size": '),
        (F.col("event_id") * 10).cast("string"), F.lit("}}}"))
    return events.select(F.col("event_id"), body.alias("body"))
