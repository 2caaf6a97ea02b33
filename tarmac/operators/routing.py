"""Event routing: parse JSON events, decide an outcome per event (batch or stream)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.schema import MODEL_GROUP

# ── fixed values: routing rules ───────────────────────────────────────
LANDING_PREFIX = "data/raw/"
LANDING_SUFFIX = ".csv"
OBJECT_SOURCE = "aws.s3"
OBJECT_DETAIL_TYPE = "Object Created"
APPROVAL_SOURCE = "aws.sagemaker"
APPROVAL_DETAIL_TYPE = "SageMaker Model Package State Change"
APPROVED_STATUS = "Approved"
# ───────────────────────────────────────────────────────────────────────

OBJECT_EVENT = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("detail-type", T.StringType()),
    T.StructField("detail", T.StructType([
        T.StructField("bucket", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField("object", T.StructType([T.StructField("key", T.StringType()),
                                              T.StructField("size", T.LongType())])),
    ])),
])

APPROVAL_EVENT = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("detail-type", T.StringType()),
    T.StructField("detail", T.StructType([
        T.StructField("ModelPackageArn", T.StringType()),
        T.StructField("ModelPackageGroupName", T.StringType()),
        T.StructField("ModelApprovalStatus", T.StringType()),
        T.StructField("ModelPackageStatus", T.StringType()),
    ])),
])


def route_object_events(df: DataFrame, body: str = "body", bucket_name: str | None = None) -> DataFrame:
    """Add bucket, key, rule_match, status_code, outcome for object-created events."""
    e = F.from_json(F.col(body), OBJECT_EVENT)
    bucket = F.coalesce(e["detail"]["bucket"]["name"], F.lit(""))
    key = F.coalesce(e["detail"]["object"]["key"], F.lit(""))
    rule = ((e["source"] == OBJECT_SOURCE) & (e["detail-type"] == OBJECT_DETAIL_TYPE)
            & key.startswith(LANDING_PREFIX))
    if bucket_name is not None:
        rule = rule & (bucket == bucket_name)
    missing = (bucket == "") | (key == "")
    eligible = key.startswith(LANDING_PREFIX) & key.endswith(LANDING_SUFFIX)
    return df.select(
        "*", bucket.alias("bucket"), key.alias("key"),
        F.coalesce(rule, F.lit(False)).alias("rule_match"),
        F.when(missing, 400).otherwise(200).alias("status_code"),
        F.when(missing, "missing_bucket_or_key").when(~eligible, "skipped")
         .otherwise("triggered").alias("outcome"))


def route_approval_events(df: DataFrame, body: str = "body", group: str = MODEL_GROUP) -> DataFrame:
    """Add package fields, rule_match, status_code, outcome for approval events."""
    e = F.from_json(F.col(body), APPROVAL_EVENT)
    d = e["detail"]
    arn = F.coalesce(d["ModelPackageArn"], F.lit(""))
    grp = F.coalesce(d["ModelPackageGroupName"], F.lit(""))
    status = F.coalesce(d["ModelApprovalStatus"], F.lit(""))
    rule = ((e["source"] == APPROVAL_SOURCE) & (e["detail-type"] == APPROVAL_DETAIL_TYPE)
            & (status == APPROVED_STATUS) & (grp == group))
    return df.select(
        "*", arn.alias("package_arn"), grp.alias("package_group"), status.alias("approval_status"),
        F.coalesce(rule, F.lit(False)).alias("rule_match"),
        F.when(arn == "", 400).otherwise(200).alias("status_code"),
        F.when(arn == "", "missing_arn").when(grp != group, "skip_group")
         .when(status != APPROVED_STATUS, "skip_status").otherwise("deploy").alias("outcome"))
