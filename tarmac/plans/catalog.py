"""The query catalog: one Spark DataFrame builder per operator of the survey.

Each builder takes ``(spark, sf_dir)``, reads the given tables (or the
``flights`` view derived from ``orders``) and returns a lazy DataFrame.
Column names equal those of the matching SQL in ``oracle_sql.ORACLE``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.functions import tiers as tx
from tarmac.operators import drift as dx
from tarmac.operators import metrics as mx
from tarmac.operators import profile as px
from tarmac.operators import quality as qx
from tarmac.operators import registry as rx
from tarmac.operators import routing as ox
from tarmac.operators import scoring as scx
from tarmac.operators import split as sx
from tarmac.operators import train as trx
from tarmac.operators.encode import fit_frequencies, frequency_counts
from tarmac.operators.featurize import base_features, create_target, engineer_features
from tarmac.schema import FEATURE_COLS, GBT_PARAMS, RAW_REQUIRED_COLS, REFERENCE_SAMPLE_ROWS
from tarmac.session import scratch_path
from tarmac.sources import events as ex
from tarmac.sources.csv_landing import normalize_columns, read_raw_csv
from tarmac.sources.model_store import ModelBundle, saved_folder
from tarmac.sources.tables import load_flights, load_table
from tarmac.streaming import landing as lx
from tarmac.streaming import monitor as mnx
from tarmac.streaming import scoring as ssx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def labelled_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return create_target(load_flights(spark, sf_dir))


@query("engineer_features")
def q_engineer_features(spark, sf_dir):
    """Flagship: label + all 14 features, frequencies fitted on the labelled frame."""
    return engineer_features(labelled_flights(spark, sf_dir), keep=["flight_id"])


# ── shared derived frames ─────────────────────────────────────────────


def plain_features(spark, sf_dir):
    """Labelled flights with the features that need no fitted state (no encoding joins)."""
    return base_features(labelled_flights(spark, sf_dir))


def split_features(spark, sf_dir):
    """All features and the split, which depends on id and label alone and so comes first."""
    split = sx.stratified_split(labelled_flights(spark, sf_dir), id_col="flight_id")
    return engineer_features(split, keep=["flight_id", "split"])


def with_rule_score(f: DataFrame) -> DataFrame:
    """A fixed rule score in [0, 1] used by the SQL-checkable metric operators."""
    score = (F.col("dep_hour") + 4 * F.col("is_holiday_season") + 3 * F.col("is_weekend")) / 40.0
    return (f.withColumn("rule_score", score)
             .withColumn("rule_pred", (F.col("rule_score") >= 0.5).cast("int")))


def rule_scored(spark, sf_dir):
    return with_rule_score(plain_features(spark, sf_dir))


@query("label_rate")
def q_label_rate(spark, sf_dir):
    return mx.positive_rate(labelled_flights(spark, sf_dir), "delayed")


@query("frequency_counts")
def q_frequency_counts(spark, sf_dir):
    return frequency_counts(base_features(labelled_flights(spark, sf_dir)))


@query("time_bucket_counts")
def q_time_bucket_counts(spark, sf_dir):
    return plain_features(spark, sf_dir).groupBy("dep_time_bucket").agg(F.count(F.lit(1)).alias("n"))


@query("hub_flags")
def q_hub_flags(spark, sf_dir):
    return (plain_features(spark, sf_dir).groupBy("is_hub_origin", "is_hub_dest")
            .agg(F.count(F.lit(1)).alias("n")))


@query("quality_report")
def q_quality_report(spark, sf_dir):
    return qx.quality_report(load_flights(spark, sf_dir).drop("flight_id"))


@query("quarantine")
def q_quarantine(spark, sf_dir):
    _, bad = qx.split_requests(load_flights(spark, sf_dir))
    return bad.select("flight_id", F.concat_ws(";", "errors").alias("errors"))


@query("feature_profile")
def q_feature_profile(spark, sf_dir):
    train = split_features(spark, sf_dir).where(F.col("split") == "train")
    return px.feature_profile(train, FEATURE_COLS)


@query("baseline_quantiles")
def q_baseline_quantiles(spark, sf_dir):
    train = split_features(spark, sf_dir).where(F.col("split") == "train")
    return px.exact_quantiles(train, FEATURE_COLS)


@query("baseline_constraints")
def q_baseline_constraints(spark, sf_dir):
    train = split_features(spark, sf_dir).where(F.col("split") == "train")
    return px.baseline_constraints(train, FEATURE_COLS)


@query("null_counts")
def q_null_counts(spark, sf_dir):
    raw = normalize_columns(load_flights(spark, sf_dir))
    return px.null_counts(raw, RAW_REQUIRED_COLS)


@query("dup_fraction_lineitem")
def q_dup_lineitem(spark, sf_dir):
    return qx.duplicate_stats(load_table(spark, sf_dir, "lineitem"))


@query("dup_fraction_flights")
def q_dup_flights(spark, sf_dir):
    return qx.duplicate_stats(load_flights(spark, sf_dir).drop("flight_id"))


@query("split_assign")
def q_split_assign(spark, sf_dir):
    split = sx.stratified_split(labelled_flights(spark, sf_dir), id_col="flight_id")
    return split.select("flight_id", "delayed", "split")


@query("split_counts")
def q_split_counts(spark, sf_dir):
    return sx.split_counts(sx.stratified_split(labelled_flights(spark, sf_dir), id_col="flight_id"))


@query("reference_sample")
def q_reference_sample(spark, sf_dir):
    train = split_features(spark, sf_dir).where(F.col("split") == "train")
    return sx.reference_sample(train, "flight_id", REFERENCE_SAMPLE_ROWS).select(
        "flight_id", *FEATURE_COLS, "delayed")


@query("binary_metrics")
def q_binary_metrics(spark, sf_dir):
    return mx.binary_metrics(rule_scored(spark, sf_dir), "delayed", "rule_pred")


@query("segment_metrics")
def q_segment_metrics(spark, sf_dir):
    return mx.binary_metrics(rule_scored(spark, sf_dir), "delayed", "rule_pred",
                             by=["dep_time_bucket"])


@query("roc_auc")
def q_roc_auc(spark, sf_dir):
    return mx.roc_auc(rule_scored(spark, sf_dir), "delayed", "rule_score")


@query("segment_roc_auc")
def q_segment_roc_auc(spark, sf_dir):
    return mx.roc_auc(rule_scored(spark, sf_dir), "delayed", "rule_score", by=["is_holiday_season"])


@query("risk_confidence")
def q_risk_confidence(spark, sf_dir):
    s = rule_scored(spark, sf_dir)
    p = tx.round4("rule_score")
    return s.select("flight_id", F.col("rule_pred").alias("delayed"),
                    p.alias("delay_probability"), tx.risk_level(p).alias("risk_level"),
                    tx.confidence_level(p).alias("confidence"),
                    tx.flight_label().alias("flight"))


@query("batch_summary")
def q_batch_summary(spark, sf_dir):
    return mx.batch_summary(rule_scored(spark, sf_dir).withColumnRenamed("rule_pred", "delayed_pred"),
                            "delayed_pred")


# ── registry, routing, monitoring (tables derived from events) ───────

CAPTURE_FEATURES = ["value", "k", "user_id"]


def registry(spark, sf_dir):
    return ex.registry_from_events(load_table(spark, sf_dir, "events"))


def comparison(spark, sf_dir):
    reg = registry(spark, sf_dir)
    return rx.compare_champion(rx.latest_per_group(reg, "PendingManualApproval"),
                               rx.latest_per_group(reg, "Approved"))


@query("latest_approved")
def q_latest_approved(spark, sf_dir):
    p = rx.package_metrics(rx.latest_per_group(registry(spark, sf_dir), "Approved"))
    return p.select("group_name", "package_id", "created_at", "metrics_bucket", "metrics_key",
                    F.col("metrics.val_f1").alias("val_f1"))


@query("compare_champion")
def q_compare_champion(spark, sf_dir):
    return comparison(spark, sf_dir).select(
        "group_name", "challenger_package", "champion_package", "challenger_score",
        "champion_score", "improvement", "beats_champion")


@query("decision_json")
def q_decision_json(spark, sf_dir):
    return rx.read_decision(rx.decision_document(comparison(spark, sf_dir)))


@query("register_candidates")
def q_register_candidates(spark, sf_dir):
    return rx.registrations(rx.decision_document(comparison(spark, sf_dir)), registry(spark, sf_dir))


@query("approval_route")
def q_approval_route(spark, sf_dir):
    ev = ex.approval_events(load_table(spark, sf_dir, "events"))
    return ox.route_approval_events(ev).drop("body")


@query("object_route")
def q_object_route(spark, sf_dir):
    ev = ex.object_events(load_table(spark, sf_dir, "events"))
    return ox.route_object_events(ev, bucket_name=ex.DATA_BUCKET).drop("body")


@query("champion_loop")
def q_champion_loop(spark, sf_dir):
    """Every pending package's model once registered from a written decision and approved,
    against an equal, a worse and a better challenger (group by group)."""
    reg = registry(spark, sf_dir)
    pending = rx.latest_per_group(reg, "PendingManualApproval")
    nobody = reg.where(F.lit(False))
    path = scratch_path(spark, "decisions")
    rx.decision_document(rx.compare_champion(pending, nobody)).write.mode("overwrite").parquet(path)
    docs = spark.read.parquet(path).select("group_name", F.col("doc").alias("metrics_doc"))
    approved = pending.drop("metrics_doc").join(docs, "group_name").withColumns(
        {"status": F.lit("Approved"), "metrics_uri": F.concat(F.lit("approved/"), "group_name")})
    out = None
    for case, change in (("equal", 0.0), ("worse", -0.05), ("better", 0.05)):
        known = rx.package_metrics(pending)
        f1 = F.coalesce(F.col("metrics.val_f1"), F.lit(0.0)) + change
        doc = F.to_json(F.struct(F.struct(f1.alias("val_f1")).alias("challenger")))
        rival = known.withColumns({"metrics_doc": doc, "metrics_uri": F.lit("candidate")}).select(*pending.columns)
        row = rx.compare_champion(rival, approved).select(
            "group_name", F.lit(case).alias("case"), F.bround("improvement", 4).alias("improvement"),
            "beats_champion")
        out = row if out is None else out.unionByName(row)
    return out


def monitoring(spark, sf_dir):
    """(daily statistics, baseline), written down: both are small and read several times."""
    capture = dx.capture_from_events(load_table(spark, sf_dir, "events"))
    ref, mon = dx.split_reference_window(capture)
    base = dx.baseline_stats(dx.long_capture(ref, CAPTURE_FEATURES)).checkpoint(eager=True)
    stats = dx.daily_stats(dx.long_capture(mon, CAPTURE_FEATURES)).checkpoint(eager=True)
    return stats, base


@query("daily_stats")
def q_daily_stats(spark, sf_dir):
    stats, _ = monitoring(spark, sf_dir)
    return stats.select("day", "feature", "n", "nulls", "type_errors",
                        F.bround("mean", 4).alias("mean"), F.bround("std", 4).alias("std"))


@query("daily_drift")
def q_daily_drift(spark, sf_dir):
    stats, base = monitoring(spark, sf_dir)
    return dx.violations(stats, base)


@query("drift_alarm")
def q_drift_alarm(spark, sf_dir):
    stats, base = monitoring(spark, sf_dir)
    return dx.drift_alarm(stats, base)


# ── captured flights against the stored baseline of the training rows ─


_CHECKED: dict = {}


def flight_checks(spark, sf_dir):
    """Checks of all flights as captured traffic (two weeks of it) against the stored baseline of
    the training rows. The capture is published in two batches, the second with rows that
    come late for days of the first, and the monitor runs after each. Once per application
    and data folder."""
    from tarmac.plans import jobs
    from tarmac.sources.committed import publish

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CHECKED:
        split = base_features(sx.stratified_split(labelled_flights(spark, sf_dir), id_col="flight_id"))
        train = split.where(F.col("split") == "train")
        encoder = fit_frequencies(train)
        path = scratch_path(spark, "flight-baseline")
        encoder.transform(train).select(*FEATURE_COLS).write.parquet(f"{path}/reference")
        jobs.baseline_job(spark, f"{path}/reference", f"{path}/baseline")
        days = F.pmod("flight_id", F.lit(14))
        at = dx.utc_instant(F.timestamp_add("DAY", days, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
        captured = (load_flights(spark, sf_dir).withColumn("captured_at", at)
                    .withColumn("capture_date", dx.utc_day("captured_at")))
        early = (days < 7) & (F.pmod("flight_id", F.lit(5)) > 0)
        for batch, rows in enumerate((captured.where(early), captured.where(~early))):
            publish(rows, f"{path}/capture", "capture_date", batch)
            jobs.monitor_new(spark, f"{path}/capture", encoder, f"{path}/baseline", f"{path}/monitor")
        _CHECKED[key] = path
    return spark.read.parquet(f"{_CHECKED[key]}/monitor/checks")


@query("flight_drift")
def q_flight_drift(spark, sf_dir):
    """Statistical checks of every day and feature."""
    c = flight_checks(spark, sf_dir)
    return c.where(F.col("check").isin("baseline_drift", "missing_values", "data_type_errors"))


@query("flight_constraints")
def q_flight_constraints(spark, sf_dir):
    """Checks of the baseline's constraints."""
    c = flight_checks(spark, sf_dir)
    return c.where(F.col("check").isin("completeness", "non_negative", "range_min", "range_max", "data_type"))


@query("flight_psi")
def q_flight_psi(spark, sf_dir):
    """Stability index of every day and feature on the baseline's stored bins."""
    return flight_checks(spark, sf_dir).where(F.col("check") == "psi")


@query("flight_bins")
def q_flight_bins(spark, sf_dir):
    """Equi-depth bins of the training rows, as stored with the baseline."""
    flight_checks(spark, sf_dir)
    path = _CHECKED[(spark.sparkContext.applicationId, sf_dir)]
    return spark.read.parquet(f"{path}/baseline/bins").select(
        "feature", F.posexplode("counts").alias("bin", "rows")).withColumn("bin", F.col("bin").cast("long"))


@query("flight_alarm")
def q_flight_alarm(spark, sf_dir):
    return dx.alarm_of_checks(flight_checks(spark, sf_dir))


@query("daily_psi")
def q_daily_psi(spark, sf_dir):
    capture = dx.capture_from_events(load_table(spark, sf_dir, "events"))
    ref, mon = dx.split_reference_window(capture)
    return dx.daily_psi(dx.long_capture(ref, CAPTURE_FEATURES), dx.long_capture(mon, CAPTURE_FEATURES))


@query("served_stats")
def q_served_stats(spark, sf_dir):
    return dx.served_stats(dx.capture_from_events(load_table(spark, sf_dir, "events")))


# ── model training and scoring ───────────────────────────────────────
# Trees can't be restated in SQL; what must hold of their output can, row by row.

_BUNDLES: dict = {}


def trained_bundle(spark, sf_dir) -> tuple[ModelBundle, DataFrame, str]:
    """(saved and loaded bundle, train/val/test features, folder). Frequencies are counted on the
    training rows. Fitted once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _BUNDLES:
        path = scratch_path(spark, "model")
        split = base_features(sx.stratified_split(labelled_flights(spark, sf_dir), id_col="flight_id"))
        enc = fit_frequencies(split.where(F.col("split") == "train"))
        enc.transform(split).select("flight_id", "split", *FEATURE_COLS, "delayed").write.parquet(f"{path}/split")
        rows = spark.read.parquet(f"{path}/split")
        bundle = ModelBundle(pipeline=trx.fit_model(rows.where(F.col("split") == "train")), encoder=enc)
        (scx.predict(rows.where(F.col("split") == "val"), bundle).select("flight_id", "p_delayed")
         .write.parquet(f"{path}/val_scores"))          # by the model as fitted, before it was saved
        bundle.save(path)
        _BUNDLES[key] = path
    path = _BUNDLES[key]
    return ModelBundle.load(spark, path), spark.read.parquet(f"{path}/split"), path


def val_report(spark, sf_dir):
    bundle, rows, _ = trained_bundle(spark, sf_dir)
    return mx.classification_report(scx.predict(rows.where(F.col("split") == "val"), bundle),
                                    "delayed", "p_delayed", "prediction")


@query("train_metrics")
def q_train_metrics(spark, sf_dir):
    """Validation report: row and positive counts, and whether cells and ratios agree."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    ratio = lambda a, b: tx.round4(F.coalesce(F.try_divide(a, b), F.lit(0.0)))
    return val_report(spark, sf_dir).select(
        "n", (tp + fn).alias("positives"), (tp + fp + fn + tn == F.col("n")).alias("cells_add_up"),
        ((ratio(tp + tn, F.col("n")) == F.col("accuracy")) & (ratio(tp, tp + fp) == F.col("precision"))
         & (ratio(tp, tp + fn) == F.col("recall"))
         & (ratio(2 * tp, 2 * tp + fp + fn) == F.col("f1"))).alias("ratios_follow"),
        F.col("auc").between(0, 1).alias("auc_in_range"))


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Every feature, whether its importance is a share of one and its rank one of 1 … 14."""
    bundle, _, _ = trained_bundle(spark, sf_dir)
    rows = trx.feature_importance(bundle.pipeline)
    total = rows.agg(F.sum("importance").alias("total"), F.collect_set("rank").alias("ranks"))
    n = len(FEATURE_COLS)
    return rows.join(F.broadcast(total), F.lit(True)).select(                        # one row
        "feature", (F.col("importance").between(0, 1) & (F.abs(F.col("total") - 1) < 1e-6)).alias("is_share"),
        (F.col("rank").between(1, n) & (F.size("ranks") == n)).alias("is_ranked"))


@query("tree_walk")
def q_tree_walk(spark, sf_dir):
    """Validation rows, and those whose score by a walk over the node table differs from the model's."""
    bundle, rows, path = trained_bundle(spark, sf_dir)
    val = rows.where(F.col("split") == "val")
    walked = trx.tree_walk(val, trx.node_table(spark, f"{saved_folder(spark, path)}/pipeline"), "flight_id", GBT_PARAMS["max_depth"])
    both = (scx.predict(val, bundle).select("flight_id", F.col("p_delayed").alias("p_model"))
            .join(walked, "flight_id", "left"))
    same = F.coalesce(F.abs(F.col("p_model") - F.col("p_delayed")) < 1e-9, F.lit(False))
    return both.agg(F.count(F.lit(1)).alias("rows"), F.count_if(~same).alias("differ"))


@query("importance_of_gains")
def q_importance_of_gains(spark, sf_dir):
    """Every feature, and whether its importance is its share of the gains in the node table."""
    bundle, _, path = trained_bundle(spark, sf_dir)
    own = trx.importance_of_gains(trx.node_table(spark, f"{saved_folder(spark, path)}/pipeline")).withColumnRenamed("importance", "own")
    given = trx.feature_importance(bundle.pipeline)
    return own.join(F.broadcast(given), "feature").select(
        "feature", (F.abs(F.col("own") - F.col("importance")) < 1e-9).alias("agrees"))


def planted_rule():
    return (F.col("dep_hour") >= 15) & (F.col("dep_month") <= 6)


@query("planted_fit")
def q_planted_fit(spark, sf_dir):
    """A fit that must find a rule: labels follow from hour and month, and the first tree must
    split where they do. Its splits, and the validation rows with their right predictions."""
    split = base_features(sx.stratified_split(labelled_flights(spark, sf_dir), id_col="flight_id"))
    enc = fit_frequencies(split.where(F.col("split") == "train"))
    path = scratch_path(spark, "planted")
    (enc.transform(split).where("dep_hour is not null and dep_month is not null")
     .withColumn("delayed", planted_rule().cast("int")).select("flight_id", "split", *FEATURE_COLS, "delayed")
     .write.parquet(f"{path}/rows"))
    rows = spark.read.parquet(f"{path}/rows")
    bundle = ModelBundle(trx.fit_model(rows.where(F.col("split") == "train"), {"n_estimators": 5, "max_depth": 2}), enc)
    nodes = trx.node_table(spark, f"{bundle.save(f'{path}/model')}/pipeline").where("tree = 0 and feature is not null")
    names = F.array(*[F.lit(c) for c in FEATURE_COLS])
    splits = nodes.select((F.row_number().over(Window.orderBy("node")) - 1).cast("long").alias("split"),     # three rows
                          F.get(names, F.col("feature")).alias("feature"), "threshold")
    found = scx.predict(rows.where(F.col("split") == "val"), bundle).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("prediction") == 1).alias("predicted"),
        F.count_if(F.col("prediction") == F.col("delayed")).alias("right"))
    return splits.join(F.broadcast(found), F.lit(True))


@query("quality_gates")
def q_quality_gates(spark, sf_dir):
    """Gates with their thresholds, and whether each flag is value >= threshold."""
    gates = trx.quality_gates(val_report(spark, sf_dir))
    return gates.select("gate", "threshold",
                        (F.col("passed") == (F.col("value") >= F.col("threshold"))).alias("flag_follows"))


@query("run_record")
def q_run_record(spark, sf_dir):
    """The record of the training run: what it names and whether every part is there."""
    _, _, path = trained_bundle(spark, sf_dir)
    m = val_report(spark, sf_dir).first().asDict()
    metrics = {f"val_{k}": m[k] for k in ("accuracy", "f1", "precision", "recall", "auc")}
    rec = trx.run_record(spark, GBT_PARAMS, {"model_type": "GBTClassifier"}, metrics, path)
    return rec.select(F.size("params").cast("long").alias("n_params"),
                      F.col("tags")["model_type"].alias("model_type"),
                      F.size("metrics").cast("long").alias("n_metrics"),
                      (F.length("run_id") == 36).alias("has_run_id"),
                      F.col("model_uri").isNotNull().alias("has_model_uri"))


@query("model_roundtrip")
def q_model_roundtrip(spark, sf_dir):
    """Validation rows, and those whose score changed when the model was saved and loaded."""
    bundle, rows, path = trained_bundle(spark, sf_dir)
    loaded = scx.predict(rows.where(F.col("split") == "val"), bundle).select(
        "flight_id", F.col("p_delayed").alias("p_loaded"))
    both = loaded.join(spark.read.parquet(f"{path}/val_scores"), "flight_id")
    return both.agg(F.count(F.lit(1)).alias("rows"),
                    F.count_if(F.col("p_loaded") != F.col("p_delayed")).alias("changed"))


def scoring_facts(scored: DataFrame, rejected: DataFrame, id_col: str) -> DataFrame:
    """A row for every request: scored or rejected, the flight's label, whether the tiers follow
    from the published probability, and whether class and probability are in range."""
    p = F.col("delay_probability")
    return scored.select(
        id_col, F.lit("scored").alias("outcome"), "flight",
        ((F.col("risk_level") == tx.risk_level(p)) & (F.col("confidence") == tx.confidence_level(p)))
        .alias("tiers_follow"),
        (p.between(0, 1) & F.col("delayed").isin(0, 1)).alias("in_range")).unionByName(rejected.select(
            id_col, F.lit("rejected").alias("outcome"), F.lit(None).cast("string").alias("flight"),
            F.lit(None).cast("boolean").alias("tiers_follow"), F.lit(None).cast("boolean").alias("in_range")))


@query("score_flights")
def q_score_flights(spark, sf_dir):
    """All flights as requests (labelled or not)."""
    bundle, _, _ = trained_bundle(spark, sf_dir)
    scored, rejected = scx.score(normalize_columns(load_flights(spark, sf_dir)), bundle, keep=["flight_id"])
    return scoring_facts(scored, rejected, "flight_id")


@query("behaviour_checks")
def q_behaviour_checks(spark, sf_dir):
    """Morning (08:00) vs evening (19:00) copies of every val flight, scored together."""
    bundle, rows, _ = trained_bundle(spark, sf_dir)
    val = rows.where(F.col("split") == "val").drop("dep_hour", "dep_time_bucket")
    pairs = val.withColumn("slot", F.explode(F.array(F.lit(8), F.lit(19))))
    pairs = pairs.withColumn("dep_hour", F.col("slot").cast("int")).withColumn(
        "dep_time_bucket", F.when(F.col("slot") < 12, 1).otherwise(3).cast("int"))
    b = trx.behaviour_summary(scx.predict(pairs, bundle), "slot", morning=8, evening=19)
    return b.select("pairs", ((F.col("min_pred") >= 0) & (F.col("max_pred") <= 1)).alias("classes_ok"),
                    ((F.col("min_p") >= 0) & (F.col("max_p") <= 1)).alias("probabilities_ok"),
                    (F.col("max_sum_error") < 1e-6).alias("sums_ok"), "evening_not_lower")


# ── Structured Streaming variants (same answers as the batch queries) ─


@query("stream_daily_stats")
def q_stream_daily_stats(spark, sf_dir):
    """events.parquet as a file stream → partial daily statistics per batch → merged on read."""
    schema = load_table(spark, sf_dir, "events").schema
    src = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
           .parquet(sf_dir))
    base = scratch_path(spark, "monitor")
    q = mnx.start_daily_stats_stream(spark, dx.capture_from_events(src), CAPTURE_FEATURES,
                                     f"{base}/stats", f"{base}/_checkpoint")
    q.awaitTermination()
    out = mnx.read_daily_stats(spark, f"{base}/stats")
    return out.select("day", "feature", "n", "nulls", "type_errors",
                      F.bround("mean", 4).alias("mean"), F.bround("std", 4).alias("std"))


# A cell with everything that ends a cell or a line elsewhere.
NOTE = 'gate "B7",\nlate crew\n\n"ok"'


def write_csv_layouts(rows: DataFrame, base: str) -> None:
    """All rows as CSV files under ``base``, a sixth in each layout: plain; reversed with a further
    column; whole numbers with a fraction and missing values spelled out; a cell with line
    breaks, quotes and commas in every row; a blank line behind every row; such cells with
    CRLF line ends."""
    numbers = ("CRS_DEP_TIME", "CRS_ARR_TIME", "CRS_ELAPSED_TIME", "DISTANCE", "DEP_DELAY", "ARR_DELAY")
    layouts = [
        (lambda df: df, {}),
        (lambda df: df.select(*reversed(df.columns), F.lit("x").alias("NOTE")), {}),
        (lambda df: df.withColumns({c: F.coalesce(F.col(c).cast("double").cast("string"), F.lit("NA"))
                                    for c in numbers}), {}),
        (lambda df: df.select(F.lit(NOTE).alias("NOTE"), "*"), {"escape": '"'}),
        (lambda df: df, {"lineSep": "\n\n"}),
        (lambda df: df.select("*", F.concat("flight_id", F.lit(NOTE)).alias("NOTE")), {"escape": '"', "lineSep": "\r\n"}),
    ]
    for k, (shape, options) in enumerate(layouts):
        part = rows.where(F.pmod("flight_id", F.lit(len(layouts))) == k)
        shape(part).write.option("header", True).options(**options).csv(f"{base}/{k}")


@query("stream_landing")
def q_stream_landing(spark, sf_dir):
    """flights written as CSV files of all layouts into a landing folder → file stream → labelled rows."""
    base = scratch_path(spark, "landing")
    write_csv_layouts(load_flights(spark, sf_dir), f"{base}/in/data/raw")
    q = lx.start_landing_stream(spark, f"{base}/in", f"{base}/out", f"{base}/_checkpoint")
    q.awaitTermination()
    out = spark.read.parquet(f"{base}/out/labelled")
    return out.drop("batch_id", "source_file")


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """All flights written as CSV in every layout and read back."""
    base = scratch_path(spark, "csv")
    write_csv_layouts(load_flights(spark, sf_dir), base)
    back = read_raw_csv(spark, base, keep_file=False, id_col="flight_id")
    return back.withColumn("flight_id", F.col("flight_id").cast("long")).withColumn(
        "type_errors", F.size("_type_errors").cast("long")).drop("_type_errors")


@query("stream_scoring_capture")
def q_stream_scoring_capture(spark, sf_dir):
    """All flights as a request stream → capture table and quarantine, a row for each request."""
    bundle, _, _ = trained_bundle(spark, sf_dir)
    base = scratch_path(spark, "scoring")
    reqs = (normalize_columns(load_flights(spark, sf_dir))
            .withColumnRenamed("flight_id", "request_id").drop("DEP_DELAY", "ARR_DELAY"))
    reqs.write.parquet(f"{base}/requests")
    stream = spark.readStream.schema(reqs.schema).parquet(f"{base}/requests")
    q = ssx.start_scoring_stream(spark, stream, bundle, f"{base}/capture", f"{base}/quarantine",
                                 f"{base}/_checkpoint")
    q.awaitTermination()
    return scoring_facts(ssx.read_capture(spark, f"{base}/capture"), spark.read.parquet(f"{base}/quarantine"),
                         "request_id")
