"""Plan shape: no Python evaluation, broadcast lookups, shuffle fallback equal to broadcast."""

import contextlib
import io

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from tarmac.operators.encode import FrequencyModel, fit_frequencies
from tarmac.operators.featurize import base_features
from tarmac.plans import catalog as C
from tarmac.sources.tables import load_flights

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas",
            "BroadcastNestedLoopJoin", "CartesianProduct")


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="simple")
    return buf.getvalue()


# queries that fit or apply the trees, or run a stream to its end first
SLOW = {"train_metrics", "feature_importance", "quality_gates", "run_record", "model_roundtrip", "score_flights",
        "behaviour_checks", "stream_scoring_capture", "stream_landing", "csv_roundtrip", "stream_daily_stats",
        "planted_fit", "tree_walk", "importance_of_gains"}


def test_no_python_nodes_or_cartesian_products(spark):
    for name in sorted(set(C.QUERIES) - SLOW):
        text = plan(C.QUERIES[name](spark, SF_SMALL))
        assert not any(n in text for n in PY_NODES), name


def test_encoder_broadcasts_and_prunes(spark):
    text = plan(E.queries()["engineer_features"](spark, SF_SMALL))
    assert text.count("BroadcastHashJoin") == 4
    assert "SortMergeJoin" not in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderdate:timestamp_ntz>" in \
        _formatted(E.queries()["engineer_features"](spark, SF_SMALL))


def _formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@contextlib.contextmanager
def no_auto_broadcast(spark):
    """Only explicit hints broadcast, so the plan shows the encoder's own decision."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, old)


ENC_COLS = ["flight_id", "carrier_encoded", "origin_encoded", "dest_encoded", "route_id_encoded"]


def _hot_carrier_frame(spark):
    from pyspark.sql import functions as F
    base = base_features(C.labelled_flights(spark, SF_SMALL))
    # a third of all rows share one carrier
    return base.withColumn("OP_CARRIER", F.when(F.col("flight_id") % 3 == 0, "HOT")
                           .otherwise(F.col("OP_CARRIER")))


def test_shuffle_fallback_equals_broadcast_with_hot_key(spark):
    from pyspark.sql import functions as F
    hot = _hot_carrier_frame(spark)
    model = fit_frequencies(hot)
    assert model.broadcastable
    small = FrequencyModel(model.counts, model.key_counts, max_broadcast_rows=0)
    assert not small.broadcastable and small.broadcast_keys() == set()
    a = sorted(tuple(r) for r in model.transform(hot).select(ENC_COLS).collect())
    with no_auto_broadcast(spark):
        b_df = small.transform(hot).select(ENC_COLS)
        text = plan(b_df)
        assert "BroadcastHashJoin" not in text
        # four joins of the distinct combinations with the counts, one of the rows with their combination
        assert text.count("SortMergeJoin") == 5
        b = sorted(tuple(r) for r in b_df.collect())
    assert a == b
    assert max(r[1] for r in a) == hot.where(F.col("OP_CARRIER") == "HOT").count()


def test_broadcast_decided_per_key_within_budget(spark):
    hot = _hot_carrier_frame(spark)
    model = fit_frequencies(hot)
    k = model.key_counts
    assert k["route_id_encoded"] > max(k["carrier_encoded"], k["origin_encoded"], k["dest_encoded"])
    # budget for the three small tables together, not for the routes as well
    budget = k["carrier_encoded"] + k["origin_encoded"] + k["dest_encoded"]
    mixed = FrequencyModel(model.counts, k, max_broadcast_rows=budget)
    assert mixed.broadcast_keys() == {"carrier_encoded", "origin_encoded", "dest_encoded"}
    with no_auto_broadcast(spark):
        m_df = mixed.transform(hot).select(ENC_COLS)
        text = plan(m_df)
        assert text.count("BroadcastHashJoin") == 3
        assert text.count("SortMergeJoin") == 1
        got = sorted(tuple(r) for r in m_df.collect())
    assert got == sorted(tuple(r) for r in model.transform(hot).select(ENC_COLS).collect())


def test_no_joins_for_features_without_state(spark):
    # the codes ride along the feature projection, the rule score needs no encoding
    assert "Join" not in plan(E.queries()["risk_confidence"](spark, SF_SMALL))


def test_saved_encoder_keeps_per_key_decision(spark, tmp_dir):
    model = fit_frequencies(_hot_carrier_frame(spark))
    model.save(f"{tmp_dir}/freq")
    k = model.key_counts
    budget = k["carrier_encoded"] + k["origin_encoded"] + k["dest_encoded"]
    loaded = FrequencyModel.load(spark, f"{tmp_dir}/freq", max_broadcast_rows=budget)
    assert loaded.key_counts == k
    assert loaded.broadcast_keys() == {"carrier_encoded", "origin_encoded", "dest_encoded"}


def exchanges_of(df, column):
    """Exchanges of the formatted plan that carry ``column``."""
    nodes = [b for b in _formatted(df).split("\n\n") if ") Exchange" in b.strip().split("\n")[0]]
    return sum(f"{column}#" in b for b in nodes)


def test_keys_beyond_the_budget_share_one_shuffle(spark):
    n = 3000
    rows = spark.range(n).selectExpr(
        "id", "concat('C', id % 7) as OP_CARRIER", "if(id % 3 = 0, null, concat('A', id % 40)) as ORIGIN",
        "if(id % 3 = 0, null, concat('B', id % 11)) as DEST", "id * 2 as payload")
    rows = rows.withColumn("OP_CARRIER", F.when(F.col("id") % 9 > 0, F.col("OP_CARRIER")))
    model = fit_frequencies(rows)
    want = model.transform(rows)
    assert exchanges_of(want, "payload") == 0
    got = FrequencyModel(model.counts, model.key_counts, max_broadcast_rows=0).transform(rows)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert exchanges_of(got, "payload") == 1 and "BroadcastHashJoin" not in \
            got._jdf.queryExecution().executedPlan().toString()
        names = ["id", *model.keys, "payload"]
        assert sorted(map(tuple, got.select(names).collect())) == sorted(map(tuple, want.select(names).collect()))
        # rows without any key lie in many tasks
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        parts = got.where("OP_CARRIER is null and ORIGIN is null and DEST is null") \
            .groupBy(F.spark_partition_id()).count().collect()
        assert len(parts) > 4
        one = FrequencyModel(model.counts, model.key_counts, max_broadcast_rows=sum(sorted(model.key_counts.values())[:3]))
        again = one.transform(rows)
        assert sorted(map(tuple, again.select(names).collect())) == sorted(map(tuple, want.select(names).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_distinct_counts_without_expand(spark):
    from tarmac.operators import quality as qx
    rows = spark.range(500).selectExpr("concat('C', id % 7) as OP_CARRIER", "if(id % 3 = 0, null, cast(id % 40 as string)) as ORIGIN",
                                       "'x' as FL_DATE", "cast(null as string) as none")
    got = qx.distinct_counts(rows, {"a": "OP_CARRIER", "b": "ORIGIN", "c": "FL_DATE", "d": "none"})
    assert tuple(got.first()) == (7, 40, 1, 0)
    report = qx.quality_report(load_flights(spark, SF_SMALL), include_duplicates=False)
    assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()
