"""The fitted trees as a table: scores by a walk, importances from gains, a fit that must find a rule."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac.operators import scoring as scx
from tarmac.operators import train as trx
from tarmac.plans import catalog as C
from tarmac.schema import FEATURE_COLS
from tarmac.sources.model_store import ModelBundle


@pytest.fixture(scope="module")
def fitted(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trees"))
    rows = C.q_engineer_features(spark, SF_SMALL)
    model = trx.fit_model(rows, {"n_estimators": 6, "max_depth": 4})
    model.write().overwrite().save(f"{path}/pipeline")
    return rows, ModelBundle(model, None), trx.node_table(spark, f"{path}/pipeline")


def test_walk_gives_the_model_scores(spark, fitted):
    rows, bundle, nodes = fitted
    missing = rows.limit(5).withColumns({"flight_id": -F.col("flight_id") - 1, "dep_month": F.lit(None).cast("int")})
    rows = rows.unionByName(missing)                                   # a missing month takes a value of its own
    given = {r["flight_id"]: r["p_delayed"] for r in scx.predict(rows, bundle).collect()}
    walked = {r["flight_id"]: r["p_delayed"] for r in trx.tree_walk(rows, nodes, "flight_id", 4).collect()}
    assert given.keys() == walked.keys() and all(abs(given[k] - walked[k]) < 1e-9 for k in given)
    moved = nodes.withColumn("threshold", F.col("threshold") + 3)       # another model, other scores
    other = {r["flight_id"]: r["p_delayed"] for r in trx.tree_walk(rows, moved, "flight_id", 4).collect()}
    assert any(abs(given[k] - other[k]) > 1e-3 for k in given)


def test_walk_shuffles_only_partial_sums(fitted):
    rows, _, nodes = fitted
    plan = trx.tree_walk(rows, nodes, "flight_id", 4)._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "SortMergeJoin" not in plan.split("partial_sum")[0]


def test_importances_are_shares_of_gains(fitted):
    _, bundle, nodes = fitted
    own = {r["feature"]: r["importance"] for r in trx.importance_of_gains(nodes).collect()}
    given = {r["feature"]: r["importance"] for r in trx.feature_importance(bundle.pipeline).collect()}
    assert own.keys() == given.keys() == set(FEATURE_COLS)
    assert all(abs(own[c] - given[c]) < 1e-9 for c in own) and abs(sum(own.values()) - 1) < 1e-9


def test_fit_finds_a_planted_rule(spark, monkeypatch):
    got = C.q_planted_fit(spark, SF_SMALL).orderBy("split").collect()
    assert [(r["feature"], r["threshold"]) for r in got] == [("dep_hour", 14.5), ("dep_month", 6.5)]
    assert all(r["right"] == r["rows"] > 100 and 0 < r["predicted"] < r["rows"] for r in got)
    fit = trx.fit_model
    monkeypatch.setattr(trx, "fit_model", lambda train, params: fit(train.withColumn("delayed", F.col("is_weekend")), params))
    bad = C.q_planted_fit(spark, SF_SMALL).collect()                    # a model that learnt something else
    assert not bad or bad[0]["right"] < bad[0]["rows"]
