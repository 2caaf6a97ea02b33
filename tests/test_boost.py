"""Boosted trees from histograms: the trees of Spark ML's learner, in bytes a row and even shares."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tarmac.operators import boost as bx
from tarmac.operators import train as trx
from tarmac.schema import FEATURE_COLS

PARAMS = {"n_estimators": 7, "max_depth": 3, "min_samples_leaf": 20}


@pytest.fixture(scope="module")
def rows(spark):
    noise = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(1000)) / 1000
    df = spark.range(3000).withColumns({c: F.floor(noise(k) * (k + 3)).cast("int") for k, c in enumerate(FEATURE_COLS)})
    late = 0.15 + 0.05 * F.col(FEATURE_COLS[5]) + F.when(F.col(FEATURE_COLS[9]) > 4, 0.3).otherwise(0)
    return df.withColumn("delayed", (noise(99) < late).cast("int")).cache()


def scores(model, rows):
    out = model.transform(trx.model_input(rows)).select("id", vector_to_array("probability")[1].alias("p")).collect()
    return {r["id"]: r["p"] for r in out}


def test_same_scores_as_the_spark_learner(rows):
    data = VectorAssembler(inputCols=FEATURE_COLS, outputCol="features").transform(rows)
    known = GBTClassifier(labelCol="delayed", maxIter=7, maxDepth=3, stepSize=0.08, minInstancesPerNode=20,
                          maxBins=64, seed=42).fit(data)
    want = {r["id"]: r["p"] for r in known.transform(data).select("id", vector_to_array("probability")[1].alias("p")).collect()}
    model = trx.fit_model(rows, PARAMS)
    got = scores(model, rows)
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in got) < 1e-9
    assert np.allclose(model.stages[-1].featureImportances.toArray(), known.featureImportances.toArray())
    assert [t.numNodes for t in model.stages[-1].trees] == [t.numNodes for t in known.trees]


def test_shares_and_margins_do_not_change_the_trees(rows, monkeypatch):
    want = scores(trx.fit_model(rows, PARAMS), rows)
    for name, value in (("REBASE_TREES", 2), ("BLOCK_ROWS", 100), ("COLLECT_PARTS", 1)):
        monkeypatch.setattr(bx, name, value)
    got = scores(trx.fit_model(rows.repartition(7), PARAMS), rows)
    assert max(abs(got[k] - want[k]) for k in got) < 1e-9


def test_candidates_are_exact(spark):
    df = spark.range(10_000).select((F.col("id") % 3).cast("double").alias("few"),
                                    F.when(F.col("id") < 5000, F.lit(7)).otherwise(F.col("id")).alias("many"))
    few, many = bx.split_candidates(df.withColumn("gap", F.lit(None).cast("double")), ["few", "many", "gap"], 8)[:2]
    assert few.tolist() == [0.5, 1.5] and len(many) <= 7 and 7 < many[0] < 5000 and (np.diff(many) > 0).all()
    shares = np.searchsorted(many, [r[0] for r in df.select("many").collect()], "left")
    assert np.bincount(shares)[1:].max() <= 10_000 / 8 + 1                    # but for the value held by half


def test_rows_take_a_byte_a_value(rows):
    cuts = bx.split_candidates(rows, FEATURE_COLS, 64)
    blocks = bx.binned(rows.coalesce(1), FEATURE_COLS, "delayed", cuts).collect()
    assert sum(len(r["bins"]) + len(r["signs"]) for r in blocks) == 3000 * (len(FEATURE_COLS) + 1)


def test_bad_labels_and_no_rows_are_errors(rows):
    with pytest.raises(Exception, match="labels must be 0 or 1"):
        trx.fit_model(rows.withColumn("delayed", F.lit(None).cast("int")), PARAMS)
    with pytest.raises(ValueError, match="no rows"):
        trx.fit_model(rows.limit(0), PARAMS)
