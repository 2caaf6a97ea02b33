"""Saved models and registered packages: whole or not at all, and never under a number twice."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac.operators import scoring as scx
from tarmac.operators import train as trx
from tarmac.operators.encode import FrequencyModel, fit_frequencies
from tarmac.plans import catalog as C
from tarmac.plans import jobs
from tarmac.sources.model_store import ModelBundle, saved_folder
from tarmac.sources.tables import load_flights


def bundle(spark, label, copies):
    rows = C.q_engineer_features(spark, SF_SMALL)
    model = trx.fit_model(rows.withColumn("delayed", F.col(label)), {"n_estimators": 2, "max_depth": 2})
    keys = spark.range(copies).select(*[F.lit("K").alias(c) for c in ("OP_CARRIER", "ORIGIN", "DEST", "route")])
    return ModelBundle(model, fit_frequencies(keys))


def state(spark, path):
    b = ModelBundle.load(spark, path)
    rows = C.q_engineer_features(spark, SF_SMALL)
    p = scx.predict(rows, b).agg(F.round(F.sum("p_delayed"), 6)).first()[0]
    return p, {r["n"] for r in b.encoder.counts.collect()}


def test_a_save_that_dies_leaves_the_pair_before(spark, tmp_dir, monkeypatch):
    first, second = bundle(spark, "is_weekend", 3), bundle(spark, "is_holiday_season", 5)
    first.save(tmp_dir)
    old = state(spark, tmp_dir)
    assert old[1] == {3}
    with monkeypatch.context() as m:
        m.setattr(FrequencyModel, "save", lambda self, path: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            second.save(tmp_dir)
    assert state(spark, tmp_dir) == old                                # new trees are not paired with old counts
    folder = second.save(tmp_dir)
    assert saved_folder(spark, tmp_dir) == folder
    new = state(spark, tmp_dir)
    assert new[1] == {5} and new[0] != old[0]


def test_folders_without_manifests_are_read(spark, tmp_dir):
    b = bundle(spark, "is_weekend", 4)
    b.pipeline.write().save(f"{tmp_dir}/pipeline")
    b.encoder.save(f"{tmp_dir}/frequencies")
    assert state(spark, tmp_dir)[1] == {4}


def test_two_evaluations_at_once_take_two_ids(spark, tmp_dir, monkeypatch):
    jobs.preprocess(load_flights(spark, SF_SMALL), f"{tmp_dir}/prep", id_col="flight_id")
    for k in (1, 2):
        jobs.train(spark, f"{tmp_dir}/prep", f"{tmp_dir}/models/m{k}", params={"n_estimators": k + 1})
    reg = f"{tmp_dir}/registry"
    empty = jobs.read_registry(spark, reg)
    with monkeypatch.context() as m:                                   # neither sees what the other appends
        m.setattr(jobs, "read_registry", lambda *a: empty)
        for k in (1, 2):
            jobs.evaluate(spark, f"{tmp_dir}/prep", f"{tmp_dir}/models/m{k}", reg, f"{tmp_dir}/e{k}")
    rows = spark.read.parquet(reg).collect()
    assert len({r["package_id"] for r in rows}) == len(rows) == 2
    # run again: the package is known, nothing is appended
    jobs.evaluate(spark, f"{tmp_dir}/prep", f"{tmp_dir}/models/m1", reg, f"{tmp_dir}/e1")
    assert sorted(r["package_id"] for r in spark.read.parquet(reg).collect()) == sorted(r["package_id"] for r in rows)
