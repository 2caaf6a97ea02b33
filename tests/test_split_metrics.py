import hashlib
import math

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tarmac.operators import metrics as mx
from tarmac.operators import split as sx
from tarmac.plans import catalog as C


def _brute_split(rows, test=0.15, val=0.15, seed=42):
    out = {}
    for label in {r[1] for r in rows}:
        s = sorted((hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), i) for i, y in rows if y == label)
        n = len(s)
        t1 = math.floor(test * n + 0.5)
        t2 = t1 + math.floor(val / (1 - test) * (n - t1) + 0.5)
        for k, (_, i) in enumerate(s, start=1):
            out[i] = "test" if k <= t1 else "val" if k <= t2 else "train"
    return out


def test_split_matches_brute_force(spark):
    f = C.q_engineer_features(spark, SF_SMALL)
    got = {r[0]: r[1] for r in sx.stratified_split(f, "flight_id").select("flight_id", "split").collect()}
    rows = [(r[0], r[1]) for r in f.select("flight_id", "delayed").collect()]
    assert got == _brute_split(rows)


def test_split_small_strata_and_ties(spark):
    df = spark.createDataFrame([(i, int(i % 7 == 0)) for i in range(200)], "id long, delayed int")
    got = {r["id"]: r["split"] for r in sx.stratified_split(df, "id").collect()}
    assert got == _brute_split([(i, int(i % 7 == 0)) for i in range(200)])


def _brute_auc(ys, ss):
    pos = [s for y, s in zip(ys, ss) if y == 1]
    neg = [s for y, s in zip(ys, ss) if y == 0]
    if not pos or not neg:
        return None
    tot = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return round(tot / (len(pos) * len(neg)), 4)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 20)), min_size=2, max_size=60))
def test_auc_matches_brute_force(spark, pairs):
    ys = [y for y, _ in pairs]
    ss = [s / 20.0 for _, s in pairs]
    df = spark.createDataFrame(list(zip(ys, ss)), "y int, s double")
    want = _brute_auc(ys, ss)
    got = mx.roc_auc(df, "y", "s").first()
    if want is None:
        assert got is None or got["auc"] is None
    else:
        assert got["auc"] == want


def test_report_equals_separate_metrics(spark):
    df = C.rule_scored(spark, SF_SMALL)
    rep = mx.classification_report(df, "delayed", "rule_score", "rule_pred").first()
    cm = mx.binary_metrics(df, "delayed", "rule_pred").first()
    auc = mx.roc_auc(df, "delayed", "rule_score").first()
    for k in ("tp", "fp", "fn", "tn", "accuracy", "precision", "recall", "f1"):
        assert rep[k] == cm[k]
    assert rep["auc"] == auc["auc"]


def test_zero_division_metrics(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    r = mx.binary_metrics(df, "y", "p").first()
    assert (r["precision"], r["recall"], r["f1"], r["accuracy"]) == (0.0, 0.0, 0.0, 1.0)


def test_reference_sample_exact_size(spark):
    f = C.q_engineer_features(spark, SF_SMALL)
    n = f.count()
    assert sx.reference_sample(f, "flight_id", 100).count() == 100
    assert sx.reference_sample(f, "flight_id", n + 10).count() == n


def test_reference_sample_equals_full_sort(spark):
    f = C.q_engineer_features(spark, SF_SMALL).select("flight_id", "dep_hour")
    n = f.count()
    full = [r["flight_id"] for r in
            f.withColumn("_h", sx.row_hash("flight_id", 7)).orderBy("_h", "flight_id").collect()]
    for k in (1, 2, 3, 17, 100, n // 2, n - 1, n):
        got = [r["flight_id"] for r in
               sx.reference_sample(f, "flight_id", k, seed=7)
                 .withColumn("_h", sx.row_hash("flight_id", 7)).orderBy("_h", "flight_id").collect()]
        assert got == full[:k], k


def test_behaviour_summary_equals_per_flight_pairs(spark):
    import random
    from tarmac.operators import train as trx
    rnd = random.Random(3)
    rows = []
    for fid in range(200):
        for slot in (8, 19):
            p = rnd.random()
            rows.append((fid, slot, p, 1 - p + (1e-9 if fid == 7 else 0.0), int(p >= 0.5)))
    scored = spark.createDataFrame(rows, "flight_id long, slot int, p_delayed double, "
                                         "p_on_time double, prediction int")
    got = trx.behaviour_summary(scored, "slot", morning=8, evening=19).first().asDict()
    # brute force: pair the two copies of each flight first
    pairs = {}
    for fid, slot, p, q, c in rows:
        pairs.setdefault(fid, {})[slot] = (p, q, c)
    morning = [v[8][0] for v in pairs.values()]
    evening = [v[19][0] for v in pairs.values()]
    assert got["pairs"] == len(pairs)
    assert got["min_pred"] == min(r[4] for r in rows) and got["max_pred"] == max(r[4] for r in rows)
    assert got["min_p"] == min(r[2] for r in rows) and got["max_p"] == max(r[2] for r in rows)
    assert math.isclose(got["max_sum_error"], max(abs(r[2] + r[3] - 1) for r in rows), abs_tol=1e-15)
    assert math.isclose(got["mean_p_morning"], sum(morning) / len(morning), rel_tol=1e-12)
    assert math.isclose(got["mean_p_evening"], sum(evening) / len(evening), rel_tol=1e-12)
    assert got["evening_not_lower"] == (got["mean_p_evening"] >= 0.8 * got["mean_p_morning"])
