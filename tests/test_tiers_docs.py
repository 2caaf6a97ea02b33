from tarmac.functions import docs, tiers


def test_risk_and_confidence_boundaries(spark):
    ps = [0.0, 0.2499, 0.25, 0.5499, 0.55, 0.85, 0.15, 0.65, 0.35, 0.5, 1.0]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = {r[0]: (r[1], r[2]) for r in df.select(
        "p", tiers.risk_level("p"), tiers.confidence_level("p")).collect()}
    assert got[0.2499][0] == "LOW" and got[0.25][0] == "MEDIUM"
    assert got[0.5499][0] == "MEDIUM" and got[0.55][0] == "HIGH"
    assert got[0.85][1] == "HIGH" and got[0.15][1] == "HIGH"
    assert got[0.65][1] == "MEDIUM" and got[0.35][1] == "MEDIUM" and got[0.5][1] == "LOW"


def test_tiers_use_rounded_probability(spark):
    df = spark.createDataFrame([(0.24996,)], "p double")
    r = df.select(tiers.round4("p").alias("q")).select("q", tiers.risk_level("q")).first()
    assert r[0] == 0.25 and r[1] == "MEDIUM"


def test_flight_label(spark):
    df = spark.createDataFrame([("JFK", "LAX", "AA")], "ORIGIN string, DEST string, OP_CARRIER string")
    assert df.select(tiers.flight_label()).first()[0] == "JFK-LAX AA"


def test_object_uri(spark):
    df = spark.createDataFrame([("s3://bkt/a/b/c.json",), ("",), ("file:/x",)], "u string")
    b, k = docs.split_object_uri("u")
    assert [tuple(r) for r in df.select(b, k).collect()] == [("bkt", "a/b/c.json"), ("", ""), ("", "")]


def test_json_path(spark):
    df = spark.createDataFrame([('{"metrics": {"challenger_beats_champion": {"value": 1.0}}}',), ("{}",)],
                               "d string")
    got = [r[0] for r in df.select(docs.json_path_double(
        "d", "$.metrics.challenger_beats_champion.value")).collect()]
    assert got == [1.0, None]
