"""running_total equals a plain cumulative sum, including clustered and tied values."""

from hypothesis import given, settings, strategies as st

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.operators import running
from tarmac.operators.running import running_total


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.floats(-5, 5, allow_nan=False), st.integers(1, 9)),
                min_size=1, max_size=80))
def test_running_total_matches_cumsum(spark, rows):
    agg = {}
    for g, v, w in rows:
        agg[(g, v)] = agg.get((g, v), 0) + w
    data = [(g, v, w) for (g, v), w in agg.items()]
    df = spark.createDataFrame(data, "g int, v double, w long")
    got = {(r["g"], r["v"]): (r["cum_w"], r["total_w"])
           for r in running_total(df, ["g"], "v", ["w"], buckets=4).collect()}
    for (g, v), w in agg.items():
        cum = sum(x for (gg, vv), x in agg.items() if gg == g and vv <= v)
        tot = sum(x for (gg, _), x in agg.items() if gg == g)
        assert got[(g, v)] == (cum, tot)


def test_running_total_without_groups(spark):
    df = spark.createDataFrame([(float(i % 7), 1) for i in range(50)], "v double, w long") \
        .groupBy("v").sum("w").withColumnRenamed("sum(w)", "w")
    got = {r["v"]: r["cum_w"] for r in running_total(df, [], "v", ["w"], buckets=3).collect()}
    assert got[6.0] == 50 and got[0.0] == 8


def plain_auc_input(spark, n_groups, hot):
    """A row for each (g, v): small groups of three values, and one hot group."""
    small = spark.range(n_groups * 3).selectExpr("id div 3 + 1 as g", "cast(id % 3 as double) as v", "id % 5 + 1 as w")
    return small.unionByName(spark.range(hot).selectExpr("0L as g", "cast(id * 7919 % 1000003 as double) / 3 as v",
                                                         "id % 3 + 1 as w").groupBy("g", "v").sum("w")
                             .withColumnRenamed("sum(w)", "w"))


def test_many_groups_and_one_of_a_million_values(spark, monkeypatch):
    monkeypatch.setattr(running, "VALUES_PER_RANGE", 50_000)
    df = plain_auc_input(spark, 20_000, 1_000_003)
    got = running_total(df, ["g"], "v", ["w"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    alone = [k for k, line in enumerate(lines) if "Exchange hashpartitioning(g#" in line and "_part" not in line]
    assert len(alone) == 1 and "HashAggregate" in lines[alone[0] + 1]          # the totals, a row for each range
    assert got.count() == 1_000_003 + 60_000
    w = Window.partitionBy("g").orderBy("v")
    want = df.select("g", "v", F.sum("w").over(w).alias("c"), F.sum("w").over(Window.partitionBy("g")).alias("t"))
    diff = got.select("g", "v", F.col("cum_w").alias("c"), F.col("total_w").alias("t"))
    mark = F.expr("bit_xor(xxhash64(g, v, c, t))")
    assert diff.agg(mark).first() == want.agg(mark).first()


def test_null_groups_are_groups(spark):
    df = spark.createDataFrame([(None, 1.0, 2), (None, 2.0, 3), ("a", 1.0, 5)], "g string, v double, w long")
    got = sorted(((r["g"], r["v"], r["cum_w"], r["total_w"]) for r in running_total(df, ["g"], "v", ["w"]).collect()),
                 key=str)
    assert got == [("a", 1.0, 5, 5), (None, 1.0, 2, 5), (None, 2.0, 5, 5)]
