"""Deterministic stratified split and seeded reference sample.

Rows are ordered inside each stratum by ``md5("<seed>|<id>")`` (ties by
id). With stratum size n: the first ``floor(test·n + 0.5)`` rows are
``test``; of the remaining r rows the next ``floor(val/(1−test)·r + 0.5)``
are ``val``; the rest ``train``.

Exact ranks are computed without ever putting a stratum into one task:
the 20 leading hash bits give 2^20 buckets per stratum; a histogram of
(stratum, bucket) counts yields, per stratum, the two buckets that
contain a cut, and only their rows are ranked, inside their bucket, to
find the last row before each cut. The cut table then holds that row's
(hash, id) per stratum and cut, and the split itself is one comparison in
a projection: no window, no union, no second scan of what is split. A
NULL label is a stratum like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.schema import RANDOM_STATE, TARGET_COL, TEST_SIZE, VAL_SIZE
from tarmac.session import ensure_checkpoint_dir

BUCKET_HEX_DIGITS = 5            # 20 bits → 1,048,576 buckets per stratum


def row_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


def _hash_bucket(h: Column) -> Column:
    return F.conv(F.substring(h, 1, BUCKET_HEX_DIGITS), 16, 10).cast("int")


def stratified_split(df: DataFrame, id_col: str, label_col: str = TARGET_COL,
                     test_size: float = TEST_SIZE, val_size: float = VAL_SIZE,
                     seed: int = RANDOM_STATE) -> DataFrame:
    """Add ``split`` ∈ {train, val, test}."""
    cuts = F.broadcast(split_cuts(df, id_col, label_col, test_size, val_size, seed))  # a row a stratum
    at = F.struct(row_hash(id_col, seed).alias("h"), F.col(id_col).alias("id"))
    j = df.join(cuts, F.col(label_col).eqNullSafe(F.col("_stratum")), "left")
    split = (F.when(at <= F.col("_test"), "test").when(at <= F.col("_val"), "val").otherwise("train"))
    return j.withColumn("split", split).drop("_stratum", "_test", "_val")


def split_cuts(df: DataFrame, id_col: str, label_col: str, test_size: float, val_size: float,
               seed: int) -> DataFrame:
    """(_stratum, _test, _val): (hash, id) of the last test row and of the last val row of each
    stratum, NULL if there is none. Written to the checkpoint folder."""
    val_rel = val_size / (1.0 - test_size)
    s = F.col("_stratum")
    keyed = df.select(F.col(label_col).alias("_stratum"), F.col(id_col).alias("id"),
                      row_hash(id_col, seed).alias("h")).withColumn("_b", _hash_bucket(F.col("h")))
    hist = keyed.groupBy("_stratum", "_b").agg(F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy("_stratum").orderBy("_b")
    hist = (hist.withColumn("_hi", F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("_n", F.sum("_cnt").over(Window.partitionBy("_stratum"))))
    t1 = F.floor(F.lit(test_size) * F.col("_n") + 0.5)
    t2 = t1 + F.floor(F.lit(val_rel) * (F.col("_n") - t1) + 0.5)
    ensure_checkpoint_dir(df.sparkSession)
    # the bucket that holds the last row before each cut, and that row's rank in the bucket
    ends = (hist.select("_stratum", "_b", "_hi", (F.col("_hi") - F.col("_cnt")).alias("_lo"),
                        F.explode(F.array(F.struct(F.lit(1).alias("cut"), t1.alias("t")),
                                          F.struct(F.lit(2).alias("cut"), t2.alias("t")))).alias("c"))
            .where((F.col("c.t") > F.col("_lo")) & (F.col("c.t") <= F.col("_hi")))
            .select("_stratum", "_b", "c.cut", (F.col("c.t") - F.col("_lo")).alias("_rank"))
            .checkpoint(eager=True))                               # two rows a stratum
    near = F.broadcast(ends.select(s.alias("_s"), F.col("_b").alias("_cb")).distinct())
    inside = keyed.join(near, s.eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_cb")), "left_semi")
    ranked = inside.withColumn("_r", F.row_number().over(
        Window.partitionBy("_stratum", "_b").orderBy("h", "id")))
    e = F.broadcast(ends.select(s.alias("_s"), F.col("_b").alias("_cb"), "cut", "_rank"))
    last = ranked.join(e, s.eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_cb"))
                       & (F.col("_r") == F.col("_rank")))
    at = F.struct("h", "id")
    return (last.groupBy("_stratum").agg(F.max(F.when(F.col("cut") == 1, at)).alias("_test"),
                                         F.max(F.when(F.col("cut") == 2, at)).alias("_val"))
            .checkpoint(eager=True))


def content_key(df: DataFrame, name: str = "row_key") -> DataFrame:
    """Add a unique text key made of the row's content: the same rows get the same keys in any
    layout. Identical rows are numbered from 1; they are interchangeable, so a hot one is
    numbered by partition: counts per partition give offsets, rows are numbered within."""
    ensure_checkpoint_dir(df.sparkSession)
    cols = sorted(df.columns)
    keyed = df.withColumn("_fp", F.md5(F.to_json(F.struct(*cols)).cast("binary")))
    repeated = (keyed.groupBy("_fp").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_fp")
                .checkpoint(eager=True))
    n = repeated.count()
    if n == 0:
        return keyed.withColumnRenamed("_fp", name)
    side = F.broadcast(repeated) if n <= 1_000_000 else repeated
    single = keyed.join(side, "_fp", "left_anti").withColumnRenamed("_fp", name)
    copies = (keyed.join(side, "_fp", "left_semi").withColumn("_p", F.spark_partition_id())
              .checkpoint(eager=True))
    w = Window.partitionBy("_fp").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    before = (copies.groupBy("_fp", "_p").agg(F.count(F.lit(1)).alias("_c"))
              .select("_fp", "_p", F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_before")))
    number = F.row_number().over(Window.partitionBy("_fp", "_p").orderBy("_fp"))
    counted = copies.withColumn("_k", number).join(before, ["_fp", "_p"])
    counted = counted.withColumn(name, F.concat_ws("-", "_fp", (F.col("_before") + F.col("_k")).cast("string")))
    return single.unionByName(counted.select(*df.columns, name).select(*single.columns))


def split_counts(split_df: DataFrame, label_col: str = TARGET_COL) -> DataFrame:
    """Rows and positive rate per split."""
    return (split_df.groupBy("split")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.sum(F.col(label_col)).cast("long").alias("positives"),
                 F.bround(F.avg(F.col(label_col).cast("double")), 4).alias("positive_rate")))


def reference_sample(df: DataFrame, id_col: str, n: int, seed: int = RANDOM_STATE) -> DataFrame:
    """Exactly min(n, rows) rows, the same ones on every run: the first n by seeded hash.

    Equal to ``orderBy(hash, id).limit(n)``, in two passes over ``df`` and
    with a final top-n merge (one task) that sees about 2n rows, whatever
    the size and partition count of the input.

    The leading 60 hash bits are a uniform integer u. Pass 1 counts rows by
    the bit length of u (at most 61 groups, combined map-side). Rows whose
    bit length is at most m are exactly those with u < 2^m — a complete
    prefix of the hash order. The smallest m whose prefix holds at least n
    rows selects the candidates; the prefix for m − 1 holds fewer than n,
    and u is uniform, so the candidates number about 2n. Pass 2 keeps them
    and takes the top n.
    """
    keyed = df.withColumn("_h", row_hash(id_col, seed))
    lead = F.conv(F.substring("_h", 1, 15), 16, 10).cast("long")     # uniform in [0, 2^60)
    bits = F.when(lead == 0, F.lit(0)).otherwise(F.length(F.bin(lead)))
    hist = sorted((r["_m"], r["_c"]) for r in
                  keyed.groupBy(bits.alias("_m")).agg(F.count(F.lit(1)).alias("_c")).collect())
    if sum(c for _, c in hist) <= n:
        return keyed.drop("_h")
    seen, width = 0, 60
    for m, c in hist:                                                 # ≤ 61 rows
        seen += c
        if seen >= n:
            width = m
            break
    cand = keyed.where(lead < F.lit(1 << width))
    return cand.orderBy("_h", id_col).limit(n).drop("_h")
