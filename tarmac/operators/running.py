"""Exact running totals over sorted distinct values, dealt by ranges of (group, value).

A running sum over a sorted column is a window with ``orderBy`` — but a window partitioned
only by a feature or segment puts every distinct value of that group into one task. Here
Spark deals the rows by ranges of (group, value), whatever the number and sizes of the
groups: a large group lies in several ranges, a range holds many small groups. Then

* the totals of each (range, group) → the sum of a group's earlier ranges (a window over
  one row per range that the group lies in);
* inside each (range, group) → running sum ordered by value.

No sketch of a group and nothing that grows with the groups leaves the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.session import ensure_checkpoint_dir

VALUES_PER_RANGE = 200_000       # distinct values that one window task should sort


def running_total(df: DataFrame, by: list[str], order: str, weights: list[str],
                  buckets: int | None = None) -> DataFrame:
    """For one row per (by…, order) value, add ``cum_<w>`` (inclusive running sum of
    each weight along ``order``) and ``total_<w>`` (group total). Null groups are groups.
    ``buckets`` is the number of ranges."""
    # the input is an aggregate (one row per distinct value): written once to the shared
    # checkpoint folder, as the sampling of the ranges and their dealing both read it. The
    # dealt rows are written too: the totals and the windows must see the same ranges.
    ensure_checkpoint_dir(df.sparkSession)
    cols = df.columns
    df = df.checkpoint(eager=True)
    n = buckets or max(-(-df.count() // VALUES_PER_RANGE), 1)
    x = (df.repartitionByRange(n, *by, order).withColumn("_part", F.spark_partition_id())
         .checkpoint(eager=True))
    tot = x.groupBy("_part", *by).agg(*[F.sum(w).alias(f"_bt_{w}") for w in weights])
    group = Window.partitionBy(*by)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select(
        F.col("_part").alias("_p"), *[F.col(c).alias(f"_by_{c}") for c in by],
        *[F.coalesce(F.sum(f"_bt_{w}").over(before), F.lit(0)).alias(f"_off_{w}") for w in weights],
        *[F.sum(f"_bt_{w}").over(group).alias(f"total_{w}") for w in weights])
    inside = Window.partitionBy("_part", *by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumns({f"_in_{w}": F.sum(w).over(inside) for w in weights})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by],
                  F.col("_part") == F.col("_p"))
    return x.join(tot, same).select(
        *cols, *[(F.col(f"_off_{w}") + F.col(f"_in_{w}")).alias(f"cum_{w}") for w in weights],
        *[F.col(f"total_{w}") for w in weights])
