"""Frequency encoding: key → number of rows with that key (missing → 0).

``fit`` runs one scan: the key columns are unpivoted into (feature, key)
pairs and counted with a partial+final hash aggregate, so a hot key is
combined map-side before the shuffle. The count table is written to the
shared checkpoint folder and its size is known before any join.

``transform`` joins each key's counts back with a left join. Which key
tables are broadcast is decided from their row counts, known at fit time:
smallest first, while their running total stays within
``max_broadcast_rows`` — so carriers and airports (hundreds of keys) stay
broadcast even when routes (millions) do not, and all broadcast tables
together never exceed the budget. All keys beyond it share one shuffle join
over their distinct combinations, so the fact side is shuffled at most once;
rows without any of these keys are spread, and AQE splits a skewed combination.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.features import route_key
from tarmac.session import ensure_checkpoint_dir

# output column → key column
ENCODED_KEYS = {
    "carrier_encoded": "OP_CARRIER",
    "origin_encoded": "ORIGIN",
    "dest_encoded": "DEST",
    "route_id_encoded": "route",
}

SPREAD = 1024                 # tasks at most that rows without keys go to
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000   # ≈ 100 MB of (feature, key, n) rows, all keys together


def frequency_counts(df: DataFrame, keys: dict[str, str] = ENCODED_KEYS) -> DataFrame:
    """(feature, key, n) for every non-missing key value — one scan, one small shuffle."""
    if "route" in keys.values() and "route" not in df.columns:
        df = df.withColumn("route", route_key())
    pairs = df.select([F.col(k).cast("string").alias(out) for out, k in keys.items()])
    long = pairs.unpivot([], list(keys), "feature", "key")
    return (long.where(F.col("key").isNotNull())
                .groupBy("feature", "key").agg(F.count(F.lit(1)).alias("n")))


@dataclass
class FrequencyModel:
    counts: DataFrame
    key_counts: dict[str, int]           # encoded column → number of distinct keys
    keys: dict[str, str] = field(default_factory=lambda: dict(ENCODED_KEYS))
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS

    @property
    def n_keys(self) -> int:
        return sum(self.key_counts.values())

    def broadcast_keys(self) -> set[str]:
        """Encoded columns whose tables are broadcast: smallest first, within the row budget."""
        chosen, used = set(), 0
        for name in sorted(self.keys, key=lambda k: (self.key_counts.get(k, 0), k)):
            used += self.key_counts.get(name, 0)
            if used > self.max_broadcast_rows:
                break
            chosen.add(name)
        return chosen

    @property
    def broadcastable(self) -> bool:
        """True when every key table is broadcast."""
        return self.broadcast_keys() == set(self.keys)

    def transform(self, df: DataFrame) -> DataFrame:
        if "route" in self.keys.values() and "route" not in df.columns:
            df = df.withColumn("route", route_key())
        small = self.broadcast_keys()
        large = [name for name in self.keys if name not in small]
        out = df
        for names in ([[n] for n in large] if df.isStreaming else [large] if large else []):
            out = self._joined_once(out, names)
        for name in small:
            side = F.broadcast(self._side(name))
            out = out.join(side, out[self.keys[name]].cast("string") == side[f"_k_{name}"], "left").drop(f"_k_{name}")
        counted = {name: F.coalesce(F.col(f"_n_{name}"), F.lit(0)).cast("long") for name in self.keys}
        return out.withColumns(counted).drop(*[f"_n_{name}" for name in self.keys])

    def _side(self, name: str) -> DataFrame:
        return (self.counts.where(F.col("feature") == name)
                .select(F.col("key").alias(f"_k_{name}"), F.col("n").alias(f"_n_{name}")))

    def _joined_once(self, df: DataFrame, names: list[str]) -> DataFrame:
        """``df`` with the counts of the keys beyond the budget, shuffled once whatever their number:
        each distinct combination of the keys gets all its counts, then the rows are joined
        with their combination. Rows without any of the keys match nothing and are spread by
        their content."""
        of = {name: F.col(self.keys[name]).cast("string") for name in names}
        if len(names) == 1:
            found = self._side(names[0]).withColumnRenamed(f"_k_{names[0]}", f"_c_{names[0]}")
        else:
            found = df.select(*[k.alias(f"_c_{n}") for n, k in of.items()]).where(
                F.coalesce(*[F.col(f"_c_{n}") for n in names]).isNotNull()).distinct()
            for n in names:
                side = self._side(n)
                found = found.join(side, found[f"_c_{n}"] == side[f"_k_{n}"], "left").drop(f"_k_{n}")
        content = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
        spread = F.when(F.coalesce(*of.values()).isNull(), 1 + F.pmod(F.xxhash64(*content), F.lit(SPREAD))).otherwise(0)
        rows = df.withColumns({**{f"_f_{n}": k for n, k in of.items()}, "_spread": spread})
        same = reduce(lambda a, b: a & b, [F.col(f"_f_{n}").eqNullSafe(F.col(f"_c_{n}")) for n in names],
                      F.col("_spread") == F.col("_at"))
        # always 0, but no constant to the optimizer: as one it would be no key of the join
        none = F.length(F.coalesce(*[F.col(f"_c_{n}") for n in names])) * 0
        return (rows.join(found.withColumn("_at", none.cast("long")), same, "left")
                .drop("_spread", "_at", *[f"_f_{n}" for n in names], *[f"_c_{n}" for n in names]))

    def save(self, path: str) -> None:
        self.counts.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str, **kw) -> "FrequencyModel":
        counts = spark.read.parquet(path)
        return cls(counts=counts, key_counts=_key_counts(counts), **kw)


def _key_counts(counts: DataFrame) -> dict[str, int]:
    """Distinct keys per encoded column (one row per column reaches the driver)."""
    rows = counts.groupBy("feature").agg(F.count(F.lit(1)).alias("k")).collect()
    return {r["feature"]: int(r["k"]) for r in rows}


def fit_frequencies(df: DataFrame, keys: dict[str, str] = ENCODED_KEYS,
                    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> FrequencyModel:
    """Count keys on ``df`` and materialise the table in the checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    counts = frequency_counts(df, keys).checkpoint(eager=True)
    return FrequencyModel(counts=counts, key_counts=_key_counts(counts), keys=dict(keys),
                          max_broadcast_rows=max_broadcast_rows)
