"""Readers for the given parquet tables and the derived ``flights`` view.

``flights`` is a deterministic, integer-only projection of ``orders``
into the raw flight-row schema (``AIRLINE_CODE`` spelling included, so
the alias rename is exercised). It has one row per order, so it grows
with the data, and contains bad dates, NULL carriers, padded lower-case
carriers, NULL elapsed times and cancelled flights.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# ── fixed values: codes the derivation picks from ─────────────────────
CARRIER_CODES = ["AA", "UA", "DL", "WN", "B6", "AS"]
AIRPORT_CODES = ["ATL", "ORD", "LAX", "DFW", "DEN", "JFK", "SFO", "SEA", "LAS", "MCO",
                 "EWR", "CLT", "PHX", "MIA", "BOS", "BZN", "BNA", "SLC", "PDX", "SAN"]
# ───────────────────────────────────────────────────────────────────────


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _code(codes: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in codes]), (index + 1).cast("int"))


def flights_from_orders(orders: DataFrame) -> DataFrame:
    """Raw flight rows derived from ``orders`` (pure integer arithmetic)."""
    fid = F.col("o_orderkey")
    c = F.col("o_custkey")
    d = F.col("o_orderdate")
    h = ((fid * 7919) % 24).cast("int")
    m = F.month(d)
    base = F.pmod(fid * 31, F.lit(2800))
    evening = F.when(h >= 18, 15).otherwise(0)
    season = F.when(m.isin(6, 7, 11, 12), 8).otherwise(0)
    return orders.select(
        fid.alias("flight_id"),
        F.when(fid % 97 == 0, F.lit("not-a-date"))
         .otherwise(F.date_format(d, "dd-MM-yyyy")).alias("FL_DATE"),
        F.when(fid % 101 == 0, F.lit(None).cast("string"))
         .otherwise(F.when(fid % 89 == 0, F.concat(F.lit(" "), F.lower(_code(CARRIER_CODES, c % 6)), F.lit(" ")))
         .otherwise(_code(CARRIER_CODES, c % 6))).alias("AIRLINE_CODE"),
        _code(AIRPORT_CODES, c % 20).alias("ORIGIN"),
        _code(AIRPORT_CODES, (c + 1 + fid % 19) % 20).alias("DEST"),
        (h * 100 + c % 60).cast("int").alias("CRS_DEP_TIME"),
        (((h + 3) % 24) * 100 + c % 60).cast("int").alias("CRS_ARR_TIME"),
        F.when(fid % 53 == 0, F.lit(None).cast("double"))
         .otherwise((30 + F.floor(base / 8)).cast("double")).alias("CRS_ELAPSED_TIME"),
        (200 + base).cast("double").alias("DISTANCE"),
        F.when(fid % 59 == 0, F.lit(None).cast("double"))
         .otherwise(((fid * 11 + c * 7) % 60 - 20).cast("double")).alias("DEP_DELAY"),
        F.when(fid % 59 == 0, F.lit(None).cast("double"))
         .otherwise(((fid * 17 + c * 13) % 60 - 20 + evening + season).cast("double"))
         .alias("ARR_DELAY"),
    )


def load_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights_from_orders(load_table(spark, sf_dir, "orders"))
