"""Data-quality rules as one fused aggregate, plus row-level request checks.

``quality_report`` evaluates every table-level rule with a single
``agg`` job (all rules share one scan) and the duplicate fraction over row
fingerprints; the result is one row per rule.
``validate_raw_data`` raises on the first failing rule, in rule order.
``request_errors`` tags each row with the names of the checks it fails,
so a frame splits into valid rows and a quarantine without a second scan.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.functions.features import canonical_code
from tarmac.schema import (DEP_TIME_MAX, DEP_TIME_MIN, MIN_ROWS, NOT_ALL_NULL_COLS,
                           RAW_REQUIRED_COLS, REQUEST_COLS)
from tarmac.session import ensure_checkpoint_dir
from tarmac.sources.csv_landing import normalize_columns

# ── fixed values: data-test thresholds ────────────────────────────────
DELAY_RATE_RANGE = (0.05, 0.60)
MIN_CARRIERS, MIN_ORIGINS, MIN_DATES = 3, 10, 2
MIN_DEP_TIME_STD = 100.0
MIN_ROWS_STRICT = 1000
MAX_DUP_FRACTION = 0.05
# ───────────────────────────────────────────────────────────────────────

REPORT_COLS = ["rule", "observed", "passed"]


DUP_BROADCAST_FINGERPRINTS = 1_000_000   # repeated fingerprints sent to every task, ≈ 8 MB

_ATOMIC = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType,
           T.TimestampNTZType, T.BinaryType)


def _fingerprint_col(f: T.StructField) -> Column:
    c = F.col(f.name)
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return F.when(c == 0, F.lit(0.0).cast(f.dataType)).otherwise(c)   # −0.0 groups with 0.0
    return c


def duplicate_stats(df: DataFrame, cols: list[str] | None = None,
                    max_broadcast: int = DUP_BROADCAST_FINGERPRINTS) -> DataFrame:
    """(n_rows, n_distinct, dup_rows, dup_fraction) — exact; NULLs compare equal, as in groupBy.

    Pass 1 shuffles a 64-bit fingerprint per row instead of the row: a
    fingerprint seen once proves its row has no copy. Fingerprints seen
    more than once (true copies or a collision) are kept in the shared
    checkpoint folder; pass 2 selects their rows with a semi-join and groups
    only those rows on all columns, so a row copied a third of the table is
    combined map-side. Up to ``max_broadcast`` repeated fingerprints are
    broadcast to the rows; beyond that the semi-join shuffles (a hot
    fingerprint's partition is split by AQE).
    """
    cols = cols or df.columns
    fields = [df.schema[c] for c in cols]

    def one_pass(frame: DataFrame) -> DataFrame:
        groups = frame.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        return groups.agg(F.sum("_n").cast("long").alias("n_rows"),
                          F.count(F.lit(1)).cast("long").alias("n_distinct"))

    def finish(counts: DataFrame) -> DataFrame:
        return (counts.withColumn("dup_rows", F.col("n_rows") - F.col("n_distinct"))
                      .withColumn("dup_fraction", F.bround(
                          F.coalesce(F.try_divide("dup_rows", "n_rows"), F.lit(0.0)), 6)))

    if not all(isinstance(f.dataType, _ATOMIC) for f in fields):
        return finish(one_pass(df))
    ensure_checkpoint_dir(df.sparkSession)
    fp = F.xxhash64(*[_fingerprint_col(f) for f in fields])
    per_fp = df.select(fp.alias("_fp")).groupBy("_fp").agg(F.count(F.lit(1)).alias("_n"))
    # fingerprints seen once collapse into one NULL-keyed row per partition before the shuffle
    rep = (per_fp.groupBy(F.when(F.col("_n") > 1, F.col("_fp")).alias("_fp"))
                 .agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_k"))
                 .checkpoint(eager=True))
    t = rep.agg(F.sum("_n").alias("rows"),
                F.sum(F.when(F.col("_fp").isNull(), F.col("_k"))).alias("singles"),
                F.count("_fp").alias("repeated")).first()
    n_rows, singles, repeated = int(t["rows"] or 0), int(t["singles"] or 0), int(t["repeated"] or 0)
    spark = df.sparkSession
    if repeated == 0:
        return finish(spark.range(1).select(F.lit(n_rows).cast("long").alias("n_rows"),
                                            F.lit(singles).cast("long").alias("n_distinct")))
    keys = rep.where(F.col("_fp").isNotNull()).select("_fp")
    if repeated <= max_broadcast:
        keys = F.broadcast(keys)
    copies = df.join(keys, fp == keys["_fp"], "left_semi")
    d = one_pass(copies)
    return finish(d.select(F.lit(n_rows).cast("long").alias("n_rows"),
                           (F.lit(singles) + F.col("n_distinct")).cast("long").alias("n_distinct")))


def _rules(type_errors: Column) -> dict[str, tuple[Column, Callable[[Column], Column], Column]]:
    """rule → (aggregate, test of it, what is reported of it), in rule order."""
    n, dep, c = F.count(F.lit(1)), F.col("CRS_DEP_TIME"), F.col
    label = F.when(c("ARR_DELAY").isNotNull(), (c("ARR_DELAY") >= 15).cast("double"))
    lo, hi = DELAY_RATE_RANGE

    def errors(name: str) -> Column:
        return F.sum(F.array_contains(type_errors, name).cast("int"))

    def known(test, missing: bool = False):
        return lambda v: F.coalesce(test(v), F.lit(missing))

    def as_is(v):
        return v

    def round4(v):
        return F.bround(v, 4)

    return {
        "required_columns": (F.lit(0), lambda v: F.lit(True), as_is),
        "min_rows": (n, lambda v: v >= MIN_ROWS, as_is),
        **{f"not_all_null_{x}": (F.count(x), lambda v: v > 0, as_is) for x in NOT_ALL_NULL_COLS},
        "dep_time_min": (F.min(dep), known(lambda v: v >= DEP_TIME_MIN, True), as_is),
        "dep_time_max": (F.max(dep), known(lambda v: v <= DEP_TIME_MAX, True), as_is),
        "numeric_CRS_DEP_TIME": (errors("CRS_DEP_TIME"), lambda v: v == 0, as_is),
        "numeric_DISTANCE": (errors("DISTANCE"), lambda v: v == 0, as_is),
        "distance_positive": (F.min("DISTANCE"), known(lambda v: v > 0), as_is),
        "elapsed_positive": (F.min("CRS_ELAPSED_TIME"), known(lambda v: v > 0), as_is),
        "carrier_min_length": (F.min(F.length("OP_CARRIER")), known(lambda v: v >= 2), as_is),
        "delay_rate_range": (F.avg(label), known(lambda v: v.between(lo, hi)), round4),
        # counted apart, see distinct_counts
        "min_carriers": (None, lambda v: v >= MIN_CARRIERS, as_is),
        "min_origins": (None, lambda v: v >= MIN_ORIGINS, as_is),
        "min_dates": (None, lambda v: v >= MIN_DATES, as_is),
        "dep_time_std": (F.stddev_samp(dep), known(lambda v: v > MIN_DEP_TIME_STD), round4),
        "min_rows_strict": (n, lambda v: v >= MIN_ROWS_STRICT, as_is),
    }


DISTINCT_RULES = {"min_carriers": "OP_CARRIER", "min_origins": "ORIGIN", "min_dates": "FL_DATE"}


def distinct_counts(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """One row: for each name, the exact number of distinct non-missing values of its column. Values
    are combined per (name, value) in the map tasks, so a row is never shuffled and what is
    shuffled follows the number of distinct values."""
    pairs = df.select(F.inline(F.array(*[F.struct(F.lit(n).alias("of"), F.col(c).cast("string").alias("value"))
                                         for n, c in cols.items()])))
    each = pairs.where("value is not null").distinct()
    return each.agg(*[F.count_if(F.col("of") == n).alias(n) for n in cols])


def quality_report(df: DataFrame, include_duplicates: bool = True,
                   rules: list[str] | None = None) -> DataFrame:
    """One row per rule: (rule, observed, passed). Runs as one aggregate over the whole frame and
    one of its distinct values; with ``rules`` only the aggregates of those rules are built."""
    df = normalize_columns(df)
    missing = [c for c in RAW_REQUIRED_COLS if c not in df.columns]
    if missing:   # V1 needs no job; nothing else can be evaluated
        return df.sparkSession.createDataFrame(
            [("required_columns", float(len(missing)), False)],
            "rule string, observed double, passed boolean")
    errors = (F.col("_type_errors") if "_type_errors" in df.columns
              else F.array().cast("array<string>"))
    wanted = {k: v for k, v in _rules(errors).items() if rules is None or k in rules}
    aggs = [agg.alias(name) for name, (agg, _, _) in wanted.items() if agg is not None]
    apart = {k: c for k, c in DISTINCT_RULES.items() if k in wanted}

    def told(one: DataFrame) -> DataFrame:
        return one.select(F.inline(F.array(*[F.struct(
            F.lit(name).alias("rule"), shown(F.col(name)).cast("double").alias("observed"),
            test(F.col(name)).alias("passed")) for name, (_, test, shown) in wanted.items() if name in one.columns])))

    parts = ([told(df.agg(*aggs))] if aggs else []) + ([told(distinct_counts(df, apart))] if apart else [])
    report = reduce(DataFrame.unionByName, parts)
    if include_duplicates:
        cols = [x for x in df.columns if x not in ("_type_errors", "source_file")]
        report = report.unionByName(duplicate_stats(df, cols).select(
            F.lit("duplicate_fraction").alias("rule"), F.col("dup_fraction").alias("observed"),
            (F.col("dup_fraction") < MAX_DUP_FRACTION).alias("passed")))
    return report


# rules the training job enforces (the rest are reported only)
BLOCKING_RULES = ["required_columns", "min_rows",
                  *[f"not_all_null_{x}" for x in NOT_ALL_NULL_COLS],
                  "dep_time_min", "dep_time_max"]


def validate_raw_data(df: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """Raise ValueError on the first failing blocking rule; return the report otherwise."""
    rules = rules or BLOCKING_RULES
    report = quality_report(df, include_duplicates=False, rules=rules)
    rows = {r["rule"]: r for r in report.collect()}   # ≤ 20 rows
    for name in rules:
        r = rows.get(name)
        if r is not None and not r["passed"]:
            raise ValueError(f"data-quality rule failed: {name} (observed={r['observed']})")
    return report


def split_unusable(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, quarantine): a flight with neither an elapsed time nor a distance has no
    elapsed-time feature and can't be trained on."""
    unusable = F.col("CRS_ELAPSED_TIME").isNull() & F.col("DISTANCE").isNull()
    return df.where(~unusable), df.where(unusable)


def request_errors(df: DataFrame) -> Column:
    """Array of failed request checks for each row (empty = valid)."""
    c = F.col
    checks = [F.when(c(x).isNull(), F.lit(f"missing_{x}")) for x in REQUEST_COLS]
    for x in ("CRS_DEP_TIME", "CRS_ARR_TIME"):
        checks.append(F.when(~c(x).between(DEP_TIME_MIN, DEP_TIME_MAX), F.lit(f"range_{x}")))
    checks += [
        F.when(c("CRS_ELAPSED_TIME") <= 0, F.lit("nonpositive_CRS_ELAPSED_TIME")),
        F.when(c("DISTANCE") <= 0, F.lit("nonpositive_DISTANCE")),
        F.when(F.length(canonical_code("OP_CARRIER")) == 0, F.lit("empty_OP_CARRIER")),
        *[F.when(~F.length(canonical_code(x)).between(2, 4), F.lit(f"code_length_{x}"))
          for x in ("ORIGIN", "DEST")],
    ]
    return F.array_compact(F.array(*checks))


def split_requests(df: DataFrame, canonicalise: bool = True) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine). Valid rows get canonical codes; quarantine keeps ``errors``."""
    df = normalize_columns(df)
    tagged = df.withColumn("errors", request_errors(df))
    valid = tagged.where(F.size("errors") == 0).drop("errors")
    if canonicalise:
        valid = valid.withColumns({x: canonical_code(x) for x in ("OP_CARRIER", "ORIGIN", "DEST")})
    return valid, tagged.where(F.size("errors") > 0)
