"""Monitoring of captured traffic: daily statistics, drift violations, alarm.

Captured rows are unpivoted to (captured_at, feature, value, text) and
aggregated per (1-day tumbling window, feature) — partial aggregation,
so a hot day costs one combine per partition. The baseline holds one
row per feature and is broadcast. The drift rule is the standardised
mean shift ``|μ_day − μ_0| / σ_0``; missing-value and data-type checks
compare null fractions and unparsable counts; the baseline's constraints
(completeness, sign, range, whole numbers) are checked as well, and its
equi-depth bins: each value is compared with its feature's edges, in
generated code, and the population stability index follows from the
bins' counts.

Statistics and bin counts are kept as additive parts per (day, feature)
(``partial_stats``), so days are made of any number of batches.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.tiers import round4
from tarmac.operators.profile import cumulative_counts, quantile

# ── fixed values: monitoring thresholds (our choice; parameters) ──────
DRIFT_Z = 0.1
MISSING_TOLERANCE = 0.05
BASELINE_DAYS = 7
# ───────────────────────────────────────────────────────────────────────

STAT_COLS = ["day", "feature", "n", "nulls", "type_errors", "mean", "std", "min", "max"]


def utc_instant(wall_clock) -> Column:
    """UTC wall-clock (TIMESTAMP_NTZ) → the instant (TIMESTAMP), whatever the session zone."""
    c = F.col(wall_clock) if isinstance(wall_clock, str) else wall_clock
    return F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp")


def utc_wall(instant) -> Column:
    """Instant (TIMESTAMP) → its UTC wall clock (TIMESTAMP_NTZ)."""
    c = F.col(instant) if isinstance(instant, str) else instant
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), c.cast("timestamp_ntz"))


def utc_day(instant) -> Column:
    return F.to_date(utc_wall(instant))


def capture_from_events(events: DataFrame) -> DataFrame:
    """Captured traffic from ``events``: numeric request fields plus their raw text."""
    k_text = F.get_json_object("props", "$.k")
    return events.select(
        F.col("event_id"), utc_instant("ts").alias("captured_at"),
        F.struct(F.col("value").cast("double").alias("value"),
                 F.col("value").cast("string").alias("text")).alias("value"),
        F.struct(k_text.try_cast("double").alias("value"), k_text.alias("text")).alias("k"),
        F.struct(F.col("user_id").cast("double").alias("value"),
                 F.col("user_id").cast("string").alias("text")).alias("user_id"),
    )


def long_features(wide: DataFrame, features: list[str], at: str) -> DataFrame:
    """(captured_at, day, feature, value, text, wrong) of typed feature columns; ``wrong``: there is
    a text but no value. The columns are unpivoted side by side, so those that a reader leaves
    out are not computed: no text is made where only its presence counts."""
    x = {c: (F.col(c).cast("double"), F.col(c)) for c in features}
    side = wide.select(F.col(at).alias("captured_at"), utc_day(at).alias("day"),
                       *[v.alias(f"_v{i}") for i, (v, _) in enumerate(x.values())],
                       *[c.cast("string").alias(f"_t{i}") for i, (_, c) in enumerate(x.values())],
                       *[(c.isNotNull() & v.isNull()).alias(f"_w{i}") for i, (v, c) in enumerate(x.values())])
    names = ", ".join(f"(_v{i}, _t{i}, _w{i}) AS `{c}`" for i, c in enumerate(features))
    return wide.sparkSession.sql(
        "SELECT captured_at, day, feature, value, text, wrong FROM {side} "
        f"UNPIVOT INCLUDE NULLS ((value, text, wrong) FOR feature IN ({names}))", side=side)


def long_capture(capture: DataFrame, features: list[str]) -> DataFrame:
    """(captured_at, feature, value, text)."""
    long = capture.select("captured_at", *features).unpivot(["captured_at"], features, "feature", "f")
    return long.select("captured_at", "feature", F.col("f.value").alias("value"),
                       F.col("f.text").alias("text"))


def _stat_aggs() -> list[Column]:
    v, t = F.col("value"), F.col("text")
    return [F.count(F.lit(1)).alias("n"),
            F.sum(v.isNull().cast("long")).alias("nulls"),
            F.sum((t.isNotNull() & v.isNull()).cast("long")).alias("type_errors"),
            F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
            F.min(v).alias("min"), F.max(v).alias("max")]


def daily_stats(long: DataFrame) -> DataFrame:
    """Per (day, feature) statistics over a 1-day tumbling window (batch or stream)."""
    g = long.groupBy(F.window("captured_at", "1 day").alias("w"), "feature").agg(*_stat_aggs())
    return g.select(utc_day(F.col("w.start")).alias("day"), *STAT_COLS[1:])


def bin_of(value: Column, edges: Column, n_edges: int) -> Column:
    """How many of up to ``n_edges`` ascending edges lie below the value."""
    # plain comparisons compile to code, a lambda over the edges is interpreted for each value
    below = [F.coalesce(F.get(edges, F.lit(k)) < value, F.lit(False)).cast("int") for k in range(n_edges)]
    return F.when(value.isNotNull(), reduce(lambda a, b: a + b, below, F.lit(0)))


def bin_counts(n_edges: int, bin_col: str = "bin", weight: str | None = None) -> Column:
    """Array of the rows in each bin (an aggregate); ``weight`` names the rows that a row stands for."""
    if weight is not None:
        return F.array(*[F.sum(F.when(F.col(bin_col) == k, F.col(weight)).otherwise(0)) for k in range(n_edges + 1)])
    return F.array(*[F.count_if(F.col(bin_col) == k) for k in range(n_edges + 1)])


def placed(long: DataFrame, edges: DataFrame, n_edges: int) -> DataFrame:
    """``long`` with the ``bin`` of each value. ``edges`` has a row per feature."""
    rows = long.join(F.broadcast(edges.select("feature", "edges")), "feature", "left")
    return rows.withColumn("bin", bin_of(F.col("value"), F.col("edges"), n_edges)).drop("edges")


def psi_of(counts: Column, expected: Column, floor: float) -> Column:
    """Population stability index of two arrays of bin counts; null without rows."""
    def shares(c: Column) -> Column:
        total = F.aggregate(c, F.lit(0).cast("long"), lambda t, x: t + x)
        return F.transform(c, lambda x: F.greatest(F.try_divide(x.cast("double"), total), F.lit(floor)))
    terms = F.zip_with(shares(counts), shares(expected), lambda a, e: (a - e) * F.log(a / e))
    some = F.exists(counts, lambda x: x > 0) & F.exists(expected, lambda x: x > 0)
    return F.when(some, F.aggregate(terms, F.lit(0.0), lambda t, x: t + x))


def partial_stats(long: DataFrame, bins: DataFrame | None = None, n_edges: int | None = None) -> DataFrame:
    """Per (day, feature) additive parts: n, nulls, type_errors, fractions (values that are no whole
    numbers), k values with their mean and centred square sum, least and greatest; with
    ``bins`` (feature, edges) also the rows in each bin. ``long`` is that of ``long_features``
    or ``long_capture``; rows captured at no time have no day and don't count."""
    v, by = F.col("value"), ["day", "feature"]
    day = F.col("day") if "day" in long.columns else utc_day("captured_at")
    wrong = F.col("wrong") if "wrong" in long.columns else F.col("text").isNotNull() & v.isNull()
    rows = long.select(day.alias("day"), "feature", "value", wrong.alias("wrong")).where(F.col("day").isNotNull())
    # statistics by bin first: with a count for each bin beside them, the aggregate of the many
    # rows would be a method too long to be compiled
    parts = (rows if bins is None else placed(rows, bins, n_edges)).groupBy(*by, *([] if bins is None else ["bin"])).agg(
        F.count(F.lit(1)).alias("n"), F.sum(v.isNull().cast("long")).alias("nulls"),
        F.sum(F.col("wrong").cast("long")).alias("type_errors"),
        F.coalesce(F.sum((v != F.floor(v)).cast("long")), F.lit(0).cast("long")).alias("fractions"),
        F.count(v).alias("k"), F.avg(v).alias("m"), (F.var_pop(v) * F.count(v)).alias("q"),
        F.min(v).alias("min"), F.max(v).alias("max"))
    if bins is None:
        return parts
    return _with_mean(parts).groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("n", "nulls", "type_errors", "fractions", "k")], F.max("_mean").alias("m"),
        _centred().alias("q"), F.min("min").alias("min"), F.max("max").alias("max"),
        bin_counts(n_edges, weight="k").alias("bins"))


def _with_mean(parts: DataFrame) -> DataFrame:
    """Partial rows with the mean of all values of their (day, feature)."""
    w = Window.partitionBy("day", "feature")
    return parts.withColumn("_mean", F.try_divide(F.sum(F.col("k") * F.col("m")).over(w), F.sum("k").over(w)))


def _centred() -> Column:
    """Square sum around ``_mean`` of all partial rows (an aggregate)."""
    d = F.col("m") - F.col("_mean")
    return F.sum(F.col("q") + F.col("k") * d * d)


def merged_stats(parts: DataFrame) -> DataFrame:
    """The statistics of ``daily_stats``, ``fractions`` and the bin counts, where the parts have them,
    from any number of partial rows per (day, feature)."""
    more = [F.sum("fractions").alias("fractions")]
    if "bins" in parts.columns:
        size = parts.select(F.max(F.size("bins"))).first()[0] or 0
        more.append(F.array(*[F.sum(F.col("bins")[k]) for k in range(size)]).cast("array<bigint>").alias("bins"))
    g = _with_mean(parts).groupBy("day", "feature").agg(
        F.sum("n").alias("n"), F.sum("nulls").alias("nulls"), F.sum("type_errors").alias("type_errors"),
        F.max("_mean").alias("mean"), F.sum("k").alias("_k"),
        _centred().alias("_q"), F.min("min").alias("min"), F.max("max").alias("max"), *more)
    return (g.withColumn("std", F.when(F.col("_k") > 1, F.sqrt(F.col("_q") / (F.col("_k") - 1))))
            .select(*STAT_COLS, "fractions", *(["bins"] if len(more) > 1 else [])))


def baseline_stats(long: DataFrame) -> DataFrame:
    """One row per feature: mean0, std0, null_frac0."""
    return long.groupBy("feature").agg(
        F.avg("value").alias("mean0"), F.stddev_samp("value").alias("std0"),
        F.avg(F.col("value").isNull().cast("double")).alias("null_frac0"))


def baseline_of_profile(statistics: DataFrame) -> DataFrame:
    """Baseline rows from a stored feature profile (feature, mean, std, null_pct)."""
    return statistics.select("feature", F.col("mean").alias("mean0"), F.col("std").alias("std0"),
                             F.col("null_pct").alias("null_frac0"))


def _check(name: str, bad: Column, observed: Column, baseline: Column) -> Column:
    return F.struct(F.lit(name).alias("check"), F.coalesce(bad, F.lit(False)).alias("failed"),
                    observed.cast("double").alias("observed"), baseline.cast("double").alias("baseline"))


def checks(stats: DataFrame, baseline: DataFrame, constraints: DataFrame | None = None,
           drift_z: float = DRIFT_Z, missing_tol: float = MISSING_TOLERANCE,
           bins: DataFrame | None = None) -> DataFrame:
    """(day, feature, check, failed, observed, baseline): every check of every monitored day.

    A feature that never varied in the baseline (σ0 zero or unknown) drifts as soon as its
    mean moves. A baseline feature without rows on a monitored day fails ``missing_feature``,
    one that the baseline doesn't know ``unexpected_feature``. ``constraints`` (feature,
    completeness, non_negative, min, max; integral, where it has it) add their own checks, and
    ``bins`` (feature, counts of the baseline's rows) the stability index of ``stats`` with
    ``bins``. All sides but ``stats`` hold one row per feature.
    """
    side = baseline
    typed = constraints is not None and "integral" in constraints.columns and "fractions" in stats.columns
    shaped = bins is not None and "bins" in stats.columns
    if constraints is not None:
        side = side.join(constraints.select("feature", "completeness", "non_negative", F.col("min").alias("min0"),
                                            F.col("max").alias("max0"), *(["integral"] if typed else [])),
                         "feature", "full_outer")
    if shaped:
        side = side.join(bins.select("feature", F.col("counts").alias("counts0")), "feature", "left")
    j = stats.join(F.broadcast(side.withColumn("_known", F.lit(True))), "feature", "left")   # a row a feature
    null_frac = F.try_divide("nulls", "n")
    shift = F.abs(F.col("mean") - F.col("mean0"))
    z = F.when(F.coalesce("std0", F.lit(0.0)) == 0, F.when(shift > 0, F.lit(float("inf"))).otherwise(0.0)) \
         .otherwise(F.try_divide(shift, F.col("std0")))
    all_checks = [
        _check("baseline_drift", z > drift_z, round4("mean"), round4("mean0")),
        _check("missing_values", null_frac > F.col("null_frac0") + missing_tol,
               round4(null_frac), round4("null_frac0")),
        _check("data_type_errors", F.col("type_errors") > 0, F.col("type_errors"), F.lit(0.0)),
        _check("unexpected_feature", F.col("_known").isNull(), F.col("n"), F.lit(0.0)),
    ]
    if constraints is not None:
        all_checks += [
            _check("completeness", 1 - null_frac < F.col("completeness") - missing_tol,
                   round4(1 - null_frac), F.col("completeness")),
            _check("non_negative", F.col("non_negative") & (F.col("min") < 0), F.col("min"), F.lit(0.0)),
            _check("range_min", F.col("min") < F.col("min0"), round4("min"), round4("min0")),
            _check("range_max", F.col("max") > F.col("max0"), round4("max"), round4("max0")),
        ]
    if typed:
        all_checks.append(_check("data_type", F.col("integral") & (F.col("fractions") > 0), F.col("fractions"), F.lit(0.0)))
    if shaped:
        psi = round4(psi_of(F.col("bins"), F.col("counts0"), PSI_FLOOR))
        all_checks.append(_check("psi", psi > PSI_THRESHOLD, psi, F.lit(PSI_THRESHOLD)))
    seen = j.select("day", "feature", F.inline(F.array(*all_checks)))
    names = F.array(*[F.lit(r["feature"]) for r in side.select("feature").collect()]).cast("array<string>")
    gone = (stats.groupBy("day").agg(F.collect_set("feature").alias("_f"))
            .select("day", F.explode(F.array_except(names, "_f")).alias("feature"))
            .select("day", "feature", F.lit("missing_feature").alias("check"), F.lit(True).alias("failed"),
                    F.lit(0.0).alias("observed"), F.lit(1.0).alias("baseline")))
    return seen.unionByName(gone)


def violations(stats: DataFrame, baseline: DataFrame, constraints: DataFrame | None = None,
               drift_z: float = DRIFT_Z, missing_tol: float = MISSING_TOLERANCE) -> DataFrame:
    """(day, feature, check, observed, baseline) for every failed check."""
    return checks(stats, baseline, constraints, drift_z, missing_tol).where("failed").drop("failed")


def alarm_of_checks(all_checks: DataFrame) -> DataFrame:
    """Per monitored day: features whose mean or shape moved, counted once for each; alarm when ≥ 1."""
    bad = F.col("check").isin("baseline_drift", "psi") & F.col("failed")
    moved = F.size(F.collect_set(F.when(bad, F.col("feature")))).cast("long")         # as many as features at most
    return (all_checks.groupBy("day").agg(moved.alias("drift_count"))
            .withColumn("alarm", F.col("drift_count") >= 1))


def drift_alarm(stats: DataFrame, baseline: DataFrame) -> DataFrame:
    """Days without traffic have no row."""
    return alarm_of_checks(checks(stats, baseline))


def split_reference_window(capture: DataFrame, days: int = BASELINE_DAYS):
    """(reference, monitored): the first ``days`` days of capture and the rest."""
    # found once, here: as a subquery it would scan the capture again wherever it is used
    start = capture.select(F.min(utc_wall("captured_at"))).first()[0]
    cut = (F.date_trunc("day", F.lit(start).cast("timestamp_ntz")).cast("timestamp_ntz")
           + F.make_interval(days=F.lit(days)))
    wall = utc_wall("captured_at")
    return capture.where(wall < cut), capture.where(wall >= cut)


def served_stats(capture: DataFrame) -> DataFrame:
    return capture.agg(F.count(F.lit(1)).alias("predictions_served"),
                       utc_wall(F.max("captured_at")).alias("last_prediction"))


# ── population stability index on baseline decile bins ───────────────
# fixed values (our choice; parameters)
PSI_PROBS = [i / 10 for i in range(1, 10)]
PSI_THRESHOLD = 0.2
PSI_FLOOR = 1e-4


def baseline_edges(base_long: DataFrame, probs: list[float] = PSI_PROBS) -> DataFrame:
    """(feature, edges): exact inverted-CDF quantiles of the baseline values."""
    return edges_of(cumulative_counts(base_long), probs)


def edges_of(cum: DataFrame, probs: list[float] = PSI_PROBS) -> DataFrame:
    """``baseline_edges`` from ``profile.cumulative_counts``."""
    return cum.groupBy("feature").agg(F.array(*[quantile(p) for p in probs]).alias("edges"))


def _binned(long: DataFrame, edges: DataFrame) -> DataFrame:
    # one row per feature → broadcast
    j = long.where(F.col("value").isNotNull()).join(F.broadcast(edges), "feature")
    b = F.aggregate("edges", F.lit(0), lambda acc, e: acc + (F.col("value") > e).cast("int"))
    return j.withColumn("bin", b)


def daily_psi(base_long: DataFrame, mon_long: DataFrame,
              probs: list[float] = PSI_PROBS, floor: float = PSI_FLOOR) -> DataFrame:
    """(day, feature, psi) of each monitored day against the baseline bins."""
    from tarmac.session import ensure_checkpoint_dir

    # one row per feature, read by both the baseline and the daily binning: materialised
    # once in the shared checkpoint folder instead of being planned (and run) twice
    ensure_checkpoint_dir(base_long.sparkSession)
    edges = baseline_edges(base_long, probs).checkpoint(eager=True)
    expected = (_binned(base_long, edges).groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("c0"))
                .withColumn("e", F.col("c0") / F.sum("c0").over(Window.partitionBy("feature")))
                .select("feature", "bin", "e"))
    actual = (_binned(mon_long, edges)
              .groupBy(F.window("captured_at", "1 day").alias("w"), "feature", "bin")
              .agg(F.count(F.lit(1)).alias("c"))
              .select(utc_day(F.col("w.start")).alias("day"), "feature", "bin", "c"))
    totals = actual.groupBy("day", "feature").agg(F.sum("c").alias("n"))
    grid = totals.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(len(probs)))))
    g = (grid.join(actual, ["day", "feature", "bin"], "left")
             .join(F.broadcast(expected), ["feature", "bin"], "left"))   # ≤ features × bins rows
    a = F.greatest(F.coalesce(F.col("c"), F.lit(0)) / F.col("n"), F.lit(floor))
    e = F.greatest(F.coalesce(F.col("e"), F.lit(0.0)), F.lit(floor))
    term = (a - e) * F.log(a / e)
    return g.groupBy("day", "feature").agg(round4(F.sum(term)).alias("psi"))


def psi_violations(psi: DataFrame, threshold: float = PSI_THRESHOLD) -> DataFrame:
    return psi.where(F.col("psi") > threshold).select(
        "day", "feature", F.lit("psi").alias("check"), F.col("psi").alias("observed"),
        F.lit(threshold).alias("baseline"))
