"""Per-row feature expressions — plain Column expressions, no UDFs.

Every function returns a Column so Catalyst can fuse the whole feature
projection into one whole-stage-codegen span.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.schema import (DELAY_THRESHOLD_MIN, FALLBACK_KM_PER_MIN, HOLIDAY_MONTHS,
                           HOUR_MAX, HOUR_MIN, TIME_BUCKET_BELOW, WEEKEND_FROM_DOW,
                           HUB_AIRPORTS, MILES_TO_KM)

DATE_FORMATS = ("dd-MM-yyyy", "yyyy-MM-dd")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_flight_date(s="FL_DATE") -> Column:
    """Day-first text date; ISO accepted as a second format; bad text → NULL.

    Explicit formats replace a guessed day-first parse, so an ISO date
    whose day is ≤ 12 is not read with day and month swapped.
    """
    s = _c(s)
    return F.coalesce(*[F.try_to_date(s, fmt) for fmt in DATE_FORMATS])


def dep_hour(t="CRS_DEP_TIME") -> Column:
    """HHMM → hour clipped to [0, 23]; NULL stays NULL."""
    t = _c(t)
    h = F.floor(t / 100)
    return F.when(t.isNotNull(),
                  F.least(F.greatest(h, F.lit(HOUR_MIN)), F.lit(HOUR_MAX))).cast("int")


def time_bucket(hour="dep_hour") -> Column:
    """0 red-eye (<6), 1 morning (<12), 2 afternoon (<18), 3 evening — NULL hour → 3."""
    h = _c(hour)
    b0, b1, b2 = TIME_BUCKET_BELOW
    return (F.when(h < b0, 0).when(h < b1, 1).when(h < b2, 2).otherwise(3)).cast("int")


def day_of_week(d) -> Column:
    """Monday = 0 … Sunday = 6."""
    return F.weekday(_c(d)).cast("int")


def month_of(d) -> Column:
    return F.month(_c(d)).cast("int")


def weekend_flag(dow="dep_day_of_week") -> Column:
    """1 on Saturday/Sunday; a missing date compares false → 0."""
    return F.coalesce((_c(dow) >= WEEKEND_FROM_DOW).cast("int"), F.lit(0))


def holiday_flag(month="dep_month") -> Column:
    return F.coalesce(_c(month).isin(*HOLIDAY_MONTHS).cast("int"), F.lit(0))


def route_key(origin="ORIGIN", dest="DEST") -> Column:
    """``ORIGIN_DEST``; NULL when either side is NULL."""
    return F.concat(_c(origin), F.lit("_"), _c(dest))


def distance_km(miles="DISTANCE") -> Column:
    """Miles → km at 1 decimal, half-to-even."""
    return F.bround(_c(miles) * MILES_TO_KM, 1)


def elapsed_minutes(elapsed="CRS_ELAPSED_TIME", km="route_distance_km") -> Column:
    """Scheduled minutes, falling back to km / 12; half-to-even to an int."""
    return F.bround(F.coalesce(_c(elapsed), _c(km) / FALLBACK_KM_PER_MIN), 0).cast("int")


def hub_flag(airport) -> Column:
    return F.coalesce(_c(airport).isin(*HUB_AIRPORTS).cast("int"), F.lit(0))


def delayed_label(arr_delay="ARR_DELAY") -> Column:
    return (_c(arr_delay) >= DELAY_THRESHOLD_MIN).cast("int")


def canonical_code(c) -> Column:
    """strip + upper, as scoring requests are canonicalised."""
    return F.upper(F.trim(_c(c)))
