from tarmac.functions.features import (  # noqa: F401
    parse_flight_date, dep_hour, time_bucket, day_of_week, month_of, weekend_flag,
    holiday_flag, route_key, distance_km, elapsed_minutes, hub_flag, delayed_label,
    canonical_code,
)
from tarmac.functions.tiers import risk_level, confidence_level, flight_label, round4  # noqa: F401
from tarmac.functions.docs import split_object_uri, json_path_double  # noqa: F401
