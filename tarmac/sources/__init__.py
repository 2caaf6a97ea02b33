from tarmac.sources.tables import load_table, flights_from_orders, load_flights  # noqa: F401
from tarmac.sources.csv_landing import read_raw_csv, normalize_columns, nan_to_null  # noqa: F401
