from trilake.sources.parquet import read_table, row_counts, show_top, write_table  # noqa: F401
from trilake.sources.raw_csv import (  # noqa: F401
    folder_header, ingest_all, land_raw, read_raw, read_raw_by_header, run_stamp,
)
from trilake.sources.rates import flatten_rates, parse_rates, read_rates_json  # noqa: F401
from trilake.sources.views import register_trusted, register_views  # noqa: F401
