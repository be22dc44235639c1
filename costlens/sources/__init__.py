"""Reading usage-cost records and writing result tables."""
from costlens.sources.records import (
    LEGACY_NAMES,
    RAW_SCHEMA,
    cost_records,
    filter_records,
    load_records,
    map_attributes,
    read_csv,
)
from costlens.sources.sinks import (
    latest_forecast_run,
    write_forecast_csv,
    write_forecast_table,
    write_records,
)

__all__ = [
    "LEGACY_NAMES",
    "RAW_SCHEMA",
    "cost_records",
    "filter_records",
    "latest_forecast_run",
    "load_records",
    "map_attributes",
    "read_csv",
    "write_forecast_csv",
    "write_forecast_table",
    "write_records",
]
