from starloom.sources.files import (
    merge_csv,
    read_csv_strings,
    read_json,
    read_parquet,
    read_table,
)
from starloom.sources.geo import read_zone_polygons
from starloom.sources.staging import read_json_paths, stage_json

__all__ = [
    "merge_csv",
    "read_csv_strings",
    "read_json",
    "read_json_paths",
    "read_parquet",
    "read_table",
    "read_zone_polygons",
    "stage_json",
]
