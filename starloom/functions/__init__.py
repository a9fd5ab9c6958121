from starloom.functions.arrays import compact_distinct, flag_labels, label_array
from starloom.functions.casts import cast_columns, fill_unknown, lenient_cast
from starloom.functions.dates import (
    calendar_parts,
    date_key,
    epoch_ms_to_timestamp,
    timestamp_to_epoch_ms,
)
from starloom.functions.keys import hash_key

__all__ = [
    "calendar_parts",
    "cast_columns",
    "compact_distinct",
    "date_key",
    "epoch_ms_to_timestamp",
    "fill_unknown",
    "flag_labels",
    "hash_key",
    "label_array",
    "lenient_cast",
    "timestamp_to_epoch_ms",
]
