from starloom.operators.aggregates import (
    collect_distinct_elements,
    count_elements,
    duplicate_keys,
    global_count,
)
from starloom.operators.joins import any_key_join, explode_keys, hot_keys, insert_new, skew_join
from starloom.operators.keyed import (
    cluster_for_lookup,
    dedupe_by_key,
    keyed_table,
    lookup,
    upsert,
)
from starloom.operators.quality import (
    DataQualityError,
    casing_variants,
    numeric_labels,
    profile_nulls,
    require,
    run_checks,
)
from starloom.operators.ranking import preview, top_k, top_n_per_group
from starloom.operators.sinks import (
    append_table,
    create_bucketed,
    insert_new_bucketed,
    insert_new_rows,
    load_dimension,
    load_fact,
    materialize,
    overwrite_table,
    stage_table,
    upsert_table,
    write_csv_quoted,
    write_parquet,
)
from starloom.operators.spatial import locate_points
from starloom.operators.surrogate import append_with_identity, dense_id, row_id

__all__ = [
    "DataQualityError",
    "any_key_join",
    "append_table",
    "append_with_identity",
    "casing_variants",
    "cluster_for_lookup",
    "collect_distinct_elements",
    "count_elements",
    "create_bucketed",
    "dedupe_by_key",
    "dense_id",
    "duplicate_keys",
    "explode_keys",
    "global_count",
    "insert_new",
    "insert_new_bucketed",
    "insert_new_rows",
    "keyed_table",
    "load_dimension",
    "load_fact",
    "locate_points",
    "lookup",
    "materialize",
    "numeric_labels",
    "overwrite_table",
    "preview",
    "profile_nulls",
    "require",
    "row_id",
    "run_checks",
    "hot_keys",
    "skew_join",
    "stage_table",
    "top_k",
    "top_n_per_group",
    "upsert",
    "upsert_table",
    "write_csv_quoted",
    "write_parquet",
]
