"""Operators: pure ``DataFrame -> DataFrame`` steps plus the erase protocol."""

from tessera.operators.stages import (
    add_one, cast_column, rename_columns, group_sum, cube_avg_max, join_inner,
    join_inner_using, count_rows,
)
from tessera.operators.split import (
    label_split, split_by_hash, split_random, take_from_partition, repartition_rows,
)
from tessera.operators.generate import (
    RECORD_SCHEMA, generate_records, records_for_ids, replicate_rows,
)
from tessera.operators.erase import (
    EraseReport, erase_records, erase_records_path, erase_view, locate_records, not_in,
)
from tessera.operators.key_index import build_key_index, locate_indexed, refresh_key_index
from tessera.operators.joins import broadcast_if_small, prefix_columns

__all__ = [
    "add_one", "cast_column", "rename_columns", "group_sum", "cube_avg_max", "join_inner",
    "join_inner_using", "count_rows", "label_split", "split_by_hash", "split_random",
    "take_from_partition", "repartition_rows", "RECORD_SCHEMA", "generate_records",
    "records_for_ids", "replicate_rows", "EraseReport", "erase_records", "erase_records_path", "erase_view",
    "locate_records", "build_key_index", "locate_indexed", "refresh_key_index", "not_in", "broadcast_if_small", "prefix_columns",
]
