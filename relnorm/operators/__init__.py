"""DataFrame -> DataFrame operators."""

from relnorm.operators.keys import dense_key, chunk_number, with_offset
from relnorm.operators.dedupe import (
    keep_first, keep_last, distinct_rows, drop_exact_duplicates, dimension_index,
)
from relnorm.operators.resolve import (
    resolve_fk, resolve_array_fk, interval_lookup, lookup_first, unique_by,
    cascade, enrich, snowflake_split,
)
from relnorm.operators.audit import (
    unmatched_keys, multi_match_keys, blank_key_rows, split_by_error, fail_if_any,
)
from relnorm.operators.aggregates import (
    sorted_distinct_dim, distinct_elements, sole_value, record_counts, global_max,
    source_report, collection_totals,
)
from relnorm.operators.records import wrap_records, flatten_records, stamp, rename_relational
from relnorm.operators.sets import difference, union_all, union_with_ordinal

__all__ = [n for n in dir() if not n.startswith("_")]
