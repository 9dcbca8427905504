"""DataFrame -> DataFrame operators: cleaning, sides, matching, aggregation."""

from curbline.operators.aggregate import (
    ADDRESS_KEYS, count_long, distinct_ids, fill_zero, max_merge, pivot_years,
    pivot_years_native, sum_by_id, totals_with_all_ids, zero_rows,
)
from curbline.operators.clean import (
    REJECT_REASONS, clean_facts, clean_segments, dedupe_labels, drop_null_facts, judge_facts,
    matchable, project_facts, read_kept, read_rejects, reject_malformed, split_malformed,
)
from curbline.operators.colocated import append_events, match_stored, match_stored_ranges, store_events, store_sides, stored_plan
from curbline.operators.match import (
    branch, branch_id, match, match_pairs, match_totals, range_condition, range_counts, union_all, union_branches,
)
from curbline.operators.outer import (
    match_inner, match_outer, pivot_outer, segments_with_counts,
)
from curbline.operators.sides import segment_sides

__all__ = [
    "ADDRESS_KEYS", "REJECT_REASONS", "append_events", "branch", "branch_id", "clean_facts",
    "clean_segments", "count_long", "dedupe_labels", "distinct_ids",
    "drop_null_facts", "fill_zero", "judge_facts", "match", "match_inner", "match_outer",
    "match_stored", "match_stored_ranges", "match_totals", "matchable", "max_merge", "pivot_outer",
    "pivot_years", "pivot_years_native", "project_facts", "range_condition", "range_counts",
    "read_kept", "read_rejects", "reject_malformed", "segment_sides", "segments_with_counts", "split_malformed",
    "store_events", "store_sides", "stored_plan", "sum_by_id",
    "totals_with_all_ids", "union_all", "union_branches", "zero_rows",
]
