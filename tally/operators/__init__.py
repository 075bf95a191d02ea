from tally.operators.aggregates import (
    conditional_counts,
    counts_per_outer,
    monthly_presence_ratio,
    presence_ratio,
)
from tally.operators.asof import join_asof
from tally.operators.bitmaps import check_reference_ids, check_unique_ids, count_ids, id_bitmaps, merge_bitmaps
from tally.operators.changes import (
    apply_updates,
    audit_changes,
    audit_pairs,
    classify,
    latest_per_key,
    pair_images,
    replay,
)
from tally.operators.digests import differing
from tally.operators.intervals import semi_intervals
from tally.operators.joins import (
    fits_broadcast,
    hot_keys,
    join_dim,
    join_one,
    lookup,
    semi_theta,
    spread_join,
)
from tally.operators.quality import (
    check_columns,
    check_date_range,
    check_length_bounds,
    check_max_length,
    check_not_null,
    check_references,
    check_rules,
    check_unique,
    clamp_to_reference,
    fill_defaults,
    judge_against_reference,
    judge_as_of,
    orphans,
    settle,
    tolerance_summary,
    valid_on,
)
from tally.operators.ranking import extremes, first_n, rank_all, ranked, top_n_per_group

__all__ = [
    "apply_updates",
    "audit_changes",
    "audit_pairs",
    "check_columns",
    "check_date_range",
    "check_length_bounds",
    "check_max_length",
    "check_not_null",
    "check_reference_ids",
    "check_references",
    "check_rules",
    "check_unique",
    "check_unique_ids",
    "clamp_to_reference",
    "classify",
    "conditional_counts",
    "count_ids",
    "counts_per_outer",
    "differing",
    "extremes",
    "fill_defaults",
    "first_n",
    "fits_broadcast",
    "hot_keys",
    "id_bitmaps",
    "join_asof",
    "join_dim",
    "join_one",
    "judge_against_reference",
    "judge_as_of",
    "latest_per_key",
    "lookup",
    "merge_bitmaps",
    "monthly_presence_ratio",
    "orphans",
    "pair_images",
    "presence_ratio",
    "rank_all",
    "ranked",
    "replay",
    "semi_intervals",
    "semi_theta",
    "settle",
    "spread_join",
    "tolerance_summary",
    "top_n_per_group",
    "valid_on",
]
