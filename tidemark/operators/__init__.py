from tidemark.operators.changes import apply_changes
from tidemark.operators.corrections import correction_spans, one_per_time, scd2_corrections, scd2_place
from tidemark.operators.hash_tree import descend, range_sums, reconcile_by_ranges, unequal_ranges
from tidemark.operators.history import as_of_join, check_scd2, scd2_extend, scd2_rebuild
from tidemark.operators.incremental import incremental_append, latest_per_key, next_watermark, unloaded_rows
from tidemark.operators.key_summary import merge_summaries, possible_parts, summarise_keys, words_for
from tidemark.operators.lineage import column_lineage_audit, dataset_lineage, lineage_events, run_audit
from tidemark.operators.profile import canonicalise, draft_mapping, key_candidates, profile_table
from tidemark.operators.quality import (
    BatchRefused,
    batch_faults,
    check_lengths,
    check_not_null,
    check_references,
    check_unique,
    check_write_conflicts,
    refuse_bad_batch,
)
from tidemark.operators.reconcile import reconcile, reconcile_summary
from tidemark.operators.scd1 import scd1_upsert
from tidemark.operators.scd2 import Versions, first_versions, scd2_changes, scd2_delta, scd2_merge
from tidemark.operators.transactions import (
    FeedColumns,
    apply_transactions,
    broken_chains,
    row_changes,
    split_feed,
    transaction_states,
)
from tidemark.operators.unique_sets import minimal_keys

__all__ = [
    "BatchRefused",
    "FeedColumns",
    "Versions",
    "apply_changes",
    "apply_transactions",
    "as_of_join",
    "batch_faults",
    "broken_chains",
    "canonicalise",
    "check_lengths",
    "check_not_null",
    "check_references",
    "check_scd2",
    "check_unique",
    "check_write_conflicts",
    "column_lineage_audit",
    "correction_spans",
    "dataset_lineage",
    "descend",
    "draft_mapping",
    "first_versions",
    "incremental_append",
    "key_candidates",
    "latest_per_key",
    "lineage_events",
    "merge_summaries",
    "minimal_keys",
    "next_watermark",
    "one_per_time",
    "possible_parts",
    "profile_table",
    "range_sums",
    "reconcile",
    "reconcile_by_ranges",
    "reconcile_summary",
    "refuse_bad_batch",
    "row_changes",
    "run_audit",
    "scd1_upsert",
    "scd2_changes",
    "scd2_corrections",
    "scd2_delta",
    "scd2_extend",
    "scd2_merge",
    "scd2_place",
    "scd2_rebuild",
    "split_feed",
    "summarise_keys",
    "transaction_states",
    "unequal_ranges",
    "unloaded_rows",
    "words_for",
]
