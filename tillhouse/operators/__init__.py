from .dedup import keep_first
from .diff import snapshot_diff, stock_changes
from .folds import clamped_balance, level_changes, with_previous
from .keys import assign_surrogate_keys, number_missing, number_rows
from .merge import (
    delete_cascade,
    delete_set_null,
    insert_absent,
    patch,
    replace_children,
    update_from,
    update_where,
    upsert,
)
from .paging import newest_first, page, page_after, page_info
from .ranking import rank_descending
from .rules import accepted, duplicate_keys, missing_fields, orphans, rejected, sanitize, validate
from .sampling import weighted_sample
from .series import combinations, date_spine, numbered

__all__ = [
    "accepted",
    "assign_surrogate_keys",
    "clamped_balance",
    "combinations",
    "date_spine",
    "delete_cascade",
    "delete_set_null",
    "duplicate_keys",
    "insert_absent",
    "keep_first",
    "level_changes",
    "missing_fields",
    "newest_first",
    "number_missing",
    "number_rows",
    "numbered",
    "orphans",
    "page",
    "page_after",
    "page_info",
    "patch",
    "rank_descending",
    "rejected",
    "replace_children",
    "sanitize",
    "snapshot_diff",
    "stock_changes",
    "update_from",
    "update_where",
    "upsert",
    "validate",
    "weighted_sample",
    "with_previous",
]
