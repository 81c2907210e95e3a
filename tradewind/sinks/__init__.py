from tradewind.sinks.buckets import (
    BucketTable,
    commit,
    ensure_buckets,
    pinned,
    retire_runs,
    stage_merge,
    stage_replace,
)
from tradewind.sinks.lake import (
    append_bronze,
    ensure_namespace,
    ensure_table,
    merge_statement,
    merge_table,
    publish,
    retire,
    upsert_into,
    write_snapshot,
)
from tradewind.sinks.shared import shared_dir

__all__ = [
    "BucketTable",
    "append_bronze",
    "commit",
    "ensure_buckets",
    "ensure_namespace",
    "ensure_table",
    "merge_statement",
    "merge_table",
    "pinned",
    "publish",
    "retire",
    "retire_runs",
    "shared_dir",
    "stage_merge",
    "stage_replace",
    "upsert_into",
    "write_snapshot",
]
