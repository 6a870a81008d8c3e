"""Structured Streaming forms of the two applications."""

from logwise.streaming.apps import start_comment_word_counts, start_log_analysis
from logwise.streaming.comments import batch_word_counts, comment_counts_query
from logwise.streaming.logs import (
    error_log_query,
    level_ledger,
    level_snapshots,
    level_totals,
    level_totals_query,
    log_analysis_query,
    pane_counts_query,
    pane_ledger,
    pane_window_totals,
    sliding_counts_query,
    window_ledger,
    window_totals,
)
from logwise.streaming.runner import (
    compact_latest,
    console_query,
    drain,
    last_batch_id,
    latest_per_key,
    snapshot_at,
    start,
)
from logwise.streaming.state import keyed_state_query, keyed_states, latest_states

__all__ = [
    "start_comment_word_counts",
    "start_log_analysis",
    "window_ledger",
    "window_totals",
    "batch_word_counts",
    "compact_latest",
    "console_query",
    "comment_counts_query",
    "drain",
    "error_log_query",
    "last_batch_id",
    "latest_per_key",
    "snapshot_at",
    "level_ledger",
    "level_snapshots",
    "level_totals",
    "level_totals_query",
    "log_analysis_query",
    "keyed_state_query",
    "keyed_states",
    "latest_states",
    "pane_counts_query",
    "pane_ledger",
    "pane_window_totals",
    "sliding_counts_query",
    "start",
]
