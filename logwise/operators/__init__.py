"""DataFrame -> DataFrame operators; each works on batch and streaming input
unless its docstring says otherwise."""

from logwise.operators.accumulate import accumulate
from logwise.operators.balance import spread
from logwise.operators.counts import count_by, total_intervals, total_snapshots
from logwise.operators.enrich import call_with_retry, enrich_with_retry, enrich_with_store, with_time_limit
from logwise.operators.filters import filter_levels, non_empty, sql_over_batch
from logwise.operators.panes import pane_counts, pane_length, windows_of_panes
from logwise.operators.parse import (
    line_levels,
    lines_from_columns,
    log_records,
    parse_log_lines,
    quarantine,
)
from logwise.operators.responses import failed_answers, parse_responses, valid_terms
from logwise.operators.sizing import Size, broadcast_if_small, measure
from logwise.operators.versions import as_of_word_counts, match_as_of, version_intervals
from logwise.operators.windows import sliding_counts, tumbling_counts
from logwise.operators.words import dictionary_words, match_words, word_document_counts

__all__ = [
    "Size",
    "accumulate",
    "as_of_word_counts",
    "broadcast_if_small",
    "call_with_retry",
    "count_by",
    "dictionary_words",
    "enrich_with_retry",
    "enrich_with_store",
    "failed_answers",
    "filter_levels",
    "line_levels",
    "lines_from_columns",
    "log_records",
    "match_as_of",
    "match_words",
    "measure",
    "non_empty",
    "pane_counts",
    "pane_length",
    "parse_log_lines",
    "parse_responses",
    "quarantine",
    "sliding_counts",
    "spread",
    "sql_over_batch",
    "total_intervals",
    "total_snapshots",
    "tumbling_counts",
    "valid_terms",
    "version_intervals",
    "windows_of_panes",
    "with_time_limit",
    "word_document_counts",
]

