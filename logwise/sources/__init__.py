"""Input sources: parquet tables, log folders, comment topics, dictionaries."""

from logwise.sources.comments import comments_from_table, kafka_options, read_comments, record_view
from logwise.sources.dictionary import RefreshingDictionary, load_words, open_buckets, store_buckets, stored_versions
from logwise.sources.logs import log_lines, log_lines_from_events, write_log_files
from logwise.sources.tables import table, table_stream

__all__ = [
    "RefreshingDictionary",
    "comments_from_table",
    "kafka_options",
    "load_words",
    "log_lines",
    "log_lines_from_events",
    "open_buckets",
    "read_comments",
    "record_view",
    "store_buckets",
    "stored_versions",
    "table",
    "table_stream",
    "write_log_files",
]
