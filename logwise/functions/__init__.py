"""Column-level functions (pure expressions, no actions)."""

from logwise.functions.responses import (
    format_response,
    parse_response,
    response_ok,
    split_terms,
)
from logwise.functions.text import (
    collapse_whitespace,
    contained_words,
    dictionary_pattern,
    distinct_tokens,
    ngrams,
    segment_dictionary,
    segment_spaces,
    split_fields,
)
from logwise.functions.timefmt import epoch_millis, format_millis, format_seconds

__all__ = [
    "collapse_whitespace",
    "contained_words",
    "dictionary_pattern",
    "distinct_tokens",
    "epoch_millis",
    "format_millis",
    "format_response",
    "format_seconds",
    "ngrams",
    "parse_response",
    "response_ok",
    "segment_dictionary",
    "segment_spaces",
    "split_fields",
    "split_terms",
]
