"""Fixed values of the two applications (intervals and refresh period)."""

# Log analysis: micro-batch interval, window length and slide.
LOG_BATCH = "2 seconds"
LOG_WINDOW = "4 seconds"
LOG_SLIDE = "2 seconds"

# Comment word counts: micro-batch interval and dictionary refresh period.
COMMENT_BATCH = "3 seconds"
DICTIONARY_TTL_MS = 300_000

# Default n-gram length of substring segmentation.
NGRAM = 3

# Rows the console sink prints per micro-batch.
CONSOLE_ROWS = 10
