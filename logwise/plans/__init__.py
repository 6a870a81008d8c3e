"""Application plans and the registered query catalog."""

from logwise.plans.apps import LogAnalysis, comment_word_counts, log_analysis
from logwise.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "LogAnalysis", "comment_word_counts", "log_analysis"]
