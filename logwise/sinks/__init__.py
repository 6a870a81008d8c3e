"""Sinks: replay-safe batch tables, the monthly count ledger, JDBC, console."""

from logwise.sinks.fold import Ledger, drop_folded, fold, totals
from logwise.sinks.ledger import (
    compact_months,
    contributions,
    monthly_ledger,
    monthly_totals,
    read_contributions,
    write_contributions,
)
from logwise.sinks.tables import append_batch, console, jdbc_append, read_batches

__all__ = [
    "Ledger",
    "append_batch",
    "compact_months",
    "console",
    "contributions",
    "drop_folded",
    "fold",
    "jdbc_append",
    "monthly_ledger",
    "monthly_totals",
    "read_batches",
    "read_contributions",
    "totals",
    "write_contributions",
]
