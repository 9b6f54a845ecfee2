from .commits import Commit, CommitLog
from .ingest import Gate, Ingest, current_stock, start_ingest, unmatched_moves
from .live import StockLog, running_totals, spike_stream, start_stock_log

__all__ = [
    "Commit",
    "CommitLog",
    "Gate",
    "Ingest",
    "StockLog",
    "current_stock",
    "running_totals",
    "spike_stream",
    "start_ingest",
    "start_stock_log",
    "unmatched_moves",
]
