"""logbeam: web access-log analytics on Spark DataFrames.

Raw lines -> Bronze (regex fields) -> Silver (typed, enriched, partitioned by
date) -> Gold aggregates and traffic questions, batch or streaming.
"""

from .functions.formats import LogFormat, get_format, register_format
from .operators.layers import detect_format, extract_logs, to_bronze, to_silver
from .plans.medallion import analyze_logs, gold_or_recompute, run_medallion
from .session import checkpoint_root, scratch_path, time_zone

__all__ = [
    "LogFormat",
    "analyze_logs",
    "checkpoint_root",
    "detect_format",
    "extract_logs",
    "get_format",
    "gold_or_recompute",
    "register_format",
    "run_medallion",
    "scratch_path",
    "to_bronze",
    "to_silver",
    "time_zone",
]
