from quotelake.functions.casts import (
    as_money, as_percent, as_share_count, parse_event_time, strip_percent,
)
from quotelake.functions.timing import (
    latency_ms, megabytes_per_second, per_second, whole_second_latency_ms,
)

__all__ = [
    "as_money", "as_percent", "as_share_count", "parse_event_time", "strip_percent",
    "latency_ms", "megabytes_per_second", "per_second", "whole_second_latency_ms",
]
