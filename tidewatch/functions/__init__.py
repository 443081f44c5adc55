"""Column expressions (JVM-side, codegen-friendly) used by the operators."""

from tidewatch.functions.bins import assign_bin, bin_edges
from tidewatch.functions.noise import hash_gaussian, hash_uniform, noise
from tidewatch.functions.routing import route_topic
from tidewatch.functions.text import contains_any, contains_none, substring_after, to_line
from tidewatch.functions.timefmt import format_winstart, ms_to_ts, to_ts, ts_to_ms

__all__ = [
    "assign_bin", "bin_edges", "hash_gaussian", "hash_uniform", "noise", "route_topic",
    "contains_any", "contains_none", "substring_after", "to_line",
    "format_winstart", "ms_to_ts", "to_ts", "ts_to_ms",
]
