"""Writers."""

from delayworks.sinks.batches import compact, expire
from delayworks.sinks.files import dropped_rows, run_available, write_batch, write_counted, write_stream
from delayworks.sinks.versions import read_current, write_version

__all__ = [
    "compact",
    "dropped_rows",
    "expire",
    "read_current",
    "run_available",
    "write_batch",
    "write_counted",
    "write_stream",
    "write_version",
]
