"""What only exists on a stream."""

from podium.streaming.folds import FoldedHistory
from podium.streaming.start import (
    BYTES_PER_TASK,
    EVERY_10_SECONDS,
    UNTIL_CAUGHT_UP,
    partitions_of_batches,
    run_number,
    start_console,
    start_fan_out,
)
from podium.streaming.tables import bucketed_snapshot, read_history, snapshot, stream_table
from podium.streaming.windows import windowed_averages

__all__ = [
    "BYTES_PER_TASK",
    "EVERY_10_SECONDS",
    "FoldedHistory",
    "UNTIL_CAUGHT_UP",
    "bucketed_snapshot",
    "partitions_of_batches",
    "read_history",
    "run_number",
    "snapshot",
    "start_console",
    "start_fan_out",
    "stream_table",
    "windowed_averages",
]
