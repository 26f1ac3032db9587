"""Where rows come from. Readers only build a plan; nothing is read until a sink or action runs."""

from podium.sources.jdbc import Jdbc, key_range, quantile_predicates, read_jdbc
from podium.sources.lake import empty_like, layer_path, read_landing_csv, read_layer
from podium.sources.topics import (
    kafka_options,
    read_topic_batch,
    read_topic_files,
    read_topic_files_stream,
    read_topic_stream,
)

__all__ = [
    "Jdbc",
    "empty_like",
    "kafka_options",
    "key_range",
    "quantile_predicates",
    "layer_path",
    "read_jdbc",
    "read_landing_csv",
    "read_layer",
    "read_topic_batch",
    "read_topic_files",
    "read_topic_files_stream",
    "read_topic_stream",
]
