"""Complete jobs."""

from podium.plans.incremental import gold_averages, load_increment, load_silver, silver_rows, update_gold
from podium.plans.lake import (
    bronze_to_silver,
    landing_to_bronze,
    run_lake,
    silver_by_key,
    silver_to_gold,
)
from podium.plans.streams import (
    fan_out_messages,
    running_stats,
    stream_fan_out,
    stream_stats,
)
from podium.plans.tables import publish_table, read_stats, round_trip_stats
from podium.plans.topics import FileTopic, KafkaTopic

__all__ = [
    "FileTopic",
    "KafkaTopic",
    "bronze_to_silver",
    "fan_out_messages",
    "gold_averages",
    "landing_to_bronze",
    "load_increment",
    "load_silver",
    "publish_table",
    "read_stats",
    "round_trip_stats",
    "run_lake",
    "running_stats",
    "silver_by_key",
    "silver_rows",
    "silver_to_gold",
    "stream_fan_out",
    "stream_stats",
    "update_gold",
]
