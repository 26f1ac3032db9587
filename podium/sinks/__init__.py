"""Where rows go. Every function here runs a job, except the writers for micro-batches."""

from podium.sinks.fan_out import (
    Writer,
    console_writer,
    fan_out,
    files_writer,
    jdbc_writer,
    topic_files_writer,
    topic_writer,
)
from podium.sinks.jdbc import create_jdbc_table, write_jdbc
from podium.sinks.lake import write_layer
from podium.sinks.ledger import Ledger, committed, merge_writer, once, table_writer
from podium.sinks.topics import publish, publish_files

__all__ = [
    "Ledger",
    "Writer",
    "committed",
    "console_writer",
    "create_jdbc_table",
    "fan_out",
    "files_writer",
    "jdbc_writer",
    "merge_writer",
    "once",
    "publish",
    "publish_files",
    "table_writer",
    "topic_files_writer",
    "topic_writer",
    "write_jdbc",
    "write_layer",
]
