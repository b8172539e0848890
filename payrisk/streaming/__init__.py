"""Structured Streaming: the batch scoring transforms over a message stream."""

from payrisk.streaming.commits import committed_batches, note_commit, read_committed
from payrisk.streaming.scoring import (
    drop_unscorable,
    featured_messages,
    kafka_options,
    model_scorer,
    read_tx_stream,
    score_stream,
    start_scoring,
)
from payrisk.streaming.sinks import (
    batch_console,
    batch_files,
    routed,
    start_console_sink,
    start_csv_sink,
    start_fanout,
    start_file_sink,
)

__all__ = [
    "batch_console",
    "batch_files",
    "committed_batches",
    "drop_unscorable",
    "featured_messages",
    "kafka_options",
    "model_scorer",
    "note_commit",
    "read_committed",
    "read_tx_stream",
    "routed",
    "score_stream",
    "start_console_sink",
    "start_csv_sink",
    "start_fanout",
    "start_file_sink",
    "start_scoring",
]
