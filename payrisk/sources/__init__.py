"""Where transactions come from and where results go."""

from payrisk.sources.events import (
    classify_events,
    decode_events,
    encode_events,
    publish_events,
    rejected_messages,
)
from payrisk.sources.files import (
    read_checked_transactions,
    read_csv_parts,
    read_processed,
    read_scored,
    read_transactions,
    write_csv,
    write_mart,
    write_named_csv,
    write_processed,
)
from payrisk.sources.tx_view import build_transactions, transactions

__all__ = [
    "build_transactions",
    "classify_events",
    "decode_events",
    "encode_events",
    "publish_events",
    "read_checked_transactions",
    "read_csv_parts",
    "read_processed",
    "read_scored",
    "read_transactions",
    "rejected_messages",
    "transactions",
    "write_csv",
    "write_mart",
    "write_named_csv",
    "write_processed",
]
