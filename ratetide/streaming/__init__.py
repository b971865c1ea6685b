from .changes import detect_changes_stream  # noqa: F401
from .events import (  # noqa: F401
    EVENT_COLUMNS, bad_events, event_messages, parse_messages, read_message_stream, start_ingest,
    valid_events,
)
