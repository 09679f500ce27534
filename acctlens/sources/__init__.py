"""Line sources: message topics, text folders, minute files, and the adapter
that renders the driver's ``events`` table as accounting lines."""

from acctlens.sources.events import events_to_lines, read_events, read_event_lines
from acctlens.sources.lines import read_lines, read_topic, value_strings
from acctlens.sources.minute_files import minute_file_lines, write_minute_files

__all__ = [
    "events_to_lines", "read_events", "read_event_lines", "read_lines", "read_topic",
    "value_strings", "minute_file_lines", "write_minute_files",
]
