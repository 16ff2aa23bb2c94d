"""Batch logs: manifests, readers, the batch read and the streaming source."""

from .batch import for_each_log_batch, read_batch_log, scan_entries
from .history import History, history_table
from .manifest import LogEntry, only_new, read_manifest, sets_differ, stamp, write_manifest
from .readers import LogReader, ManifestReader
from .recording import RecordingReader, acknowledged_table
from .stream import register

__all__ = [
    "History",
    "LogEntry",
    "LogReader",
    "ManifestReader",
    "RecordingReader",
    "acknowledged_table",
    "for_each_log_batch",
    "history_table",
    "only_new",
    "read_batch_log",
    "read_manifest",
    "register",
    "scan_entries",
    "sets_differ",
    "stamp",
    "write_manifest",
]
