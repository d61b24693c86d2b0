from tidemark.streaming.history import merge_changes, stream_scd2
from tidemark.streaming.incremental import append_stream, stream_append, stream_incremental, stream_keyed_append
from tidemark.streaming.versions import state_on_disk, stream_versions, versions_of

__all__ = [
    "append_stream",
    "merge_changes",
    "state_on_disk",
    "stream_append",
    "stream_incremental",
    "stream_keyed_append",
    "stream_scd2",
    "stream_versions",
    "versions_of",
]
