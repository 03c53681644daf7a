from tidewater.streaming.late import LateSessions, LateSplitter, LateWindows
from tidewater.streaming.processors import apply_stateful
from tidewater.streaming.running import drain, start_durable
from tidewater.streaming.snapshots import partition_sizes, state_changes, state_of

__all__ = ["LateSessions", "LateSplitter", "LateWindows", "apply_stateful", "drain", "partition_sizes", "start_durable", "state_changes", "state_of"]
