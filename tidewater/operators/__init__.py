from tidewater.operators.aggregates import (
    Aggregator,
    aggregate_with,
    apply_to_windows,
    distinct_first,
    max_field,
    max_field_running,
    max_record,
    max_record_running,
    ordinal,
    reduce_in_order,
    running_distinct,
)
from tidewater.operators.alarms import jump_alarm, no_drop_alarm, timer_fires
from tidewater.operators.bitmaps import dense_ids, distinct_from, merge_bitmaps, pane_bitmaps, roll_up
from tidewater.operators.changelog import aggregate_changelog, retract_count
from tidewater.operators.joins import interval_join, reconcile, unmatched, unmatched_within
from tidewater.operators.late import (
    classify,
    late_updates,
    replay_watermark,
    sliding_bounded,
    sliding_counts_with_late,
    tumbling_bounded,
)
from tidewater.operators.match import match_relaxed_sequence, match_sequence, match_times
from tidewater.operators.merging import merging_sessions, sessions_bounded
from tidewater.operators.ordered import (
    KeyedSequence,
    running_count,
    running_max,
    running_min,
    running_sum,
)
from tidewater.operators.rows import co_map, rich_map, shuffle_rows, split_rows, union_all, words
from tidewater.operators.runs import walk_windows
from tidewater.operators.windows import count_sliding, count_tumbling, sessions, sliding, tumbling

__all__ = [
    "Aggregator",
    "KeyedSequence",
    "aggregate_changelog",
    "aggregate_with",
    "apply_to_windows",
    "classify",
    "co_map",
    "count_sliding",
    "count_tumbling",
    "dense_ids",
    "distinct_first",
    "distinct_from",
    "interval_join",
    "jump_alarm",
    "late_updates",
    "match_relaxed_sequence",
    "match_sequence",
    "match_times",
    "max_field",
    "max_field_running",
    "max_record",
    "max_record_running",
    "merge_bitmaps",
    "merging_sessions",
    "no_drop_alarm",
    "ordinal",
    "pane_bitmaps",
    "reconcile",
    "reduce_in_order",
    "replay_watermark",
    "retract_count",
    "rich_map",
    "roll_up",
    "running_count",
    "running_distinct",
    "running_max",
    "running_min",
    "running_sum",
    "sessions",
    "sessions_bounded",
    "shuffle_rows",
    "sliding",
    "sliding_bounded",
    "sliding_counts_with_late",
    "split_rows",
    "timer_fires",
    "tumbling",
    "tumbling_bounded",
    "union_all",
    "unmatched",
    "unmatched_within",
    "walk_windows",
    "words",
]
