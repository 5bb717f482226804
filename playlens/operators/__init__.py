"""DataFrame-in, DataFrame-out operators of the three pipelines and the dashboard."""

from playlens.operators.dashboard import (
    activity_chart, dashboard_functions, dashboard_views, segment_filter, segment_rollup, segmentations,
    select_function, select_view,
    to_dashboard,
)
from playlens.operators.pairing import pair_plays, play_events
from playlens.operators.popularity import content_popularity, score_plays
from playlens.operators.rejects import rejected_content, rejected_events, rejected_lines, rejects
from playlens.operators.segments import (
    absolute_activity_types, activity_types, cohort_activity_types, monthly_actives,
    users_by_segment,
)
from playlens.operators.timeshift import first_time_users, shift_log
from playlens.operators.usage import count_plays, count_usage, day_bucket, price_sessions

__all__ = [
    "activity_chart", "dashboard_functions", "dashboard_views", "select_function", "segment_filter", "segment_rollup", "segmentations",
    "select_view", "to_dashboard", "pair_plays",
    "play_events", "content_popularity", "score_plays",
    "rejected_content", "rejected_events", "rejects", "absolute_activity_types",
    "activity_types", "cohort_activity_types", "monthly_actives", "users_by_segment",
    "first_time_users", "shift_log", "count_plays", "count_usage", "day_bucket",
    "price_sessions",
]
