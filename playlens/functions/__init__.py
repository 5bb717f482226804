"""Scalar column expressions. All are built from ``pyspark.sql.functions``, so
they run inside whole-stage codegen without a Python worker."""

from playlens.functions.activity import (
    active_share, activity_type, is_active_play, is_valid_play, percent_played, play_weight,
)
from playlens.functions.dates import (
    add_months_keep_day, day_bucket, day_number, form_date, month_bucket, month_index,
    personal_cutoff, shift_date, shift_factor, split_date, time_part,
)
from playlens.functions.durations import (
    duration_epoch, duration_time_of_day, epoch_seconds_text, length_seconds, played_for,
    seconds_of_day,
)
from playlens.functions.payload import (
    DEVICE_FIRST_TIME_CONNECTED, ITEM_PLAY_FINISHED, ITEM_PLAY_STARTED, end_of_stream,
    item_name, raw_item_name, strip_extension, to_timestamp_lenient,
)

__all__ = [
    "active_share", "activity_type", "is_active_play", "is_valid_play", "percent_played",
    "play_weight", "add_months_keep_day", "day_bucket", "day_number", "form_date",
    "month_bucket", "month_index", "personal_cutoff", "shift_date", "shift_factor",
    "split_date", "time_part", "duration_epoch", "duration_time_of_day",
    "epoch_seconds_text", "length_seconds", "played_for", "seconds_of_day",
    "DEVICE_FIRST_TIME_CONNECTED", "ITEM_PLAY_FINISHED", "ITEM_PLAY_STARTED",
    "end_of_stream", "item_name", "raw_item_name", "strip_extension", "to_timestamp_lenient",
]
