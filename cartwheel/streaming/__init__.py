from cartwheel.streaming.stream import (  # noqa: F401
    write_ordered_slices, replay_slices, event_stream, stream_dedup, stream_funnel_merge, stream_funnel_buckets, stream_funnel_state,
    stream_activity, latest_state, stream_counts, stream_missing,
)
