from tally.streaming.live import (
    checkpoint_folder,
    start_live_report,
    stream_counts,
    stream_fields,
)

__all__ = ["checkpoint_folder", "start_live_report", "stream_counts", "stream_fields"]
