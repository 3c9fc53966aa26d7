"""Running counts over a stream of posts files."""

from .counts import (
    read_counts,
    read_saved,
    running_label_counts,
    save_counts,
    save_label_counts,
    stream_label_counts,
    stream_posts,
    stream_session,
)

__all__ = [
    "read_counts",
    "read_saved",
    "running_label_counts",
    "save_counts",
    "save_label_counts",
    "stream_label_counts",
    "stream_posts",
    "stream_session",
]
