from .panes import count_trigger
from .runner import run_available, run_to_end, sentinel_message, start, stream_to_table

__all__ = ["count_trigger", "run_available", "run_to_end", "sentinel_message", "start", "stream_to_table"]
