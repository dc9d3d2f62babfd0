from .files import write_avro, write_parquet, write_tagged, write_text, write_tfrecord
from .taps import TapListener, shown, tap, tap_stream
from .tagged_topics import write_tagged_messages
from .topics import publish, write_messages

__all__ = [
    "TapListener", "publish", "shown", "tap", "tap_stream", "write_avro", "write_messages", "write_parquet",
    "write_tagged", "write_tagged_messages", "write_text", "write_tfrecord",
]
