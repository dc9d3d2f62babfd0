from .columnar import read_avro, read_parquet
from .jdbc import jdbc_options, read_jdbc
from .memory import create, create_from_map
from .records import read_records, read_tfrecord
from .text import read_csv, read_text
from .topics import MESSAGE_SCHEMA, read_messages, to_messages

__all__ = [
    "MESSAGE_SCHEMA", "create", "create_from_map", "jdbc_options", "read_avro", "read_csv",
    "read_jdbc", "read_messages", "read_parquet", "read_records", "read_text",
    "read_tfrecord", "to_messages",
]
