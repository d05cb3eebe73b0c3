from .messages import kafka_messages, kafka_options, landed_messages, socket_messages
from .readings import empty_table, read_json, table_of

__all__ = [
    "empty_table",
    "kafka_messages",
    "kafka_options",
    "landed_messages",
    "read_json",
    "socket_messages",
    "table_of",
]
