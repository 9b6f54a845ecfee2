from .driver_tables import DriverTables
from .files import list_tables, load_tables, needs_seed, read_json_lake, read_table, split_corrupt
from .jdbc import read_jdbc
from .streams import kafka_stream, json_file_stream

__all__ = [
    "DriverTables",
    "json_file_stream",
    "kafka_stream",
    "list_tables",
    "load_tables",
    "needs_seed",
    "read_jdbc",
    "read_json_lake",
    "read_table",
    "split_corrupt",
]
