from .files import append_table, overwrite_table, reload_partitions, reload_range, reload_values, with_half_year
from .jdbc import write_jdbc
from .runs import logged_write

__all__ = [
    "append_table",
    "logged_write",
    "overwrite_table",
    "reload_partitions",
    "reload_range",
    "reload_values",
    "with_half_year",
    "write_jdbc",
]
