from .jsonlines import clean, json_objects, read_lines
from .lake import Lake, write_table
from .reads import READS, read
from .specs import CLEANED, Field, TableSpec

__all__ = [
    "CLEANED",
    "READS",
    "Field",
    "Lake",
    "TableSpec",
    "clean",
    "json_objects",
    "read",
    "read_lines",
    "write_table",
]
