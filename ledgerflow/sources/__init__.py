"""Sources: the driver's parquet tables, their feed-shaped views, and stream/file feed readers."""

from .tables import load_table
from .feeds import read_csv_feed, read_lines, source

__all__ = ["load_table", "read_csv_feed", "read_lines", "source"]
