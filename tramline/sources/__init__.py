"""Sources and sinks: CSV seeds, the supplied Parquet tables, the landing log."""

from tramline.sources.seeds import read_seed
from tramline.sources.tables import TABLE_NAMES, load_table

__all__ = ["TABLE_NAMES", "load_table", "read_seed"]
