"""Sources: model-table readers (Parquet/ORC/CSV/JSON/JDBC) and the adapter
from the benchmark's tables."""

from wardlens.sources.driver import driver_tables
from wardlens.sources.model import (Tables, conform, read_catalog, read_jdbc,
                                    read_table, read_tables, save_bucketed,
                                    write_tables)

__all__ = ["Tables", "conform", "driver_tables", "read_catalog", "read_jdbc",
           "read_table", "read_tables", "save_bucketed", "write_tables"]
