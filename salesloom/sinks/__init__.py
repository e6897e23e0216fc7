from salesloom.sinks.tables import (
    CatalogSink,
    JdbcSink,
    ParquetSink,
    restore_snapshot,
    save_snapshot,
)

__all__ = ["CatalogSink", "JdbcSink", "ParquetSink", "restore_snapshot", "save_snapshot"]
