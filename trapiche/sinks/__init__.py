"""Writers of tables, reports and models."""

from trapiche.sinks.writers import (
    store,
    write_csv,
    write_model,
    write_record,
    write_partitioned,
    write_tables,
)

__all__ = ["store", "write_csv", "write_model", "write_record", "write_partitioned", "write_tables"]
