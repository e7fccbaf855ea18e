from wattlane.sources.ledger import RunLedger
from wattlane.sources.tables import (
    read_split, read_table, read_untidy_csv, write_report, write_results, write_splits, write_table,
)

__all__ = ["RunLedger", "read_split", "read_table", "read_untidy_csv", "write_report", "write_results",
           "write_splits", "write_table"]
