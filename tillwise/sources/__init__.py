"""Sources: declared schemas, dated snapshot scans, driver-table derivations."""

from .scan import read_dataset, snapshot_path, stamp_ingest_date, write_snapshot
from .schemas import DATASETS, FILE_NAMES, SCHEMAS

__all__ = ["read_dataset", "snapshot_path", "stamp_ingest_date", "write_snapshot",
           "DATASETS", "FILE_NAMES", "SCHEMAS"]
