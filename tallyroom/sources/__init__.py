from .raw import (
    RAW_EVENTS_SCHEMA,
    RAW_ORDERS_SCHEMA,
    RAW_USERS_SCHEMA,
    quarantine,
    read_raw_csv,
    read_raw_csv_with_rejects,
    read_raw_parquet,
    read_raw_tables,
    reject_counts,
    write_csv,
)
from .store import (
    TargetNotEmptyError,
    delete_folder,
    drop_old_versions,
    guarded_write,
    materialise,
    publish_version,
    read_months,
    read_published,
    scratch_dir,
    side_by_side,
    write_attempts,
    write_bucketed,
    write_months,
)
from .runs import Runs

__all__ = [
    "RAW_EVENTS_SCHEMA",
    "RAW_ORDERS_SCHEMA",
    "RAW_USERS_SCHEMA",
    "Runs",
    "TargetNotEmptyError",
    "delete_folder",
    "drop_old_versions",
    "guarded_write",
    "materialise",
    "publish_version",
    "quarantine",
    "read_months",
    "read_published",
    "read_raw_csv",
    "read_raw_csv_with_rejects",
    "read_raw_parquet",
    "read_raw_tables",
    "reject_counts",
    "scratch_dir",
    "side_by_side",
    "write_attempts",
    "write_bucketed",
    "write_csv",
    "write_months",
]
