"""Writing results."""

from meterlake.sinks.tables import (
    DATE,
    READS_ORDER,
    Target,
    append,
    export_csv,
    labels,
    overwrite_if_any,
    publish,
    read,
    replace_all,
    replace_kind,
    replace_slice,
    write_jdbc,
)

__all__ = [
    "DATE",
    "READS_ORDER",
    "Target",
    "append",
    "export_csv",
    "labels",
    "overwrite_if_any",
    "publish",
    "read",
    "replace_all",
    "replace_kind",
    "replace_slice",
    "write_jdbc",
]
