from millrace.sources.loaders import (
    CONNECTION_COLUMNS,
    COVER_GROUPS,
    COVER_MEASURES,
    cover_columns,
    index_all,
    index_target,
    load_binary_numeric,
    load_categories,
    load_connections,
    load_cover,
    load_mixed,
    load_targets,
)
from millrace.sources.models import load_model, save_model
from millrace.sources.tables import bad_apart, rows_like, scan_csv, write_csv

__all__ = [
    "CONNECTION_COLUMNS",
    "COVER_GROUPS",
    "COVER_MEASURES",
    "bad_apart",
    "cover_columns",
    "index_all",
    "index_target",
    "load_binary_numeric",
    "load_categories",
    "load_connections",
    "load_cover",
    "load_mixed",
    "load_model",
    "load_targets",
    "rows_like",
    "save_model",
    "scan_csv",
    "write_csv",
]
