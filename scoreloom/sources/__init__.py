"""Readers and writers."""

from .archive import (
    RowCountMismatch, archive_catalog, archive_days, read_archive, read_foreign_days, remove_old_loads, write_archive,
)
from .files import read_csv_table, read_json_rows, read_statistics_csv, write_csv_table, write_mart, write_view
from .json_documents import joined, read_json_array, read_json_by_id, write_json_array, write_json_by_key, write_json_record
from .payloads import match_rows, payload_row_count, read_payload, scorer_rows, standing_rows
from .run_log import read_runs, record_run

__all__ = [
    "RowCountMismatch", "archive_catalog", "archive_days", "match_rows", "payload_row_count", "read_archive", "read_foreign_days",
    "remove_old_loads",
    "read_csv_table", "read_json_by_id", "read_json_rows", "read_payload", "read_runs", "read_statistics_csv",
    "record_run", "scorer_rows", "standing_rows", "write_archive", "write_csv_table",
    "joined", "read_json_array", "write_json_array", "write_json_by_key", "write_json_record", "write_mart", "write_view",
]
