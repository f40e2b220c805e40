"""CSV backups, and an export that survives a failing primary sink."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from shelfsight.sinks.encode import encode_nested, stamp


@dataclass(frozen=True)
class ExportReport:
    """What an export wrote, and why the primary sink failed if it did."""

    table: str
    skipped: bool = False
    primary_error: str | None = None
    backup_path: str | None = None


#: A file whose fields may hold line breaks is read by one task, so files are kept small.
ROWS_PER_FILE = 20_000


def csv_backup(df: DataFrame, output_dir: str, table: str, run_ts: datetime) -> str:
    """Write ``<table>_<YYYYmmdd_HHMMSS>.csv`` with a header; it is a folder of part files.

    A run that is repeated replaces its own backup.
    """
    path = f"{output_dir.rstrip('/')}/{table}_{run_ts:%Y%m%d_%H%M%S}.csv"
    encode_nested(df).write.mode("overwrite").options(
        header=True, escape='"', maxRecordsPerFile=ROWS_PER_FILE
    ).csv(path)
    return path


def export(
    df: DataFrame,
    table: str,
    run_ts: datetime,
    primary: Callable[[DataFrame], object],
    output_dir: str,
    empty: bool | None = None,
) -> ExportReport:
    """Stamp a table, write it by ``primary``, and write a CSV backup in any case.

    Nothing is written for an empty table; ``empty`` says so where the caller knows. A failure of the primary sink is
    returned, not raised.
    """
    if df.isEmpty() if empty is None else empty:
        return ExportReport(table, skipped=True)
    stamped = stamp(df, run_ts)
    error = None
    try:
        primary(stamped)
    except Exception as failure:
        error = f"{type(failure).__name__}: {failure}".splitlines()[0]
    return ExportReport(table, False, error, csv_backup(stamped, output_dir, table, run_ts))
