"""The flag report as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_report(report: DataFrame, path: str, single_file: bool = False) -> str:
    """Header, one column per report field, parts in report order, folder replaced.

    The parts are sorted ranges, so reading them by name gives the global order. A single
    file is written on request only: it sends the whole report through one task.
    """
    out = report.coalesce(1) if single_file else report
    out.write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"', nullValue="", emptyValue=""
    )
    return path
