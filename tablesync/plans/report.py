"""The report: all frames of one page, from the two histories.

What needs the latest run of a table reads the histories' latest tables, a row per table and status; changes of today and
recent runs read the days they need. No frame reads a whole history.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from tablesync.operators import report as rp
from tablesync.plans.stores import CdcHistory, FullLoadHistory, _History

RECENT_ROWS = 20


def _recent(history: CdcHistory, kept, rows: int) -> DataFrame:
    """The most recent runs: days are taken from the newest on, twice as many each time, until they hold enough."""
    days, n = history.days(), 1
    while n < len(days) and kept(history.table.read(days[:n])).limit(rows).count() < rows:
        n *= 2
    return rp.recent_activity(kept(history.table.read(days[:n])), history.run_column, rows)


def report(
    full: FullLoadHistory,
    cdc: CdcHistory,
    as_of: datetime,
    selected: str = rp.ALL,
    status: str = rp.ALL,
    table: str = rp.ALL,
    rows: int = RECENT_ROWS,
) -> dict[str, DataFrame]:
    """Frames by name. Filters apply before the latest run is picked: with a status, a table shows its latest run of that status.

    The lists of statuses and tables, and the changes of today, are not filtered.
    """

    def kept(history: _History, kind: str):
        return lambda df: rp.filtered(df, kind, selected, status, table)

    def latest(history: _History, kind: str) -> DataFrame:
        return rp.latest_per_table(kept(history, kind)(history.latest()), history.time_column, history.run_column)

    latest_cdc, latest_full = latest(cdc, rp.CDC), latest(full, rp.FULL_LOAD)
    today = [d for d in cdc.days() if d >= as_of.date()]
    return {
        "cdc_latest": rp.view(rp.with_display(latest_cdc, "row_count_diff"), rp.CDC_VIEW),
        "full_latest": rp.view(rp.with_display(latest_full, "count_diff"), rp.FULL_VIEW),
        "cdc_kpis": rp.cdc_kpis(latest_cdc),
        "full_kpis": rp.full_kpis(latest_full),
        "dq_summary": rp.dq_summary(latest_cdc, latest_full),
        "attention": rp.view(rp.attention(latest_cdc), rp.ATTENTION_VIEW),
        "today": rp.today_changes(cdc.table.read(today), as_of),
        "recent": rp.view(rp.with_display(_recent(cdc, kept(cdc, rp.CDC), rows), "row_count_diff"), rp.RECENT_VIEW),
        "statuses": rp.options("status", cdc.latest(), full.latest()),
        "tables": rp.options("table_name", cdc.latest(), full.latest()),
    }
