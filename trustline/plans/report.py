"""All report tables of one feed."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from trustline.operators import dashboard


def report_tables(feed: DataFrame, as_of: dt.date | str | None = None) -> dict[str, DataFrame]:
    """The tables of the quality report by name, each a lazy query on the feed.

    Persist a feed that is not stored before running several of them.
    """
    return {
        "kpi_cards": dashboard.kpi_cards(feed),
        "kpi_totals": dashboard.kpis(feed),
        "health_score": dashboard.health_score(feed),
        "daily_revenue": dashboard.daily_revenue(feed, as_of),
        "daily_revenue_long": dashboard.daily_revenue_long(feed, as_of),
        "revenue_at_risk": dashboard.revenue_at_risk(feed, as_of),
        "risk_message": dashboard.risk_message(feed, as_of),
        "orders_by_status": dashboard.status_buckets(feed),
        "issue_breakdown": dashboard.issue_breakdown(feed),
        "issue_drilldown": dashboard.issue_drilldown(feed),
    }


def show_report(feed: DataFrame, as_of: dt.date | str | None = None, rows: int = 20) -> None:
    """Print the tables; ``rows`` limits the display of long ones."""
    feed = feed.persist()
    try:
        for name, table in report_tables(feed, as_of).items():
            print(f"--- {name}")
            table.show(rows, truncate=False)
    finally:
        feed.unpersist()
