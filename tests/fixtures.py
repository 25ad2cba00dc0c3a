"""Rows of the test schemas."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Row


def fact(code: str, period: str, field: str, value: float | None, fetched: str = "2026-04-01T00:00:00") -> Row:
    day = dt.date.fromisoformat(period)
    return Row(
        security_code=code,
        security_name=f"name {code}",
        period_end=day,
        report_type="annual",
        filing_date=dt.date(2026, 4, 1),
        available_from=dt.date(2026, 4, 1),
        fetched_at=dt.datetime.fromisoformat(fetched),
        raw_record_id="r1",
        canonical_field_name=field,
        raw_field_name=field,
        statement_type="s",
        value_nature="flow",
        value=value,
        unit="CNY",
        value_status="present" if value is not None else "missing_in_source",
    )
