"""Known results of the derived metrics, percentiles and price rules."""

from __future__ import annotations

import pytest

from tests.fixtures import fact
from tidemark.operators import metrics as m
from tidemark.operators.ordering import percentile_scores

FACTS = {
    "revenue": (100, 200),
    "net_income_parent": (10, 20),
    "equity_parent": (100, 120),
    "total_equity": (110, 130),
    "monetary_funds": (10, 10),
    "short_term_borrowings": (1, 1),
    "non_current_liabilities_due_within_one_year": (1, 1),
    "long_term_borrowings": (1, 1),
    "bonds_payable": (1, 1),
    "operating_profit": (15, 30),
    "income_tax_expense": (2, 5),
    "total_profit": (12, 25),
    "net_cash_flow_operating": (20, 50),
    "capital_expenditure_cash": (8, 20),
}


def facts(spark, **changes):
    rows = []
    for name, values in (FACTS | changes).items():
        for period, value in zip(("2024-12-31", "2025-12-31"), values, strict=True):
            rows.append(fact("A", period, name, None if value is None else float(value)))
    return spark.createDataFrame(rows)


def newest(frame):
    return {r.metric_name: (r.value, r.calculation_status) for r in frame.where("period_end = DATE'2025-12-31'").collect()}


def test_advanced_metrics(spark):
    got = newest(m.advanced_metrics(facts(spark), "v")[0])
    values = sorted((k, round(v, 6)) for k, (v, s) in got.items() if s == "calculated")
    by = dict(values)
    assert len(by) == 5
    assert by["roic_average"] == pytest.approx(30 * 0.8 / 114, abs=1e-6)
    assert by["free_cash_flow"] == 30
    assert sorted(round(v, 6) for k, v in by.items() if k not in ("roic_average", "free_cash_flow")) == [
        pytest.approx(20 / 110, abs=1e-6),
        1.0,
        1.0,
    ]


def test_ratio_statuses(spark):
    got = newest(m.ratio_metrics(facts(spark, revenue=(100, 0), total_liabilities=(1, 2), total_assets=(5, -1))))
    assert got["net_profit_margin"] == (None, "zero_denominator")
    assert got["liability_to_assets"] == (None, "non_positive_denominator")
    assert got["operating_cash_to_net_income"] == (2.5, "calculated")
    missing = newest(m.ratio_metrics(facts(spark, net_income_parent=(10, None))))
    assert missing["net_profit_margin"][1] not in ("calculated", "zero_denominator")


def test_percentiles(spark):
    frame = spark.createDataFrame([("A", 1.0), ("B", 2.0), ("C", 3.0)], "code string, v double")
    high = {r.code: r.percentile_score for r in percentile_scores(frame, "v", "code").collect()}
    low = {r.code: r.percentile_score for r in percentile_scores(frame, "v", "code", "lower").collect()}
    assert high == {"A": 0.0, "B": 0.5, "C": 1.0} and low == {"A": 1.0, "B": 0.5, "C": 0.0}
