from datetime import date, timedelta

import pytest

from hazelake.plans import summaries

LAYOUT = (
    "state string, year int, month int, observed_date date, pollutant string, unit string, "
    "reading_value double, health_risk_category string"
)


@pytest.fixture
def silver(spark):
    def row(state, day, pollutant, value, risk):
        when = date(2026, 5, 1) + timedelta(days=day)
        return (state, when.year, when.month, when, pollutant, "u", value, risk)

    rows = [
        row("Johor", 0, "PM2.5", 10.0, "good"),
        row("Johor", 0, "PM2.5", 20.0, "moderate"),
        row("Johor", 6, "PM2.5", 30.0, "moderate"),
        row("Johor", 7, "PM2.5", 60.0, "unhealthy"),
        row("Johor", 40, "PM2.5", None, "unknown"),
        row(None, 0, "PM2.5", 5.0, "good"),
        row("Johor", 0, "CO", 1.0, "good"),
    ]
    return spark.createDataFrame(rows, LAYOUT)


def test_state_monthly(silver):
    rows = {(r.state, r.month, r.pollutant): r for r in summaries.state_monthly(silver).collect()}
    assert len(rows) == 4
    assert rows["Johor", 5, "PM2.5"][5:] == (30.0, 10.0, 60.0, 4)
    assert rows["Johor", 6, "PM2.5"][5:] == (None, None, None, 0)


def test_risk_summary(silver):
    rows = {
        (r.pollutant, r.health_risk_category): (r.readings, r.share)
        for r in summaries.risk_summary(silver).collect()
    }
    assert rows["PM2.5", "moderate"] == (2, 2 / 6)
    assert rows["PM2.5", "unknown"] == (1, 1 / 6)
    assert rows["CO", "good"] == (1, 1.0)


def test_haze_trend(silver):
    trend = summaries.haze_trend(silver).orderBy("state", "observed_date").collect()
    assert [tuple(r) for r in trend] == [
        (None, date(2026, 5, 1), 5.0, 5.0, None),
        ("Johor", date(2026, 5, 1), 15.0, 15.0, None),
        ("Johor", date(2026, 5, 7), 30.0, 22.5, 15.0),
        ("Johor", date(2026, 5, 8), 60.0, 45.0, 30.0),
    ]


def test_state_mean_pm25(silver):
    assert {r.state: r.mean_pm25 for r in summaries.state_mean_pm25(silver).collect()} == {
        "Johor": 30.0,
        None: 5.0,
    }
