"""Hand-made rows for every scalar function."""

import pytest
from pyspark.sql import functions as F

from punctuality.functions import (
    cancelled,
    clock_seconds,
    flags_of,
    instant,
    leading_value,
    line_code,
    line_title,
    mean_minutes,
    part_of_total_pct,
    rate_pct,
    reason,
    reason_title,
    report_code,
    service_day_seconds,
    stop_key,
    unreported,
)



@pytest.fixture(autouse=True)
def columns(spark):
    """Columns can be made only once a session runs."""
    global A, B
    A, B = F.col("a"), F.col("b")


def test_line_code(evaluate):
    rows = [("NET:C01742", "A"), (None, "A"), ("NET:R3", None), ("x", "y"), ("C1C2", "z"), ("c77", "z"), ("", None)]
    assert evaluate(rows, "ab", line_code(A, B)) == ["C01742", "A", None, "y", "C1", "z", None]
    rows = ["REF:Line::C01729:", "weird", None]
    assert evaluate(rows, "a", line_code(A, A)) == ["C01729", "weird", None]


def test_stop_key_keeps_runs_of_spaces(evaluate):
    rows = ["La Défense - Terminal Jules Verne", "Gare (RER)*", "L'Haÿ", "\ta ", "  X (RER)", "a\\b", None]
    expected = ["la défense   terminal jules verne", "gare  rer  ", "l haÿ", "\ta", "x  rer ", "a b", None]
    assert evaluate(rows, "a", stop_key(A)) == expected


def test_stop_key_collapsed(evaluate):
    assert evaluate(["A - B", "A-B", "X (RER)"], "a", stop_key(A, True)) == ["a b", "a b", "x rer "]


def test_clock_seconds(evaluate):
    rows = [
        "00:00:00",
        "25:10:30",
        "7:05",
        "x:00:00",
        "",
        None,
        "8:5:3",
        " 08:05:03 ",
        "08:05:03.9",
        "1:2:3:4",
        "999999999:00:00",
        "99999999999:00:00",
    ]
    expected = [0, 90630, None, None, None, None, 29103, 29103, 29103, 3723, None, None]
    assert evaluate(rows, "a", clock_seconds(A)) == expected


def test_service_day_seconds(evaluate):
    rows = ["2026-01-05T03:59:59", "2026-01-05T04:00:00", "2026-01-05T00:00:00", None]
    seconds = service_day_seconds(instant(A), 4)
    assert evaluate(rows, "a", seconds) == [100799, 14400, 86400, None]
    assert evaluate(rows, "a", service_day_seconds(A.try_cast("timestamp_ntz"), 4)) == [100799, 14400, 86400, None]


def test_service_day_seconds_in_a_zone(spark, evaluate):
    rows = [
        "2026-03-25T15:31:10.000Z",  # winter time, one hour ahead
        "2026-03-29T00:59:59Z",  # last second before summer time
        "2026-03-29T01:00:00Z",  # 03:00 summer time
        "2026-10-25T00:30:00Z",  # 02:30 the first time
        "2026-10-25T01:30:00Z",  # 02:30 the second time
    ]
    expected = [59470, 93599, 97200, 95400, 95400]
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "America/New_York", "Europe/Paris"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert evaluate(rows, "a", service_day_seconds(instant(A), 4, "Europe/Paris")) == expected
            if zone == "Europe/Paris":
                assert evaluate(rows, "a", service_day_seconds(instant(A), 4)) == expected
        finally:
            spark.conf.set("spark.sql.session.timeZone", before)


def test_instant_does_not_raise(evaluate):
    assert evaluate(["nope", "", None, "2026-13-01T00:00:00Z"], "a", instant(A)) == [None] * 4


def test_leading_value(spark):
    rows = [(None,), ([],), ([("v",)],), ([("v1",), ("v2",)],), ([None, ("v2",)],)]
    frame = spark.createDataFrame(rows, "a array<struct<value:string>>").coalesce(1)
    assert [row[0] for row in frame.select(leading_value(A)).collect()] == [None, None, "v", "v1", None]


def test_statuses_have_three_values(evaluate):
    rows = [(None, "Cancelled"), (None, "onTime"), ("x", "y"), (None, None), ("CANCELLED", "x"), ("noReport", None)]
    assert evaluate(rows, "ab", cancelled(A, B)) == [True, None, False, None, True, None]
    assert evaluate(rows, "ab", unreported(A, B)) == [None, None, False, None, False, True]


def test_report_code_round_trip(spark):
    values = (True, None, False)
    frame = spark.createDataFrame([(c, u) for c in values for u in values], "c boolean, u boolean").coalesce(1)
    code = report_code(F.col("c"), F.col("u"))
    got = frame.select("c", "u", code.alias("code"), *flags_of(code)).collect()
    assert [row.code for row in got] == list(range(9))
    assert all((row[0], row[1]) == (row[3], row[4]) for row in got)


def test_reason_precedence(spark):
    rows = [
        (True, True, True, "cancelled_service"),
        (None, True, True, "delay"),
        (False, False, True, "missing_realtime_status"),
        (None, False, None, "normal"),
        (False, False, False, "normal"),
    ]
    frame = spark.createDataFrame(rows, "c boolean, d boolean, u boolean, want string")
    got = frame.select(reason(F.col("c"), F.col("d"), F.col("u")), "want").collect()
    assert all(given == want for given, want in got)


def test_figures(spark):
    rows = [(3, 373), (2, 373), (1, 3), (2, 3), (1, 800), (0, 5)]
    frame = spark.createDataFrame(rows, "n bigint, d bigint").coalesce(1)
    n, d = F.col("n"), F.col("d")
    assert [r[0] for r in frame.select(rate_pct(n, d)).collect()] == [0.8, 0.54, 33.33, 66.67, 0.13, 0.0]
    frame = spark.createDataFrame([(1, 0), (None, 0), (1, None), (1, 4)], "n bigint, d bigint").coalesce(1)
    assert [r[0] for r in frame.select(part_of_total_pct(n, d)).collect()] == [0.0, 0.0, 0.0, 25.0]
    frame = spark.createDataFrame([(267, 1), (1, 2), (-1, 2), (None, 0)], "n bigint, d bigint").coalesce(1)
    assert [r[0] for r in frame.select(mean_minutes(n, d)).collect()] == [2.67, 0.01, -0.01, None]


def test_titles(evaluate):
    rows = [("C1", "A"), ("C1", "C1"), ("C1", None), (None, "A"), ("", ""), ("C1", "")]
    expected = ["C1 (A)", "C1", "C1", "ligne inconnue (A)", "ligne inconnue", "C1"]
    assert evaluate(rows, "ab", line_title(A, B)) == expected
    rows = ["delay", "foo_bar", None, "", "cancelled_service", "missing_realtime_status", "normal"]
    expected = ["Retard", "foo bar", "inconnu", "inconnu", "Service annule", "Statut temps reel manquant", "Normal"]
    assert evaluate(rows, "a", reason_title(A)) == expected
