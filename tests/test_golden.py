"""Golden values for the nine-line sample of ``conftest``, derived by hand."""

import pytest

from logbeam.operators import gold, questions


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_summary(sample_silver):
    (r,) = rows(gold.summary(sample_silver))
    assert r[:3] == (9, 4, 2)
    assert r[3] == pytest.approx(11516 / 9)
    assert r[4] == 4
    assert r[5] == pytest.approx(400 / 9)


def test_top_ips(sample_silver):
    assert rows(gold.top_ips(sample_silver)) == [
        ("198.51.100.23", 3, 1005, 2),
        ("203.0.113.8", 3, 3361, 2),
        ("192.0.2.77", 2, 150, 0),
        ("203.0.113.250", 1, 7000, 0),
    ]


def test_top_endpoints_excludes_static(sample_silver):
    assert rows(gold.top_endpoints(sample_silver)) == [
        ("/cart/9", 3, 35.0, 3),
        ("/cart", 1, 61.0, 1),
        ("/fonts/a.woff2", 1, 7000.0, 0),
        ("/img/LOGO.PNG", 1, 3300.0, 0),
        ("/reports/2024?fmt=pdf", 1, 900.0, 0),
        ("/theme.css?v=5", 1, 150.0, 0),
    ]


def test_error_analysis(sample_silver):
    assert rows(gold.error_analysis(sample_silver)) == [("404", 404, 2, 1, 2), ("422", 422, 1, 1, 1), ("503", 503, 1, 1, 1)]


def test_peak_traffic(sample_silver):
    assert rows(gold.peak_traffic(sample_silver)) == [
        ("2024-03-01", 0, 4, 7255, 2), ("2024-02-29", 23, 3, 3361, 1), ("2024-02-29", 22, 2, 900, 1)]


def test_peak_error(sample_silver):
    assert rows(gold.peak_error(sample_silver)) == [("Friday", 2)]


def test_size_stats(sample_silver):
    assert rows(gold.size_stats(sample_silver)) == [(11516, 7000, 0, 1439.5, 105.5)]


def test_size_by_status_class(sample_silver):
    got = rows(questions.size_by_status_class(sample_silver))
    assert got[:2] == [("2xx", 4, 11350, 2837.5, 7000), ("3xx", 1, 0, 0.0, 0)]
    assert got[2][:3] == ("4xx", 3, 166) and got[2][3] == pytest.approx(166 / 3) and got[2][4] == 61
    assert got[3:] == [("5xx", 1, None, None, None)]


def test_client_errors_all_weekdays(sample_silver):
    got = rows(questions.client_errors_all_weekdays(sample_silver))
    assert [r[1] for r in got] == ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
    assert [r[2] for r in got] == [0, 0, 0, 0, 1, 2, 0]


def test_summary_kv_and_lookup(sample_silver):
    kv = dict(rows(gold.summary_kv(sample_silver)))
    assert kv["distinct_client_ips"] == 4.0 and kv["unique_visitors"] == 4.0
    assert kv["total_data_volume_bytes"] == 11516.0 and kv["median_bytes"] == 105.5
    assert rows(gold.metric_lookup(gold.summary_kv(sample_silver), "days_span")) == [("days_span", 2.0)]


def test_questions(sample_silver):
    assert rows(questions.top_ips_by_count(sample_silver))[0] == ("198.51.100.23", 3)
    assert rows(questions.distinct_ips(sample_silver)) == [(4,)]
    assert rows(questions.day_count(sample_silver)) == [(2,)]
    assert rows(questions.days_list(sample_silver)) == [("2024-02-29",), ("2024-03-01",)]
    assert rows(questions.total_errors(sample_silver)) == [(4,)]
    assert sorted(rows(questions.status_distribution(sample_silver))) == [(200, 4), (304, 1), (404, 2), (422, 1), (503, 1)]
    assert rows(questions.top_urls(sample_silver))[0] == ("/cart/9", 3) and questions.top_urls(sample_silver).count() == 5
    # the wider file rule leaves out style sheets with a query string and fonts
    assert rows(questions.top_endpoints_excluding_files(sample_silver)) == [
        ("/cart/9", 3), ("/cart", 1), ("/img/LOGO.PNG", 1), ("/reports/2024?fmt=pdf", 1)]
