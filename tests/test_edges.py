"""Edge lines (FIXTURES.md §3), each under ANSI on and off."""

import pytest

from logbeam.operators import gold, questions
from logbeam.operators.layers import to_bronze, to_silver

BASE = '10.0.0.1 - - [15/Mar/2025:11:30:00 {off}] "GET {url} HTTP/1.1" {status} {size} "-" "curl/8.0"'


def line(url="/x", status="200", size="10", off="+0000"):
    return BASE.format(url=url, status=status, size=size, off=off)


@pytest.fixture(params=["true", "false"], ids=["ansi", "legacy"])
def ansi(spark, request):
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield request.param
    spark.conf.set("spark.sql.ansi.enabled", old)


def silver_of(lines_df, lines, fmt="apache_combined"):
    return to_silver(to_bronze(lines_df(lines), fmt))


def one(df):
    (r,) = df.collect()
    return r


def test_junk_line_keeps_row(ansi, lines_df):
    r = one(silver_of(lines_df, ["junk"]))
    assert r["ip"] == "" and r["url"] == "" and r["status"] == ""
    assert r["status_int"] is None and r["bytes_sent_int"] is None and r["parsed_timestamp"] is None
    assert r["is_static_asset"] is False and r["date"] is None


def test_dash_size(ansi, lines_df):
    s = silver_of(lines_df, [line(size="-")])
    assert one(s)["bytes_sent_int"] == 0
    stats = one(gold.size_stats(s))
    assert stats["total_bytes"] is None and stats["median_bytes"] is None


def test_offset_converted_to_utc(ansi, lines_df):
    r = one(silver_of(lines_df, [line(off="+0200")]))
    assert r["hour"] == 9 and r["minute"] == 30 and r["date"] == "2025-03-15" and r["day_of_week"] == 7


def test_query_string_defeats_extension(ansi, lines_df):
    s = silver_of(lines_df, [line(url="/a.png?v=2")])
    r = one(s)
    assert r["file_extension"] == "" and r["is_static_asset"] is False
    assert questions.top_endpoints_excluding_files(s).count() == 0


def test_woff2_not_static_but_a_file(ansi, lines_df):
    s = silver_of(lines_df, [line(url="/main.woff2")])
    assert one(s)["is_static_asset"] is False
    assert questions.top_endpoints_excluding_files(s).count() == 0


def test_uppercase_extension_not_static(ansi, lines_df):
    assert one(silver_of(lines_df, [line(url="/A.PNG")]))["is_static_asset"] is False


def test_oversized_size_is_null(ansi, lines_df):
    assert one(silver_of(lines_df, [line(size="99999999999")]))["bytes_sent_int"] is None


def test_empty_input(ansi, spark, lines_df):
    s = silver_of(lines_df, [])
    r = one(gold.summary(s))
    assert r["total_requests"] == 0 and r["unique_visitors"] == 0
    assert r["avg_response_size"] is None and r["total_errors"] is None and r["error_rate"] is None
    assert gold.top_ips(s).count() == 0
    assert [x["count"] for x in questions.client_errors_all_weekdays(s).collect()] == [0] * 7
    assert one(gold.size_stats(s))["median_bytes"] is None


def test_status_class_unparsed_and_bounds(ansi, lines_df):
    s = silver_of(lines_df, ["junk", line(status="101"), line(status="599"), line(status="404")])
    got = {r["category"]: r["requests"] for r in questions.size_by_status_class(s).collect()}
    assert got == {"unparsed": 1, "1xx": 1, "5xx": 1, "4xx": 1}


def test_common_format_on_combined_line_keeps_prefix(ansi, lines_df):
    r = one(to_bronze(lines_df([line()]), "common"))
    assert r["ip"] == "10.0.0.1" and r["size"] == "10" and "referer" not in r.asDict()


def test_nginx_dash_size_is_malformed(ansi, lines_df):
    ng = '10.0.0.1 - bob [15/Mar/2025:11:30:00 +0000] "GET /x HTTP/1.1" 200 - "-" "curl/8.0"'
    r = one(to_bronze(lines_df([ng]), "nginx"))
    assert r["ip"] == "" and r["user"] == ""
    ok = one(to_bronze(lines_df([ng.replace(" 200 - ", " 200 5 ")]), "nginx"))
    assert ok["user"] == "bob" and ok["size"] == "5"


def test_unknown_format_raises(lines_df):
    with pytest.raises(ValueError):
        to_bronze(lines_df(["x"]), "no_such_format")


def test_top_k_ties_break_on_key(ansi, lines_df):
    s = silver_of(lines_df, [line().replace("10.0.0.1", ip) for ip in ("10.0.0.9", "10.0.0.2", "10.0.0.5")])
    assert [r["ip"] for r in gold.top_ips(s, limit=2).collect()] == ["10.0.0.2", "10.0.0.5"]
    assert [r["ip"] for r in questions.top_ips_by_count(s, limit=1).collect()] == ["10.0.0.2"]


def test_avg_response_size_counts_dash_as_zero_and_skips_junk(ansi, lines_df):
    r = one(gold.summary(silver_of(lines_df, [line(size="10"), line(size="-"), "junk"])))
    assert r["avg_response_size"] == 5.0 and r["total_requests"] == 3
    assert abs(r["error_rate"]) < 1e-12 and r["total_errors"] == 0


def test_unparsed_url_is_kept_as_an_endpoint(ansi, lines_df):
    got = {r["url"]: r["requests"] for r in gold.top_endpoints(silver_of(lines_df, ["junk", "junk", line()])).collect()}
    assert got == {"": 2, "/x": 1}


def test_histogram_without_numeric_sizes(ansi, lines_df):
    rows = questions.size_histogram(silver_of(lines_df, ["junk", line(size="-")])).collect()
    assert len(rows) == 50 and all(r["count"] == 0 and r["bin_lo"] is None for r in rows)


def test_histogram_single_value(ansi, lines_df):
    rows = questions.size_histogram(silver_of(lines_df, [line(size="7"), line(size="7")])).collect()
    assert rows[0]["count"] == 2 and rows[0]["bin_lo"] == 7.0 and sum(r["count"] for r in rows) == 2


def test_decimal_sizes_are_cut_off(ansi, lines_df):
    s = silver_of(lines_df, [line(size="1.5"), line(size="-2.9"), line(size="7."), line(size="1.5.2"), line(size="1e3")])
    assert [r["bytes_sent_int"] for r in s.collect()] == [1, -2, 7, None, None]
    assert one(gold.size_stats(s))["total_bytes"] == 6
