"""Registry, aliases and auto-detection."""

import pytest

from logbeam.functions.formats import LogFormat, get_format, register_format
from logbeam.operators.layers import detect_format, extract_logs, to_bronze

from .conftest import SAMPLE_LINES


def test_aliases():
    assert get_format("common").name == "apache_common"
    assert get_format("combined").name == "apache_combined"


def test_detect_combined(lines_df):
    r = detect_format(lines_df(SAMPLE_LINES)).first()
    assert r["detected_format"] == "apache_combined" and r["sampled_lines"] == 9 and r["matched_lines"] == 9


def test_detect_common(lines_df):
    common = [line.split(' "-"')[0].split(' "https')[0] for line in SAMPLE_LINES]
    assert detect_format(lines_df(common)).first()["detected_format"] == "apache_common"


def test_detect_fallback_on_junk_and_empty(lines_df):
    assert detect_format(lines_df(["junk"] * 5)).first()["detected_format"] == "apache_common"
    assert detect_format(lines_df([])).first()["detected_format"] == "apache_common"


def test_detect_scores_every_line_unless_a_sample_is_asked_for(lines_df):
    mixed = ["# header"] * 6 + SAMPLE_LINES * 2 + ["junk"] * 3
    assert detect_format(lines_df(mixed)).first().asDict() == {
        "detected_format": "apache_combined", "sampled_lines": 27, "matched_lines": 18}
    assert detect_format(lines_df(["# header"] * 30 + SAMPLE_LINES), sample_size=10).first()["sampled_lines"] == 10


def test_header_lines_do_not_decide_the_format(spark, text_dir):
    df = extract_logs(spark, text_dir(["# header"] * 6 + SAMPLE_LINES * 4))
    assert "user_agent" in df.columns and df.where("referer = 'https://shop.test/'").count() == 12


def test_the_longest_registered_format_wins(lines_df):
    from logbeam.functions.formats import APACHE_COMBINED, unregister_format

    timed = LogFormat("t_timed", APACHE_COMBINED.pattern + r" (\d+)$", (*APACHE_COMBINED.columns, "millis"), APACHE_COMBINED.timestamp_format)
    register_format(timed)
    try:
        lines = lines_df([line + " 15" for line in SAMPLE_LINES])
        assert detect_format(lines).first()["detected_format"] == "t_timed"
        assert detect_format(lines_df(SAMPLE_LINES)).first()["detected_format"] == "apache_combined"
    finally:
        unregister_format("t_timed")
    assert detect_format(lines).first()["detected_format"] == "apache_combined"


def test_extract_logs_auto(spark, text_dir):
    df = extract_logs(spark, text_dir(SAMPLE_LINES), "auto")
    assert "user_agent" in df.columns and df.count() == 9


def test_custom_format(lines_df):
    fmt = LogFormat("ip_status", r"^(\S+) .* (\d{3}) \S+ \"", ["ip", "status"])
    assert fmt.columns == ("ip", "status") and hash(fmt)
    register_format(fmt, detectable=False)
    r = to_bronze(lines_df(SAMPLE_LINES[2:3]), "ip_status").first()
    assert (r["ip"], r["status"]) == ("203.0.113.8", "200")
    assert "parsed_timestamp" not in r.asDict()
    with pytest.raises(ValueError):
        get_format("nope")


# Lines built from pieces that exercise the patterns: separators, quotes,
# brackets, dashes, digits, line terminators inside a line, prefixes.
_PIECES = ["1.2.3.4", " ", "-", "[", "]", '"', "GET", "/a.png?v=2", "HTTP/1.1", "200", "99999999999",
           "14/Mar/2025:10:00:00 +0000", "\u0001", "\r", "x y", "alice", "(", "$1", "\\"]


@pytest.mark.parametrize("fmt_name", ["apache_common", "apache_combined", "nginx"])
def test_single_match_equals_per_field_extract(spark, fmt_name):
    import random

    from logbeam.functions.formats import field_columns

    from .conftest import SAMPLE_LINES

    rnd = random.Random(11)
    lines = list(SAMPLE_LINES) + ["", "junk", None, SAMPLE_LINES[0] + "\u0001", "pre " + SAMPLE_LINES[1],
                                  SAMPLE_LINES[5].replace("POST", "PO\rST"), SAMPLE_LINES[3] + " trailing \"x\" \"y\""]
    lines += ["".join(rnd.choice(_PIECES) for _ in range(rnd.randint(0, 25))) for _ in range(300)]
    lines += [SAMPLE_LINES[rnd.randrange(9)].replace(rnd.choice(["200", "-", '"', "["]), rnd.choice(_PIECES)) for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    fmt = get_format(fmt_name)
    want = df.select("value", *field_columns(fmt))
    got = to_bronze(df, fmt).select(want.columns)
    assert want.exceptAll(got).count() == 0 and got.exceptAll(want).count() == 0


def test_silver_of_partial_format(lines_df):
    from logbeam.operators.layers import to_silver

    fmt = LogFormat("request_only", r'"(\S+) (\S+) (\S+)"', ("method", "url", "protocol"))
    register_format(fmt, detectable=False)
    r = to_silver(to_bronze(lines_df(SAMPLE_LINES[3:4]), "request_only")).first()
    assert r["file_extension"] == "css" and r["is_static_asset"] is True
    assert "status_int" not in r.asDict() and "date" not in r.asDict()


def test_extract_logs_spreads_only_when_asked(spark):
    import gzip
    import tempfile
    from pathlib import Path

    d = Path(tempfile.mkdtemp(prefix="logbeam-gz-"))
    with gzip.open(d / "access.log.gz", "wt") as fh:
        fh.write("\n".join(SAMPLE_LINES * 50) + "\n")
    plain = extract_logs(spark, str(d / "access.log.gz"), "combined")
    assert "Exchange" not in plain._jdf.queryExecution().executedPlan().toString()
    dealt = extract_logs(spark, str(d / "access.log.gz"), "combined", spread_partitions=5)
    assert dealt.rdd.getNumPartitions() == 5
    assert plain.count() == dealt.count() == 450 and dealt.where("ip = ''").count() == 0


def test_time_zone_is_a_parameter_and_the_session_keeps_its_own(spark, text_dir):
    from logbeam.operators.layers import to_silver
    from logbeam.session import time_zone

    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, "America/Sao_Paulo")
    try:
        src = text_dir(SAMPLE_LINES)
        bronze = extract_logs(spark, src, "combined")
        hours = {}
        for tz in ("UTC", "Asia/Kolkata", None):
            with time_zone(spark, tz):
                silver = to_silver(bronze)
            hours[tz] = silver.first()["hour"]  # run outside the scope
            assert spark.conf.get(key) == "America/Sao_Paulo"
        assert hours == {"UTC": 22, "Asia/Kolkata": 4, None: 19}
    finally:
        spark.conf.set(key, before)
