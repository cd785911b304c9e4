"""DuckDB SQL that answers every registered query independently of Spark.

Three CTEs mirror the layers -- ``lines`` (events rendered as log lines),
``bronze`` (regex fields), ``silver`` (typed/enriched) -- and each query adds
its final SELECT.  Patterns, lists, names and ranges are written out here, not
taken from the code they check, so a wrong constant there shows.  Type notes:
DuckDB ``sum`` of INTEGER is HUGEINT and ``hour``/``dayofweek`` are BIGINT, so
both are cast to Spark's types; DuckDB's Sunday is 0 where Spark's is 1.
Timestamps are parsed from their first 20 characters and moved by their
offset.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LineFormat:
    pattern: str
    columns: tuple[str, ...]
    timestamp: bool = True


# The access-log patterns and column lists.
REQUEST = r'"(\S+) (\S+) (\S+)"'
COMMON = LineFormat(
    r'^(\S+) \S+ \S+ \[([^\]]+)\] ' + REQUEST + r' (\d+) (\S+)',
    ("ip", "timestamp_str", "method", "url", "protocol", "status", "size"))
COMBINED = LineFormat(COMMON.pattern + r' "([^"]*)" "([^"]*)"', (*COMMON.columns, "referer", "user_agent"))
NGINX = LineFormat(
    r'^(\S+) - (\S+) \[(.*?)\] ' + REQUEST + r' (\d+) (\d+) "([^"]*)" "([^"]*)"',
    ("ip", "user", "timestamp_str", "method", "url", "protocol", "status", "size", "referer", "user_agent"))
REQUEST_LINE = LineFormat(REQUEST, ("method", "url", "protocol"), timestamp=False)
TIMED_PATTERN = COMBINED.pattern + r" (\d+)$"

TS_SQL = "'%Y-%m-%d %H:%M:%S'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _whole(column: str) -> str:
    """Text as INTEGER, the digits after a decimal point cut off."""
    decimal = rf"regexp_matches({column}, '^[+-]?\d+\.\d*$')"
    return f"CASE WHEN {decimal} THEN TRY_CAST(split_part({column}, '.', 1) AS INTEGER) ELSE TRY_CAST({column} AS INTEGER) END"


SIZE = f"({_whole('size')})"


def lines_sql(flavor: str = "combined") -> str:
    url = (
        "CASE event_id % 8 WHEN 0 THEN '/home' WHEN 1 THEN '/static/app.js' "
        "WHEN 2 THEN '/item/' || CAST(user_id % 20 AS VARCHAR) WHEN 3 THEN '/static/logo.png?v=2' "
        "WHEN 4 THEN '/' || event_type WHEN 5 THEN '/docs/guide.pdf' "
        "WHEN 6 THEN '/fonts/main.woff2' ELSE '/api/data' END"
    )
    status = (
        "CASE WHEN event_type = 'error' THEN CASE event_id % 4 WHEN 0 THEN '404' WHEN 1 THEN '403' "
        "WHEN 2 THEN '500' ELSE '404' END WHEN event_type = 'signup' THEN '302' ELSE '200' END"
    )
    whole = "CAST(CAST(floor(value * 100) AS BIGINT) AS VARCHAR)"
    size = f"CASE WHEN event_id % 13 = 0 THEN '-' WHEN event_id % 17 = 3 THEN {whole} || '.5' ELSE {whole} END"
    zone = "CASE event_id % 4 WHEN 1 THEN '+0200' WHEN 2 THEN '-0530' WHEN 3 THEN '+0545' ELSE '+0000' END"
    ahead = "CASE event_id % 4 WHEN 1 THEN 120 WHEN 2 THEN -330 WHEN 3 THEN 345 ELSE 0 END"
    user = "' - alice ['" if flavor == "nginx" else "' - - ['"
    body = (
        f"'10.0.' || CAST(user_id % 4 AS VARCHAR) || '.' || CAST(user_id AS VARCHAR) || {user} || "
        f"strftime(ts + to_minutes({ahead}), '%d/%b/%Y:%H:%M:%S') || ' ' || {zone} || '] \"' || "
        "CASE WHEN event_type IN ('signup', 'purchase') THEN 'POST' ELSE 'GET' END || ' ' || "
        f"{url} || ' HTTP/1.1\" ' || {status} || ' ' || {size}"
    )
    if flavor != "common":
        body += " || CASE WHEN event_id % 2 = 0 THEN ' \"https://example.com\" \"Mozilla/5.0\"' ELSE ' \"-\" \"curl/8.0\"' END"
    if flavor == "timed":
        body += " || ' ' || CAST(event_id % 997 AS VARCHAR)"
    return (
        "SELECT CASE WHEN event_id % 101 = 7 THEN 'malformed entry ' || CAST(event_id AS VARCHAR) "
        f"ELSE {body} END AS value FROM events"
    )


def bronze_sql(fmt: LineFormat, src: str = "lines") -> str:
    # The struct form of regexp_extract matches once and has no 9-group limit.
    names = "[" + ", ".join(_q(c) for c in fmt.columns) + "]"
    cols = ["value"] + [f"m.{c} AS {c}" for c in fmt.columns]
    if fmt.timestamp:
        t = "m.timestamp_str"
        minutes = f"(60 * TRY_CAST(substr({t}, 23, 2) AS INTEGER) + TRY_CAST(substr({t}, 25, 2) AS INTEGER))"
        cols.append(
            f"try_strptime(substr({t}, 1, 20), '%d/%b/%Y:%H:%M:%S') "
            f"- to_minutes(CASE substr({t}, 22, 1) WHEN '-' THEN -1 ELSE 1 END * {minutes}) AS parsed_timestamp")
    return f"SELECT {', '.join(cols)} FROM (SELECT value, regexp_extract(value, {_q(fmt.pattern)}, {names}) AS m FROM {src})"


def silver_sql(src: str = "bronze") -> str:
    ext = r"regexp_extract(url, '\.([a-zA-Z0-9]+)$', 1)"
    static = "'css', 'js', 'png', 'jpg', 'jpeg', 'gif', 'ico'"
    return (
        f"SELECT *, {_whole('status')} AS status_int, "
        f"CASE WHEN size = '-' THEN 0 ELSE {SIZE} END AS bytes_sent_int, "
        f"{ext} AS file_extension, {ext} IN ({static}) AS is_static_asset, "
        "CAST(dayofweek(parsed_timestamp) + 1 AS INTEGER) AS day_of_week, "
        "strftime(parsed_timestamp, '%Y-%m-%d') AS date, "
        "CAST(hour(parsed_timestamp) AS INTEGER) AS hour, CAST(minute(parsed_timestamp) AS INTEGER) AS minute "
        f"FROM {src}"
    )


def with_layers(select: str, flavor: str = "combined", fmt: LineFormat = COMBINED, silver: bool = True) -> str:
    ctes = [f"lines AS ({lines_sql(flavor)})", f"bronze AS ({bronze_sql(fmt)})"]
    if silver:
        ctes.append(f"silver AS ({silver_sql()})")
    return "WITH " + ",\n".join(ctes) + "\n" + select


def _render(cols: list[str]) -> str:
    return ", ".join(f"strftime({c}, {TS_SQL}) AS {c}" if c == "parsed_timestamp" else c for c in cols)


ERR = "CAST(status_int >= 400 AS INTEGER)"
SUM_ERR = f"CAST(sum({ERR}) AS BIGINT)"
WEEKDAY_CASE = (
    "CASE day_of_week WHEN 1 THEN 'Sunday' WHEN 2 THEN 'Monday' WHEN 3 THEN 'Tuesday' WHEN 4 THEN 'Wednesday' "
    "WHEN 5 THEN 'Thursday' WHEN 6 THEN 'Friday' WHEN 7 THEN 'Saturday' END"
)
CLASS_CASE = (
    "CASE WHEN status_int IS NULL THEN 'unparsed' WHEN status_int < 200 THEN '1xx' WHEN status_int < 300 THEN '2xx' "
    "WHEN status_int < 400 THEN '3xx' WHEN status_int < 500 THEN '4xx' ELSE '5xx' END"
)
BRONZE_COLS = ["value", *COMBINED.columns, "parsed_timestamp"]
SILVER_COLS = BRONZE_COLS + ["status_int", "bytes_sent_int", "file_extension", "is_static_asset",
                             "day_of_week", "date", "hour", "minute"]

SUMMARY = (
    "SELECT count(*) AS total_requests, count(DISTINCT ip) AS unique_visitors, count(DISTINCT date) AS days_span, "
    f"avg(bytes_sent_int) AS avg_response_size, {SUM_ERR} AS total_errors, "
    f"sum({ERR}) / count(*) * 100 AS error_rate FROM silver"
)
CLIENT_ERRORS = (
    "SELECT day_of_week, count(*) AS cnt FROM silver WHERE status_int >= 400 AND status_int < 500 GROUP BY day_of_week"
)


def _window_sql(minutes: int, where: str = "") -> str:
    b = f"time_bucket(INTERVAL '{minutes} minutes', parsed_timestamp, TIMESTAMP '1970-01-01 00:00:00')"
    return (
        f"SELECT strftime({b}, {TS_SQL}) AS window_start, "
        f"strftime({b} + INTERVAL '{minutes} minutes', {TS_SQL}) AS window_end, "
        f"count(*) AS requests, {SUM_ERR} AS errors, CAST(sum(bytes_sent_int) AS BIGINT) AS total_bytes, "
        f"sum({ERR}) / count(*) AS error_ratio FROM silver WHERE parsed_timestamp IS NOT NULL "
        f"GROUP BY 1, 2 {where}"
    )


def _summary_kv() -> str:
    metric = {
        "total_requests": "count(*)",
        "unique_visitors": "count(DISTINCT ip)",
        "distinct_client_ips": "count(DISTINCT ip)",
        "days_span": "count(DISTINCT date)",
        "avg_response_size": "avg(bytes_sent_int)",
        "total_errors": f"sum({ERR})",
        "error_rate": f"sum({ERR}) / count(*) * 100",
        "total_data_volume_bytes": f"sum({SIZE})",
        "max_bytes": f"max({SIZE})",
        "min_bytes": f"min({SIZE})",
        "median_bytes": f"quantile_cont({SIZE}, 0.5)",
    }
    return " UNION ALL ".join(
        f"SELECT {_q(m)} AS metric_name, CAST({value} AS DOUBLE) AS metric_value FROM silver" for m, value in metric.items()
    )


def _histogram(bins: int = 50) -> str:
    return (
        f"sized AS (SELECT {SIZE} AS x FROM silver WHERE {SIZE} IS NOT NULL), "
        "st AS (SELECT min(x) AS lo, max(x) AS hi, CAST(CAST(max(x) AS BIGINT) - min(x) AS DOUBLE) AS w FROM sized), "
        "counts AS (SELECT CAST(CASE WHEN st.hi = st.lo THEN 1 ELSE "
        f"least(floor((CAST(x AS BIGINT) - st.lo) * CAST({bins} AS DOUBLE) / st.w) + 1, {bins}) END AS INTEGER) AS bin, "
        "count(*) AS cnt FROM sized, st GROUP BY 1), "
        f"bins AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, {bins + 1})) "
        f"SELECT bins.bin, st.lo + st.w * (CAST(bins.bin AS DOUBLE) - 1) / {bins} AS bin_lo, "
        f"st.lo + st.w * CAST(bins.bin AS DOUBLE) / {bins} AS bin_hi, coalesce(counts.cnt, 0) AS count "
        "FROM bins CROSS JOIN st LEFT JOIN counts ON bins.bin = counts.bin"
    )


def _detect(lines: str, formats: dict[str, str]) -> str:
    """The first of the formats (most columns first) that fits half the lines."""
    counts = ", ".join(f"count(*) FILTER (WHERE regexp_matches(value, {_q(p)})) AS {name}" for name, p in formats.items())
    chosen = "CASE " + " ".join(f"WHEN n > 0 AND {f} * 2 >= n THEN {_q(f)}" for f in formats) + " ELSE 'apache_common' END"
    matched = "CASE " + " ".join(f"WHEN n > 0 AND {f} * 2 >= n THEN {f}" for f in formats) + " ELSE apache_common END"
    return (
        f"WITH lines AS ({lines}), m AS (SELECT count(*) AS n, {counts} FROM lines) "
        f"SELECT {chosen} AS detected_format, n AS sampled_lines, {matched} AS matched_lines FROM m"
    )


def _tagged() -> str:
    """The seven Gold tables in one shape."""

    def row(name: str, select: str) -> str:
        return f"SELECT {_q(name)} AS gold_table, {select}"

    def cols(k: list[str], n: list[str], x: list[str]) -> str:
        out = []
        for letter, width, kind, own in (("k", 2, "VARCHAR", k), ("n", 4, "BIGINT", n), ("x", 2, "DOUBLE", x)):
            out += [f"CAST({own[i] if i < len(own) else 'NULL'} AS {kind}) AS {letter}{i + 1}" for i in range(width)]
        return ", ".join(out)

    bytes_sum = "CAST(sum(bytes_sent_int) AS BIGINT)"
    parts = [
        row("summary", cols([], ["count(*)", "count(DISTINCT ip)", "count(DISTINCT date)", SUM_ERR],
                            ["avg(bytes_sent_int)", f"sum({ERR}) / count(*) * 100"]) + " FROM silver"),
        "SELECT * FROM (" + row("top_ips", cols(["ip"], ["count(*)", bytes_sum, SUM_ERR], []))
        + " FROM silver GROUP BY ip ORDER BY n1 DESC, k1 LIMIT 10)",
        "SELECT * FROM (" + row("top_endpoints", cols(["url"], ["count(*)", SUM_ERR], ["avg(bytes_sent_int)"]))
        + " FROM silver WHERE NOT is_static_asset GROUP BY url ORDER BY n1 DESC, k1 LIMIT 10)",
        row("error_analysis", cols(["status"], ["status_int", "count(*)", "count(DISTINCT ip)", "count(DISTINCT date)"], []))
        + " FROM silver WHERE status_int >= 400 GROUP BY status, status_int",
        row("peak_traffic", cols(["date", "hour"], ["count(*)", bytes_sum, SUM_ERR], [])) + " FROM silver GROUP BY date, hour",
        "SELECT * FROM (" + row("peak_error", cols([WEEKDAY_CASE], ["cnt"], []))
        + f" FROM ({CLIENT_ERRORS}) WHERE day_of_week IS NOT NULL ORDER BY cnt DESC, day_of_week LIMIT 1)",
        row("summary_kv", cols(["metric_name"], [], ["metric_value"])) + f" FROM ({_summary_kv()})",
    ]
    return " UNION ALL ".join(parts)


def _final_windows() -> str:
    """On-time rows and those late rows whose window is still open; the
    watermark is the latest time less an hour, of the on-time rows while the
    late ones come, of all rows in the end."""
    bucket = "time_bucket(INTERVAL '60 minutes', parsed_timestamp, TIMESTAMP '1970-01-01 00:00:00')"
    ctes = []
    for name, where in (("ontime", "event_id % 40 <> 5"), ("late", "event_id % 40 = 5")):
        ctes += [f"{name}_lines AS ({lines_sql()} WHERE {where})", f"{name}_bronze AS ({bronze_sql(COMBINED, f'{name}_lines')})",
                 f"{name} AS ({silver_sql(f'{name}_bronze')})"]
    ctes += [
        "held AS (SELECT max(parsed_timestamp) - INTERVAL 1 HOUR AS t FROM ontime)",
        "reached AS (SELECT max(parsed_timestamp) - INTERVAL 1 HOUR AS t FROM (SELECT * FROM ontime UNION ALL SELECT * FROM late))",
        f"taken AS (SELECT late.* FROM late, held WHERE {bucket} + INTERVAL 60 MINUTES > held.t)",
        "silver AS (SELECT * FROM ontime UNION ALL SELECT * FROM taken)",
        "lost AS (SELECT (SELECT count(parsed_timestamp) FROM late) - (SELECT count(*) FROM taken) AS n)",
        f"windows AS ({_window_sql(60)})",
    ]
    return (
        "WITH " + ",\n".join(ctes) + "\nSELECT windows.*, CAST(window_end AS TIMESTAMP) <= reached.t AS final, lost.n AS late_rows "
        "FROM windows, reached, lost")


def _top(key: str, limit: int, name: str = "count", where: str = "") -> str:
    return f"SELECT {key}, count(*) AS {name} FROM silver {where} GROUP BY {key} ORDER BY {name} DESC, {key} LIMIT {limit}"


def oracle_sql() -> dict[str, str]:
    L = with_layers
    ts_cols = ["value", "parsed_timestamp", "day_of_week", "date", "hour", "minute"]
    window = _window_sql(60)
    rt = " UNION ALL ".join(
        f"SELECT {_q(f)} AS format, ip, url, status_int, bytes_sent_int, date FROM silver" for f in ("csv", "json", "orc", "parquet"))
    shorter = {"apache_combined": COMBINED.pattern, "apache_common": COMMON.pattern}
    header = "SELECT '# header ' || CAST(range AS VARCHAR) AS value FROM range(20)"
    out = {
        "parse_common": L(f"SELECT {_render(['value', *COMMON.columns, 'parsed_timestamp'])} FROM bronze",
                          "common", COMMON, silver=False),
        "silver_types": L("SELECT value, status, size, status_int, bytes_sent_int FROM silver"),
        "silver_static": L("SELECT value, url, file_extension, is_static_asset FROM silver"),
        "silver_time": L(f"SELECT {_render(ts_cols)} FROM silver"),
        "silver_logs": L(f"SELECT {_render(SILVER_COLS)} FROM silver"),
        "gold_summary": L(SUMMARY),
        "gold_top_ips": L(
            "SELECT ip, count(*) AS requests, CAST(sum(bytes_sent_int) AS BIGINT) AS total_bytes, "
            f"{SUM_ERR} AS errors FROM silver GROUP BY ip ORDER BY requests DESC, ip LIMIT 10"
        ),
        "gold_top_endpoints": L(
            "SELECT url, count(*) AS requests, avg(bytes_sent_int) AS avg_size, "
            f"{SUM_ERR} AS errors FROM silver WHERE NOT is_static_asset GROUP BY url "
            "ORDER BY requests DESC, url LIMIT 10"
        ),
        "gold_error_analysis": L(
            'SELECT status, status_int, count(*) AS "count", count(DISTINCT ip) AS affected_users, '
            "count(DISTINCT date) AS affected_days FROM silver WHERE status_int >= 400 "
            'GROUP BY status, status_int ORDER BY "count" DESC, status'
        ),
        "gold_peak_traffic": L(
            "SELECT date, hour, count(*) AS requests, CAST(sum(bytes_sent_int) AS BIGINT) AS total_bytes, "
            f"{SUM_ERR} AS errors FROM silver GROUP BY date, hour ORDER BY requests DESC, date, hour"
        ),
        "gold_peak_error": L(
            f", c AS ({CLIENT_ERRORS}) SELECT {WEEKDAY_CASE} AS day_name, cnt AS error_count FROM c "
            "WHERE day_of_week IS NOT NULL ORDER BY cnt DESC, day_of_week LIMIT 1"
        ),
        "summary_kv": L(_summary_kv()),
        "summary_metric_lookup": L(
            f"SELECT * FROM ({_summary_kv()}) WHERE metric_name = 'distinct_client_ips'"
        ),
        "top10_ips": L(_top("ip", 10)),
        "top6_endpoints": L(_top("url", 6, where=f"WHERE NOT regexp_matches(url, '\\.(css|js|png|jpg|jpeg|gif|ico|svg|woff|woff2|ttf|eot)(\\?.*)?$')")),
        "top5_urls": L(_top("url", 5, "requests")),
        "distinct_ips": L("SELECT count(DISTINCT ip) AS distinct_ips FROM silver"),
        "day_count": L("SELECT count(DISTINCT date) AS day_count FROM silver"),
        "days_list": L("SELECT DISTINCT date FROM silver WHERE date IS NOT NULL ORDER BY date"),
        "size_stats": L(
            f"SELECT CAST(sum({SIZE}) AS BIGINT) AS total_bytes, max({SIZE}) AS max_bytes, min({SIZE}) AS min_bytes, "
            f"avg({SIZE}) AS avg_bytes, quantile_cont({SIZE}, 0.5) AS median_bytes FROM silver"
        ),
        "size_by_status_class": L(
            f"SELECT {CLASS_CASE} AS category, count(*) AS requests, CAST(sum({SIZE}) AS BIGINT) AS total_bytes, "
            f"avg({SIZE}) AS avg_bytes, max({SIZE}) AS max_bytes FROM silver GROUP BY 1 ORDER BY 1"
        ),
        "size_histogram": L(", " + _histogram(50)),
        "client_errors_by_weekday": L(
            f', c AS ({CLIENT_ERRORS}) SELECT day_of_week, {WEEKDAY_CASE} AS weekday_name, cnt AS "count" FROM c'
        ),
        "client_errors_all_weekdays": L(
            f", c AS ({CLIENT_ERRORS}), d AS (SELECT CAST(range AS INTEGER) AS day_of_week FROM range(1, 8)) "
            f'SELECT d.day_of_week, {WEEKDAY_CASE.replace("CASE day_of_week", "CASE d.day_of_week")} AS weekday_name, '
            'coalesce(c.cnt, 0) AS "count" FROM d LEFT JOIN c ON d.day_of_week = c.day_of_week'
        ),
        "status_distribution": L('SELECT status_int, count(*) AS "count" FROM silver GROUP BY status_int'),
        "layer_counts": L(
            "SELECT 'bronze' AS layer, count(*) AS rows FROM lines UNION ALL "
            "SELECT 'silver', count(*) FROM silver UNION ALL "
            "SELECT 'unparsed', count(*) FILTER (WHERE ip = '') FROM bronze UNION ALL "
            "SELECT 'no_timestamp', count(*) FILTER (WHERE parsed_timestamp IS NULL) FROM silver"
        ),
        "total_errors": L(f"SELECT {SUM_ERR} AS total_errors FROM silver"),
        "parse_combined": L(f"SELECT {_render(BRONZE_COLS)} FROM bronze", silver=False),
        "parse_custom": L("SELECT * FROM bronze", "combined", REQUEST_LINE, silver=False),
        "detect_format": _detect(lines_sql("combined"), shorter),
        "detect_longer_format": _detect(
            f"{header} UNION ALL {lines_sql('timed')}", {"combined_timed": TIMED_PATTERN, **shorter}),
        "parse_nginx": L(f"SELECT {_render(['value', *NGINX.columns, 'parsed_timestamp'])} FROM bronze",
                         "nginx", NGINX, silver=False),
        "src_text": f"WITH lines AS ({lines_sql('combined')}) SELECT value FROM lines",
        "src_formats_roundtrip": L(rt),
        "bronze_roundtrip": L(f"SELECT {_render(BRONZE_COLS)} FROM bronze", silver=False),
        "append_roundtrip": L("SELECT status, 2 * count(*) AS rows FROM bronze GROUP BY status", silver=False),
        "silver_partition_pruned": L(
            "SELECT date, hour, count(*) AS requests, CAST(sum(bytes_sent_int) AS BIGINT) AS total_bytes FROM silver "
            "WHERE date BETWEEN '2024-01-10' AND '2024-01-12' GROUP BY date, hour"
        ),
        "sql_view_logs": L(
            "SELECT method, count(*) AS requests, CAST(sum(bytes_sent_int) AS BIGINT) AS total_bytes, "
            "count(DISTINCT ip) AS clients FROM silver GROUP BY method"
        ),
        "medallion_gold": L(_tagged()),
        "gold_or_recompute": L(
            "SELECT ip, count(*) AS requests, CAST(sum(bytes_sent_int) AS BIGINT) AS total_bytes, "
            f"{SUM_ERR} AS errors FROM silver GROUP BY ip ORDER BY requests DESC, ip LIMIT 10"
        ),
        "top_ips_from_gold": L(_top("ip", 7)),
        "top_ips_beyond_gold": L(_top("ip", 25)),
        "metric_from_gold": L(f"SELECT * FROM ({_summary_kv()}) WHERE metric_name = 'median_bytes'"),
        "stream_silver": L(f"SELECT {_render(SILVER_COLS)} FROM silver"),
        "windowed_traffic": L(window),
        "error_threshold_windows": L(f"SELECT * FROM ({window}) WHERE error_ratio > 0.05"),
        "windowed_traffic_stream": L(window),
        "gold_by_date": L(_tagged()),
        "size_quantiles_by_sketch": L(
            "SELECT CAST(p AS DOUBLE) AS probability, v AS \"values\", true AS \"within\" FROM "
            f"(SELECT unnest([0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]) AS p), (SELECT count({SIZE}) AS v FROM silver)"
        ),
        "size_stats_by_sketch": L(
            f"SELECT CAST(sum({SIZE}) AS BIGINT) AS total_bytes, max({SIZE}) AS max_bytes, min({SIZE}) AS min_bytes, "
            f"avg({SIZE}) AS avg_bytes, quantile_cont({SIZE}, 0.5) BETWEEN min({SIZE}) AND max({SIZE}) AS median_inside FROM silver"
        ),
        "summary_by_sketch": L(f"SELECT * EXCLUDE (unique_visitors), true AS visitors_close FROM ({SUMMARY})"),
        "silver_dates_replaced": L(
            "SELECT date, status_int, count(*) AS requests, CAST(sum(bytes_sent_int) AS BIGINT) AS total_bytes FROM silver "
            "WHERE date IS NULL OR date NOT IN ('2024-01-05', '2024-01-20') OR status_int < 400 GROUP BY date, status_int"
        ),
        "heavy_top_ips": L(
            f"SELECT ip, count(*) AS requests, CAST(sum(bytes_sent_int) AS BIGINT) AS total_bytes, {SUM_ERR} AS errors "
            "FROM silver GROUP BY ip ORDER BY requests DESC, ip LIMIT 10"
        ),
        "heavy_top_endpoints": L(
            f"SELECT url, count(*) AS requests, CAST(sum(bytes_sent_int) AS BIGINT) AS total_bytes, {SUM_ERR} AS errors "
            "FROM silver WHERE NOT is_static_asset GROUP BY url ORDER BY requests DESC, url LIMIT 10"
        ),
        "final_windows_stream": _final_windows(),
        "threshold_windows_stream": L(f"SELECT * FROM ({window}) WHERE error_ratio > 0.05"),
    }
    return out
