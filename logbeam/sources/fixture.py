"""Access-log lines derived from the ``events`` table.

The test data has no raw web log, so every registered query renders one log
line per event with a single projection (narrow, no shuffle, scales with
``events``).  The same rendering is written as SQL for the DuckDB oracle in
``logbeam.plans.oracle``; both sides must produce identical text.

Shape of the lines: about 1 % malformed, ``-`` and decimal sizes, static and
query-string urls, 2xx/3xx/4xx/5xx statuses, four address prefixes, local
times with four UTC offsets (the instant is the event's ``ts``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ``timed`` is the combined line with a response time behind it.
FLAVORS = ("common", "combined", "nginx", "timed")
# UTC offsets of the rendered lines, by event_id % 4.
OFFSETS = (("+0000", 0), ("+0200", 120), ("-0530", -330), ("+0545", 345))

EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"



def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that are rendered; the schema is given, so building a plan
    reads no file."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def log_line(flavor: str = "combined") -> Column:
    if flavor not in FLAVORS:
        raise ValueError(f"flavor must be one of {FLAVORS}")
    eid, uid, etype = F.col("event_id"), F.col("user_id"), F.col("event_type")
    method = F.when(etype.isin("signup", "purchase"), "POST").otherwise("GET")
    url = (
        F.when(eid % 8 == 0, F.lit("/home"))
        .when(eid % 8 == 1, F.lit("/static/app.js"))
        .when(eid % 8 == 2, F.concat(F.lit("/item/"), _s(uid % 20)))
        .when(eid % 8 == 3, F.lit("/static/logo.png?v=2"))
        .when(eid % 8 == 4, F.concat(F.lit("/"), etype))
        .when(eid % 8 == 5, F.lit("/docs/guide.pdf"))
        .when(eid % 8 == 6, F.lit("/fonts/main.woff2"))
        .otherwise(F.lit("/api/data"))
    )
    error_status = (
        F.when(eid % 4 == 0, "404").when(eid % 4 == 1, "403").when(eid % 4 == 2, "500").otherwise("404")
    )
    status = F.when(etype == "error", error_status).when(etype == "signup", "302").otherwise("200")
    whole = _s(F.floor(F.col("value") * 100).cast("bigint"))
    size = F.when(eid % 13 == 0, F.lit("-")).when(eid % 17 == 3, F.concat(whole, F.lit(".5"))).otherwise(whole)
    zone, minutes = F.lit(OFFSETS[0][0]), F.lit(OFFSETS[0][1])
    for k, (text, ahead) in enumerate(OFFSETS[1:], 1):
        zone, minutes = F.when(eid % 4 == k, F.lit(text)).otherwise(zone), F.when(eid % 4 == k, F.lit(ahead)).otherwise(minutes)
    local = F.col("ts") + F.make_dt_interval(mins=minutes)
    user = F.lit(" - alice [") if flavor == "nginx" else F.lit(" - - [")
    parts = [
        F.lit("10.0."), _s(uid % 4), F.lit("."), _s(uid), user,
        F.date_format(local, "dd/MMM/yyyy:HH:mm:ss"), F.lit(" "), zone, F.lit('] "'),
        method, F.lit(" "), url, F.lit(' HTTP/1.1" '), status, F.lit(" "), size,
    ]
    if flavor != "common":
        parts.append(
            F.when(eid % 2 == 0, F.lit(' "https://example.com" "Mozilla/5.0"')).otherwise(F.lit(' "-" "curl/8.0"'))
        )
    if flavor == "timed":
        parts += [F.lit(" "), _s(eid % 997)]
    line = F.concat(*parts)
    malformed = F.concat(F.lit("malformed entry "), _s(eid))
    return F.when(eid % 101 == 7, malformed).otherwise(line).alias("value")


def access_log_lines(events: DataFrame, flavor: str = "combined") -> DataFrame:
    """One ``value STRING`` row per event, like ``spark.read.text`` output."""
    return events.select(log_line(flavor))


def lines_from_tables(spark: SparkSession, sf_dir: str, flavor: str = "combined") -> DataFrame:
    """Rendered lines: a plain ``value`` column, exactly as after
    ``spark.read.text``."""
    return access_log_lines(read_events(spark, sf_dir), flavor)
