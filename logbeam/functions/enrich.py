"""Scalar column expressions for the Silver layer and the traffic questions.

All of them are built-in Spark functions (no UDF), ANSI-safe (``try_cast``),
and read only the columns they need so Parquet scans prune the rest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File extensions treated as static assets by the Silver layer
# (case-sensitive, matched against the extension at the very end of the url).
STATIC_EXTENSIONS = ["css", "js", "png", "jpg", "jpeg", "gif", "ico"]
EXTENSION_PATTERN = r"\.([a-zA-Z0-9]+)$"

# The wider "is a file" rule used when ranking endpoints; it also
# accepts a trailing query string.
FILE_URL_PATTERN = r"\.(css|js|png|jpg|jpeg|gif|ico|svg|woff|woff2|ttf|eot)(\?.*)?$"

# Weekday names for Spark's dayofweek numbering (1 = Sunday).
WEEKDAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]

# HTTP status class labels.
STATUS_CLASSES = ["1xx", "2xx", "3xx", "4xx", "5xx"]
UNPARSED = "unparsed"


def whole_number(column: str) -> Column:
    """Text as INT: digits after a decimal point are cut off ('1.5' is 1, as a
    plain cast gives); anything else that is not a number is NULL."""
    text = F.col(column)
    cut = F.when(F.instr(text, ".") > 0, F.regexp_replace(text, r"^([+-]?\d+)\.\d*$", "$1")).otherwise(text)
    return cut.try_cast("int")


def status_int(status: str = "status") -> Column:
    """Status as INT; '' (unparsed line) becomes NULL."""
    return whole_number(status)


def bytes_sent_int(size: str = "size") -> Column:
    """E2: '-' means no body (0 bytes); anything else is an INT or NULL."""
    return F.when(F.col(size) == "-", F.lit(0)).otherwise(whole_number(size))


def size_bytes(size: str = "size") -> Column:
    """Response size for size statistics: '-' and garbage are NULL (excluded)."""
    return whole_number(size)


def file_extension(url: str = "url") -> Column:
    """Trailing extension; a query string defeats it on purpose."""
    return F.regexp_extract(F.col(url), EXTENSION_PATTERN, 1)


def is_static_asset(ext: Column) -> Column:
    """Case-sensitive membership in the static list."""
    return ext.isin(STATIC_EXTENSIONS)


def is_file_url(url: str = "url") -> Column:
    """F3 (negated by callers): url names a file by the wider rule."""
    return F.col(url).rlike(FILE_URL_PATTERN)


def is_error(status_int_col: str = "status_int") -> Column:
    """1 for status >= 400, 0 below, NULL when the status is unknown."""
    return (F.col(status_int_col) >= 400).cast("int")


def is_client_error(status_int_col: str = "status_int") -> Column:
    """400 <= status < 500."""
    s = F.col(status_int_col)
    return (s >= 400) & (s < 500)


def status_class(status_int_col: str = "status_int") -> Column:
    """1xx..5xx by the bounds <200, <300, <400, <500, else; NULL -> 'unparsed'."""
    s = F.col(status_int_col)
    return (
        F.when(s.isNull(), F.lit(UNPARSED))
        .when(s < 200, F.lit(STATUS_CLASSES[0]))
        .when(s < 300, F.lit(STATUS_CLASSES[1]))
        .when(s < 400, F.lit(STATUS_CLASSES[2]))
        .when(s < 500, F.lit(STATUS_CLASSES[3]))
        .otherwise(F.lit(STATUS_CLASSES[4]))
    )


def weekday_name(day_of_week: str = "day_of_week") -> Column:
    """Name for Spark's 1 = Sunday numbering; a 7-element literal array,
    so the lookup is a codegen'd array index, not a join."""
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    return F.get(names, F.col(day_of_week) - 1)


def time_dimensions(ts: str = "parsed_timestamp") -> list[Column]:
    """E5: calendar parts in the session time zone (pinned to UTC by callers)."""
    t = F.col(ts)
    return [
        F.dayofweek(t).alias("day_of_week"),
        F.date_format(t, "yyyy-MM-dd").alias("date"),
        F.hour(t).alias("hour"),
        F.minute(t).alias("minute"),
    ]
