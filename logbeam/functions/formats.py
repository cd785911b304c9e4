"""Log format registry (P1-P3, D3) and the column expressions that parse a line.

A format is a Java regex with one capture group per output column, an
optional timestamp format, and the column names.  Parsing runs the regex
once per line (``single_match``) instead of once per field, all in built-in
JVM expressions inside whole-stage codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LogFormat:
    name: str
    pattern: str
    columns: tuple[str, ...]
    timestamp_format: str | None = None

    def __post_init__(self) -> None:
        # Accept any sequence of names; keep the format hashable.
        object.__setattr__(self, "columns", tuple(self.columns))

    def has_timestamp(self) -> bool:
        return bool(self.timestamp_format) and "timestamp_str" in self.columns


# The access-log patterns, timestamp format and column lists
# that parsed output must agree with.
CLF_TIMESTAMP = "dd/MMM/yyyy:HH:mm:ss Z"
APACHE_COMMON = LogFormat(
    "apache_common",
    r'^(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+) (\S+)" (\d+) (\S+)',
    ("ip", "timestamp_str", "method", "url", "protocol", "status", "size"),
    CLF_TIMESTAMP,
)
APACHE_COMBINED = LogFormat(
    "apache_combined",
    r'^(\S+) \S+ \S+ \[([^\]]+)\] "(\S+) (\S+) (\S+)" (\d+) (\S+) "([^"]*)" "([^"]*)"',
    ("ip", "timestamp_str", "method", "url", "protocol", "status", "size", "referer", "user_agent"),
    CLF_TIMESTAMP,
)
NGINX = LogFormat(
    "nginx",
    r'^(\S+) - (\S+) \[(.*?)\] "(\S+) (\S+) (\S+)" (\d+) (\d+) "([^"]*)" "([^"]*)"',
    ("ip", "user", "timestamp_str", "method", "url", "protocol", "status", "size", "referer", "user_agent"),
    CLF_TIMESTAMP,
)

_REGISTRY: dict[str, LogFormat] = {f.name: f for f in (APACHE_COMMON, APACHE_COMBINED, NGINX)}
# Short names used by command lines and job files.
_ALIASES = {"common": "apache_common", "combined": "apache_combined"}
# Formats that auto-detection tries.  A shorter pattern is a prefix match and
# also accepts the lines of a longer one, so of the formats that fit the one
# with most columns wins, ties by this order.  nginx is explicit-only (its
# pattern accepts combined lines too).
_DETECT_ORDER = ["apache_combined", "apache_common"]
DEFAULT_FORMAT = "apache_common"


def register_format(fmt: LogFormat, detectable: bool = True) -> None:
    """Add or replace a caller-defined format; optionally join auto-detection."""
    _REGISTRY[fmt.name] = fmt
    if detectable and fmt.name not in _DETECT_ORDER:
        _DETECT_ORDER.append(fmt.name)


def unregister_format(name: str) -> None:
    """Forget a caller-defined format."""
    _REGISTRY.pop(name, None)
    if name in _DETECT_ORDER:
        _DETECT_ORDER.remove(name)


def get_format(name: str | LogFormat) -> LogFormat:
    if isinstance(name, LogFormat):
        return name
    key = _ALIASES.get(name, name)
    if key not in _REGISTRY:
        raise ValueError(f"unknown log format: {name!r}; known: {sorted(_REGISTRY)}")
    return _REGISTRY[key]


def detection_order() -> list[LogFormat]:
    """Detectable formats, the most specific (most columns) first."""
    found = [_REGISTRY[n] for n in _DETECT_ORDER if n in _REGISTRY]
    return sorted(found, key=lambda f: -len(f.columns))  # stable: ties keep registry order


def field_columns(fmt: LogFormat, value: str = "value") -> list[Column]:
    """One ``regexp_extract`` per capture group (one regex match per field).
    A line that does not match keeps its row with every field ``''`` (never
    NULL).  This is the reference semantics; ``to_bronze`` gets the same
    values from a single match per line (``single_match``)."""
    line = F.col(value)
    return [F.regexp_extract(line, fmt.pattern, i).alias(c) for i, c in enumerate(fmt.columns, 1)]


# A character used to join the captured groups of one match.  A line that
# already contains it takes the per-field path, so the choice cannot change
# results.
FIELD_SEP = "\u0001"


def single_match(fmt: LogFormat, value: str = "value") -> list[Column]:
    """``_groups`` = ``['', g1, ..., gn]`` from ONE regex match per line, and
    ``_has_sep`` for the rare line that contains the separator itself.

    ``regexp_replace`` with the pattern wrapped as
    ``^(?:(?s:.*?)(?:P)(?s:.*)|(?s:.*))`` matches exactly once and consumes
    the whole line: the lazy prefix tries start positions in the same order
    as ``find()``, so the captures are those of P's first match; a line P
    does not match falls to the second branch with every group unset (empty).
    The replacement ``SEP g1 SEP g2 ... SEP gn`` then always splits into
    n + 1 elements, so each field is a single array lookup -- and an
    optimizer that inlines a field (e.g. into a pushed-down filter) copies
    the match once, not several times.
    """
    n = len(fmt.columns)
    wrapped = "^(?:(?s:.*?)(?:" + fmt.pattern + ")(?s:.*)|(?s:.*))"
    replacement = "".join(FIELD_SEP + f"${i}" for i in range(1, n + 1))
    line = F.col(value)
    return [
        F.split(F.regexp_replace(line, F.lit(wrapped), F.lit(replacement)), FIELD_SEP, -1).alias("_groups"),
        (F.instr(line, FIELD_SEP) > 0).alias("_has_sep"),
    ]


def fields_from_match(fmt: LogFormat, value: str = "value") -> list[Column]:
    """Fields from ``single_match``, equal to ``field_columns``: NULL line ->
    NULL, no match -> ''.  Lines containing the separator take one
    ``regexp_extract`` per field."""
    groups = F.col("_groups")
    return [
        F.when(F.col("_has_sep"), F.regexp_extract(F.col(value), fmt.pattern, i)).otherwise(F.get(groups, i)).alias(c)
        for i, c in enumerate(fmt.columns, 1)
    ]


def parsed_timestamp(fmt: LogFormat, timestamp_str: str = "timestamp_str") -> Column:
    """``try_to_timestamp``: a malformed or empty timestamp is NULL instead of
    aborting the job under ANSI mode.  The ``Z`` offset makes it an instant."""
    return F.try_to_timestamp(F.col(timestamp_str), F.lit(fmt.timestamp_format)).alias("parsed_timestamp")


def matches(fmt: LogFormat, value: str = "value") -> Column:
    return F.col(value).rlike(fmt.pattern)
