"""Bronze and Silver layers (P1-P5, E1-E6) as single projections.

``to_bronze`` is a projection: raw line + the fields of one regex match +
``try_to_timestamp``.  ``to_silver`` is one more ``select`` on top.  No
``withColumn`` chains (each would stack a Project node), no UDF, no shuffle:
both layers are map-only and run at scan speed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import enrich
from ..functions.formats import (
    DEFAULT_FORMAT,
    LogFormat,
    detection_order,
    fields_from_match,
    get_format,
    matches,
    parsed_timestamp,
    single_match,
)
from ..session import UTC, time_zone
from ..sources import files


def to_bronze(lines: DataFrame, log_format: str | LogFormat = DEFAULT_FORMAT, value: str = "value") -> DataFrame:
    """Raw ``value`` + STRING field per capture group (+ parsed_timestamp).

    The regex runs once per line (``single_match``) and the fields are
    array lookups into that match.  The match is emitted through a one-row
    generator (``inline`` of a one-element array): Catalyst pushes a filter
    through projections by copying the aliased expressions into it, so a
    filter on a parsed field (``status_int >= 400``, ``NOT is_static_asset``)
    would otherwise run the regex a second time; it never pushes a filter on
    generator output below the generator, so the match is computed once.
    """
    fmt = get_format(log_format)
    matched = lines.select(F.col(value).alias("value"), F.inline(F.array(F.struct(*single_match(fmt, "value")))))
    bronze = matched.select("value", *fields_from_match(fmt, "value"))
    if fmt.has_timestamp():
        bronze = bronze.select("*", parsed_timestamp(fmt, "timestamp_str"))
    return bronze


def detect_format(lines: DataFrame, sample_size: int | None = None, value: str = "value",
                  formats: Sequence[LogFormat] | None = None) -> DataFrame:
    """Of the formats that match at least half of the lines the one with
    most columns; ``apache_common`` if none does.

    One job for all formats (a single aggregate of ``count_if(rlike)``) over
    every line; ``sample_size`` restricts it to the first lines, at the risk
    that a header decides for the whole input.  ``formats`` replaces the
    registered ones.  Returns one row: ``detected_format, sampled_lines,
    matched_lines``.
    """
    fmts = sorted(formats, key=lambda f: -len(f.columns)) if formats else detection_order()
    sample = lines.limit(sample_size) if sample_size else lines
    counts = sample.agg(
        F.count(F.lit(1)).alias("sampled_lines"),
        *[F.count_if(matches(f, value)).alias(f"m{i}") for i, f in enumerate(fmts)],
    )
    n = F.col("sampled_lines")
    names = [f.name for f in fmts]
    chosen = F.lit(DEFAULT_FORMAT)
    matched = F.col(f"m{names.index(DEFAULT_FORMAT)}") if DEFAULT_FORMAT in names else F.lit(0).cast("bigint")
    # Build the CASE from last to first so the most specific format wins.
    for i in reversed(range(len(fmts))):
        ok = (n > 0) & (F.col(f"m{i}") * 2 >= n)
        chosen = F.when(ok, F.lit(fmts[i].name)).otherwise(chosen)
        matched = F.when(ok, F.col(f"m{i}")).otherwise(matched)
    return counts.select(chosen.alias("detected_format"), n, matched.alias("matched_lines"))


def extract_logs(spark: SparkSession, path: str, log_format: str | LogFormat | None = None,
                 sample_size: int | None = None, spread_partitions: int | None = None,
                 tz: str | None = UTC) -> DataFrame:
    """Read raw text and parse it; ``None``/``'auto'`` runs detection first,
    over every line unless ``sample_size`` is given.  ``spread_partitions``
    deals unsplittable input to so many tasks before the parse; ``tz`` is the
    zone of the plan (None: the session's)."""
    with time_zone(spark, tz):
        lines = files.read_text(spark, path)
        if log_format in (None, "auto"):
            row = detect_format(lines, sample_size).first()
            log_format = row["detected_format"] if row else DEFAULT_FORMAT
        return to_bronze(files.spread(lines, spread_partitions), log_format)


#: Lines whose format decides what a counted extraction tries first.
GUESS_LINES = 1000


def chosen_format(counts: Mapping[str, int], formats: Sequence[LogFormat]) -> str:
    """``detect_format``'s choice from the counts ``rows`` and ``m0``, ``m1``, ..."""
    for i, fmt in enumerate(formats):
        if counts["rows"] and counts[f"m{i}"] * 2 >= counts["rows"]:
            return fmt.name
    return DEFAULT_FORMAT


def write_bronze(spark: SparkSession, path: str, bronze_path: str, log_format: str | LogFormat | None = None,
                 spread_partitions: int | None = None, guess_lines: int = GUESS_LINES, tz: str | None = UTC) -> tuple[str, int]:
    """P4 + P1 in one scan of the text: returns the format and the rows written.

    With no format given, the format of the first lines is parsed and written
    while the same pass counts the matches of every detectable format.  If the
    counts over all lines choose another, Bronze is parsed anew from the lines
    just written (Parquet), so the text is scanned once either way and the
    result is that of ``detect_format`` over every line.
    """
    with time_zone(spark, tz):
        lines = files.spread(files.read_text(spark, path), spread_partitions)
        auto = log_format in (None, "auto")
        formats = detection_order() if auto else []
        if auto:
            row = detect_format(files.read_text(spark, path), guess_lines).first()
            log_format = row["detected_format"] if row else DEFAULT_FORMAT
        seen = Observation("lines")
        counted = lines.observe(
            seen, F.count(F.lit(1)).alias("rows"), *(F.count_if(matches(f, "value")).alias(f"m{i}") for i, f in enumerate(formats)))
        files.write_parquet(to_bronze(counted, log_format), bronze_path)
        if auto:
            chosen = chosen_format(seen.get, formats)
            if chosen != get_format(log_format).name:
                log_format = chosen
                aside = f"{bronze_path.rstrip('/')}_parsed"
                files.write_parquet(to_bronze(files.read_parquet(spark, bronze_path).select("value"), chosen), aside)
                files.replace_path(spark, aside, bronze_path)
        return get_format(log_format).name, seen.get["rows"]


def to_silver(bronze: DataFrame) -> DataFrame:
    """E1-E6 in one projection: types, extension/static flag, time parts.

    Each enrichment is added when its input column exists, so a custom
    format without (say) a size still gets the others; time parts need
    ``parsed_timestamp``.
    """
    have = set(bronze.columns)
    cols = [F.col(c) for c in bronze.columns]
    if "status" in have:
        cols.append(enrich.status_int("status").alias("status_int"))
    if "size" in have:
        cols.append(enrich.bytes_sent_int("size").alias("bytes_sent_int"))
    if "url" in have:
        ext = enrich.file_extension("url")
        cols += [ext.alias("file_extension"), enrich.is_static_asset(ext).alias("is_static_asset")]
    if "parsed_timestamp" in have:
        cols += enrich.time_dimensions("parsed_timestamp")
    return bronze.select(*cols)
