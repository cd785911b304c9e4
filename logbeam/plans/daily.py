"""Gold from states by date (L3): a date is aggregated once.

``DailyStates`` keeps the states of ``operators.states`` under one folder,
each partitioned by ``date``.  ``refresh`` aggregates the dates of Silver that
have no finished state and replaces exactly their partitions; ``answer`` merges
what is stored with the states of the dates that are not, so it reads Silver
only for those.  A date counts as stored once its marker is written, after the
partitions themselves, so a run that broke off leaves nothing half done.

Rows without a date are a partition of their own.  ``forget`` drops the
markers of dates whose Silver was replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold, states
from ..sources import files

#: The folder value of rows without a date.
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
MARKERS = "_stored"

#: The states each Gold table is merged from, and how.
ANSWERS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "summary": (("client_days",), states.summary),
    "top_ips": (("client_days",), states.top_ips),
    "top_endpoints": (("endpoint_days",), states.top_endpoints),
    "error_analysis": (("error_days",), states.error_analysis),
    "peak_traffic": (("hour_days",), states.peak_traffic),
    "peak_error": (("weekday_days",), states.peak_error),
    "summary_kv": (("client_days", "size_days"), lambda c, s: gold.key_values(states.summary(c), states.size_counts(s))),
    "approximate_summary": (("sketch_days",), states.approximate_summary),
    "approximate_size_stats": (("sketch_days",), states.approximate_size_stats),
}
RANKED = ("top_ips", "top_endpoints")


def silver_dates(spark: SparkSession, silver_path: str) -> set[str]:
    """The date partitions of a stored Silver, as their folders name them."""
    prefix = f"{files.SILVER_PARTITION}="
    return {unquote(p.rsplit("/", 1)[1].removeprefix(prefix)) for p in files.children(spark, silver_path, prefix)}


def _is_in(dates: Iterable[str]) -> Column:
    """Rows of these dates; a filter on the partition column alone."""
    date = F.col(files.SILVER_PARTITION)
    named = sorted(set(dates) - {NO_DATE})
    found = date.isin(named) if named else F.lit(False)
    return (found | date.isNull()) if NO_DATE in dates else found


class DailyStates:
    """The states of one Silver, kept by date under ``path``."""

    def __init__(self, spark: SparkSession, silver_path: str, path: str) -> None:
        self.spark, self.silver_path, self.path = spark, silver_path, path.rstrip("/")

    def _marker(self, state: str, date: str) -> str:
        return f"{self.path}/{state}/{MARKERS}/{date}"

    def stored(self, state: str) -> set[str]:
        """Dates whose state is finished."""
        folder = f"{self.path}/{state}/{MARKERS}"
        if not files.path_exists(self.spark, folder):
            return set()
        return {p.rsplit("/", 1)[1] for p in files.children(self.spark, folder)}

    def missing(self, state: str) -> set[str]:
        return silver_dates(self.spark, self.silver_path) - self.stored(state)

    def _computed(self, state: str, dates: Iterable[str]) -> DataFrame:
        silver = files.read_silver(self.spark, self.silver_path)
        return states.STATES[state](silver.where(_is_in(set(dates))))

    def refresh(self, state: str, dates: Iterable[str] | None = None) -> set[str]:
        """Aggregate the missing dates (or ``dates``, stored or not) and store
        them; other dates stay as they are.  Returns the dates done."""
        todo = self.missing(state) if dates is None else set(dates)
        if not todo:
            return todo
        files.write_parquet(
            self._computed(state, todo), f"{self.path}/{state}/rows", partition_by=[files.SILVER_PARTITION], dynamic_overwrite=True, splits=1)
        for date in sorted(todo):
            files.touch(self.spark, self._marker(state, date))
        return todo

    def forget(self, dates: Iterable[str]) -> None:
        """The states of these dates are to be computed again."""
        for state in states.STATES:
            for date in dates:
                files.delete_path(self.spark, self._marker(state, date))

    def table(self, state: str) -> DataFrame:
        """The state over all dates of Silver: stored ones from the store, the
        others from Silver."""
        have = self.stored(state) & silver_dates(self.spark, self.silver_path)
        lacking = silver_dates(self.spark, self.silver_path) - have
        parts = []
        if have and files.path_exists(self.spark, f"{self.path}/{state}/rows"):
            rows = files.read_silver(self.spark, f"{self.path}/{state}/rows", self._computed(state, have).schema)
            parts.append(rows.where(_is_in(have)))
        if lacking or not parts:
            parts.append(self._computed(state, lacking))
        return states.united([p.select(*sorted(p.columns)) for p in parts])

    def answer(self, name: str, top_n: int = gold.TOP_N) -> DataFrame:
        """A Gold table merged from the states of all dates."""
        if name not in ANSWERS:
            raise ValueError(f"unknown gold table {name!r}; known: {sorted(ANSWERS)}")
        needed, merge = ANSWERS[name]
        tables = [self.table(s) for s in needed]
        return merge(*tables, top_n) if name in RANKED else merge(*tables)
