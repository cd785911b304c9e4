"""Cross-operator invariants and the exact percentile against Spark's."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logbeam.functions import enrich
from logbeam.operators import gold, quantile, questions
from logbeam.plans import catalog

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def silver(spark):
    return catalog.silver(spark, SF_SMALL).cache()


def test_peak_traffic_sums_to_total(silver):
    total = gold.summary(silver).first()["total_requests"]
    assert gold.peak_traffic(silver).agg(F.sum("requests")).first()[0] == total


def test_weekday_errors_sum_to_client_errors(silver):
    n = silver.where((F.col("status_int") >= 400) & (F.col("status_int") < 500) & F.col("parsed_timestamp").isNotNull()).count()
    assert questions.client_errors_all_weekdays(silver).agg(F.sum("count")).first()[0] == n


def test_histogram_bins_sum_to_sized_rows(silver):
    n = silver.where(enrich.size_bytes("size").isNotNull()).count()
    h = questions.size_histogram(silver)
    assert h.count() == 50
    assert h.agg(F.sum("count")).first()[0] == n


def test_layer_counts_are_those_of_the_layers(silver):
    bronze = silver.select("ip", "url")
    got = dict(questions.layer_counts(bronze, silver.limit(100)).collect())
    assert got["bronze"] == silver.count() and got["silver"] == 100
    assert 0 < got["unparsed"] < got["bronze"] and got["no_timestamp"] <= 100


def test_windows_sum_to_timestamped_rows(silver):
    from logbeam.streaming.traffic import windowed_traffic

    n = silver.where(F.col("parsed_timestamp").isNotNull()).count()
    assert windowed_traffic(silver).agg(F.sum("requests")).first()[0] == n


@settings(max_examples=15, deadline=None)
@given(values=st.lists(st.one_of(st.none(), st.integers(-(2**31), 2**31 - 1), st.integers(-3, 3)), min_size=0, max_size=60))
def test_median_and_statistics_match_spark(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    counts = quantile.value_counts(df, F.col("x"))
    (got,) = quantile.median(counts).first()
    want = df.agg(F.percentile("x", 0.5)).first()[0]
    assert got == want if want is None else got == pytest.approx(want, rel=1e-12, abs=1e-9)
    nn = [v for v in values if v is not None]
    st_row = quantile.statistics(counts).first()
    assert tuple(st_row)[:3] == ((sum(nn), max(nn), min(nn)) if nn else (None, None, None))


def test_median_of_skewed_values(spark):
    rnd = random.Random(7)
    vals = [5] * 3000 + [rnd.randint(0, 10**6) for _ in range(6000)] + [-(2**31), 2**31 - 1]
    df = spark.createDataFrame([(v,) for v in vals], "x int")
    want = df.agg(F.percentile("x", 0.5)).first()[0]
    assert quantile.median(quantile.value_counts(df, F.col("x"))).first()[0] == pytest.approx(want)


def test_metric_lookup_equals_the_whole_summary(silver):
    kv = {r["metric_name"]: r["metric_value"] for r in gold.summary_kv(silver).collect()}
    assert list(kv) == gold.SUMMARY_METRICS
    for name in gold.SUMMARY_METRICS:
        assert gold.summary_metric(silver, name).collect() == [(name, kv[name])]
    with pytest.raises(ValueError):
        gold.summary_metric(silver, "nope")
