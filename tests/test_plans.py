"""Physical-plan properties of every registered query (scale guards).

Checked on the executed plan string: no cartesian products or nested-loop
joins, no Python UDF operators, the events scan never reads unused columns,
top-k is TakeOrderedAndProject, aggregates are partial before each shuffle,
and the only joins are broadcast joins against bounded dimension rows.
"""

import re

import pytest

from logbeam.plans import catalog

from .conftest import SF_SMALL

TOP_K = {"gold_top_ips", "gold_top_endpoints", "gold_peak_error", "top10_ips", "top6_endpoints", "top5_urls",
         "gold_or_recompute", "top_ips_from_gold", "top_ips_beyond_gold"}
# At most two rows of a bucket level, seven weekdays, the bins, or a fixed number of hash buckets are broadcast.
BOUNDED_JOINS = {"client_errors_all_weekdays", "size_histogram", "size_stats", "summary_kv", "gold_by_date", "heavy_top_ips", "heavy_top_endpoints"}
# Queries that write first (their plan, or part of it, is a scan of what was written).
SINK_BACKED = {"src_text", "bronze_roundtrip", "append_roundtrip", "silver_partition_pruned", "medallion_gold", "layer_counts",
               "stream_silver", "windowed_traffic_stream", "src_formats_roundtrip", "top_ips_from_gold", "top_ips_beyond_gold",
               "metric_from_gold", "gold_by_date", "size_quantiles_by_sketch", "size_stats_by_sketch", "summary_by_sketch",
               "silver_dates_replaced", "heavy_top_ips", "heavy_top_endpoints", "final_windows_stream", "threshold_windows_stream"}


def plan_of(df) -> str:
    qe = df._jdf.queryExecution()
    return qe.executedPlan().toString() + "\n" + qe.optimizedPlan().toString()


@pytest.fixture(scope="module")
def built(spark):
    """Each query's DataFrame and the jobs that building it started."""
    sc = spark.sparkContext
    out = {}
    for key, fn in catalog.queries().items():
        sc.setJobGroup(f"plan-{key}", key)
        out[key] = fn(spark, SF_SMALL), len(sc.statusTracker().getJobIdsForGroup(f"plan-{key}"))
    sc.setLocalProperty("spark.jobGroup.id", None)
    return out


@pytest.fixture(scope="module")
def plans(built):
    return {key: plan_of(df) for key, (df, _) in built.items()}


@pytest.mark.parametrize("key", sorted(set(catalog.queries()) - SINK_BACKED))
def test_building_a_query_starts_no_job(built, key):
    assert built[key][1] == 0


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_no_cartesian_no_python(plans, key):
    p = plans[key]
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                "FlatMapGroupsInPandas", "MapInPandas"):
        assert bad not in p, f"{key}: {bad}"


@pytest.mark.parametrize("key", sorted(set(catalog.queries()) - SINK_BACKED))
def test_events_scan_is_pruned(plans, key):
    for s in re.findall(r"ReadSchema: struct<([^>]*)>", plans[key]):
        assert "props" not in s, f"{key} reads props: {s}"


def test_rendering_reads_only_used_columns(spark):
    from logbeam.sources import fixture

    p = plan_of(fixture.access_log_lines(fixture.read_events(spark, SF_SMALL)))
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert "props" not in schema and "event_id" in schema


def test_partial_aggregation_on_parquet_silver(spark, sample_silver):
    from logbeam.operators import gold
    from logbeam.session import scratch_path
    from logbeam.sources import files

    path = scratch_path(spark, "t-plan")
    files.write_silver(sample_silver, path)
    silver = files.read_silver(spark, path)
    p = plan_of(gold.top_endpoints(silver))
    assert "PushedFilters: [IsNotNull(is_static_asset), Not(EqualTo(is_static_asset,true))]" in p
    (schema,) = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert set(re.findall(r"(\w+):", schema)) == {"url", "status_int", "bytes_sent_int", "is_static_asset"}
    assert "partial_count" in p and "TakeOrderedAndProject" in p


@pytest.mark.parametrize("key", sorted(TOP_K))
def test_top_k_is_take_ordered(plans, key):
    assert "TakeOrderedAndProject" in plans[key]


def node_tree(plan: str) -> list[tuple[int, str]]:
    """(depth, text) of each node of a physical plan."""
    nodes = []
    for line in plan.splitlines():
        m = re.match(r"^([ :|+-]*)((?:\*\(\d+\) )?[A-Z]\w+.*)$", line)
        if m:
            nodes.append((len(m[1]), m[2]))
    return nodes


def below_each_exchange(plan: str) -> list[str]:
    """For every exchange by key: the node that feeds it."""
    nodes = node_tree(plan)
    return [nodes[i + 1][1] for i, (_, text) in enumerate(nodes[:-1]) if "Exchange hashpartitioning" in text and "ENSURE_REQUIREMENTS" in text]


@pytest.mark.parametrize("key", sorted(set(catalog.queries()) - SINK_BACKED))
def test_aggregates_are_partial_before_shuffle(built, key):
    """Every exchange by key is fed by an aggregate, the partial step of a
    grouped one or the result that a window runs over; nothing is shuffled row
    by row, and a final step stands above its partial one."""
    physical = built[key][0]._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[-1]
    for feed in below_each_exchange(physical):
        assert re.search(r"HashAggregate\(keys=", feed), (key, feed)
    for (_, text), (_, below) in zip(node_tree(physical), node_tree(physical)[1:]):
        if "HashAggregate(keys=[" in text and "HashAggregate(keys=[]" not in text and "Exchange hashpartitioning" in below:
            assert "partial_" not in text, (key, text)
    if "Exchange hashpartitioning" in physical:
        assert re.search(r"functions=\[(partial_|merge_|\])", physical), key


@pytest.mark.parametrize("key", sorted(catalog.queries()))
def test_only_bounded_broadcast_joins(plans, key):
    p = plans[key]
    joins = re.findall(r"(\w*Join)\b", p.split("\n")[0] + "\n" + p)
    physical = [j for j in joins if j.endswith("HashJoin") or j == "SortMergeJoin"]
    if key in BOUNDED_JOINS:
        assert all(j == "BroadcastHashJoin" for j in physical), (key, physical)
    else:
        assert not physical, (key, physical)
