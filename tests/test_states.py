"""States by date: merges, sketches, and the store."""

import duckdb
import pytest
from pyspark.sql import functions as F

from logbeam.operators import gold, heavy, questions, states
from logbeam.operators.layers import to_bronze, to_silver
from logbeam.plans import catalog, daily
from logbeam.session import scratch_path
from logbeam.sources import files

from .conftest import SAMPLE_LINES, SF_ORACLE, line_at
from .test_plans import plan_of

ALL_STATES = ("client_days", "endpoint_days", "error_days", "hour_days", "weekday_days", "size_days")


@pytest.fixture(scope="module")
def silver_path(spark):
    return catalog.stored_silver(spark, SF_ORACLE)


@pytest.fixture
def kept(spark, silver_path):
    return daily.DailyStates(spark, silver_path, scratch_path(spark, "t-states"))


def rounded(df):
    """The rows, doubles to twelve digits, in a fixed order."""
    return sorted((tuple(float(f"{v:.12g}") if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def lines_silver(spark, lines):
    return to_silver(to_bronze(spark.createDataFrame([(v,) for v in lines], "value string"), "combined"))


def test_distinct_counts_without_expanded_rows(spark, silver_path):
    silver = files.read_silver(spark, silver_path)
    for table in (gold.summary(silver), gold.error_analysis(silver)):
        assert "Expand" not in plan_of(table)
    # the one expansion left turns the summary's single row into rows
    assert "gid" not in plan_of(gold.summary_kv(silver))


def test_both_kinds_of_distinct_counts_share_one_shuffle(spark, silver_path):
    table = gold.summary(files.read_silver(spark, silver_path))
    table.collect()
    assert "ReusedExchange" in table._jdf.queryExecution().executedPlan().toString()


def test_summary_of_nothing_and_of_junk(spark):
    assert tuple(gold.summary(lines_silver(spark, [])).first()) == (0, 0, 0, None, None, None)
    assert tuple(gold.summary(lines_silver(spark, ["junk", "junk"])).first()) == (2, 1, 0, None, None, None)
    assert tuple(gold.size_stats(lines_silver(spark, []), approximate=True).first()) == (None,) * 5
    assert tuple(gold.size_stats(lines_silver(spark, ["junk"]), approximate=True).first()) == (None,) * 5


def test_states_merge_to_the_same_gold(spark, kept):
    """Half of the dates stored, half aggregated now."""
    half = sorted(daily.silver_dates(spark, kept.silver_path))[::2]
    for state in ALL_STATES:
        assert kept.refresh(state, half) == set(half)
    want = gold.gold_tables(files.read_silver(spark, kept.silver_path))
    for name, table in want.items():
        assert rounded(kept.answer(name)) == rounded(table), name


def test_stored_dates_are_not_read_again(spark):
    """The answer stays whole when the Silver files of stored dates are gone."""
    silver = lines_silver(spark, SAMPLE_LINES + ["junk"])
    path = scratch_path(spark, "t-half")
    files.write_silver(silver, path)
    kept = daily.DailyStates(spark, path, scratch_path(spark, "t-half-states"))
    kept.refresh("client_days", ["2024-02-29", daily.NO_DATE])
    assert kept.missing("client_days") == {"2024-03-01"}
    for p in files.children(spark, f"{path}/date=2024-02-29", "part-"):
        files.delete_path(spark, p)
    assert tuple(kept.answer("summary").first())[:3] == (10, 5, 2)
    plan = plan_of(kept.answer("top_ips"))
    assert "PartitionFilters" in plan and "2024-03-01" in plan
    assert kept.refresh("client_days") == {"2024-03-01"} and kept.missing("client_days") == set()
    kept.forget(["2024-03-01"])
    assert kept.missing("client_days") == {"2024-03-01"} and kept.missing("hour_days") == {"2024-02-29", "2024-03-01", daily.NO_DATE}


def test_a_replaced_date_replaces_its_state(spark):
    path = scratch_path(spark, "t-again")
    files.write_silver(lines_silver(spark, SAMPLE_LINES), path)
    kept = daily.DailyStates(spark, path, scratch_path(spark, "t-again-states"))
    kept.refresh("client_days")
    files.write_silver(lines_silver(spark, [line_at("01/Mar/2024:10:00:00 +0000")]), path, dynamic_overwrite=True)
    kept.forget(["2024-03-01"])
    assert kept.refresh("client_days") == {"2024-03-01"}
    assert tuple(kept.answer("summary").first())[:3] == (6, 4, 2)


def test_dates_without_rows_of_a_state_count_as_stored(spark):
    """No error that day: a marker, no rows; and a state with no rows at all."""
    path = scratch_path(spark, "t-none")
    files.write_silver(lines_silver(spark, [line_at("01/Mar/2024:10:00:00 +0000")]), path)
    kept = daily.DailyStates(spark, path, scratch_path(spark, "t-none-states"))
    kept.refresh("error_days")
    assert kept.missing("error_days") == set() and kept.answer("error_analysis").collect() == []
    with pytest.raises(ValueError):
        kept.answer("nope")


def test_sketches_against_exact_quantiles(spark, kept):
    """Estimates of merged daily sketches lie between DuckDB's exact quantiles
    at the probabilities the rank error allows."""
    kept.refresh("sketch_days")
    got = {r.probability: r.value for r in states.approximate_quantiles(kept.table("sketch_days"), catalog.PROBABILITIES).collect()}
    sizes = files.read_silver(spark, kept.silver_path).select(F.expr("try_cast(regexp_replace(size, '\\\\..*', '') as int)").alias("x")).where("x is not null")
    con = duckdb.connect()
    con.register("sizes", sizes.toPandas())
    for p, value in got.items():
        lo, hi = (min(max(p + d, 0.0), 1.0) for d in (-states.KLL_ERROR, states.KLL_ERROR))
        low, high = con.execute(f"SELECT quantile_disc(x, {lo}), quantile_disc(x, {hi}) FROM sizes").fetchone()
        assert low <= value <= high, p


def test_rank_errors(spark):
    counts = spark.createDataFrame([(10, 5), (20, 5)], "value int, n bigint")
    guess = spark.createDataFrame([(0.5, 10), (0.9, 10), (0.1, 20)], "probability double, value bigint")
    got = {r.probability: r.rank_error for r in states.rank_errors(guess, counts).collect()}
    assert got == pytest.approx({0.5: 0.0, 0.9: 0.4, 0.1: 0.4})


def test_visitor_sketch_of_many(spark):
    days = spark.range(200_000).select(
        F.concat(F.lit("d"), (F.col("id") % 7).cast("string")).alias("date"), (F.col("id") % 60_000).cast("string").alias("ip"),
        F.lit(1).alias("bytes_sent_int"), F.lit(200).alias("status_int"), F.lit("1").alias("size"))
    got = states.approximate_summary(states.sketch_days(days)).first()
    assert got.total_requests == 200_000 and got.days_span == 7
    assert abs(got.unique_visitors - 60_000) <= 60_000 * states.HLL_ERROR


def skewed(spark, keys=40_000):
    """A few heavy keys and many light ones, ties among both, and nulls."""
    heavy_rows = spark.range(30_000).select(F.concat(F.lit("h"), F.floor(F.sqrt(F.col("id") % 144)).cast("string")).alias("ip"))
    light = spark.range(keys).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("ip"))
    none = spark.range(5000).select(F.lit(None).cast("string").alias("ip"))
    return heavy_rows.union(light).union(none)


def shuffled_rows(df):
    """Rows written to shuffles by the last run of ``df``, from its plan's metrics."""
    df.collect()
    todo, total = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
    return total


@pytest.mark.parametrize("limit", [1, 5, 14, 30])
def test_heavy_keys_are_the_same_rows(spark, limit):
    df = skewed(spark)
    want = questions.top_ips_by_count(df, limit).collect()
    assert [tuple(r) for r in heavy.top(df, "ip", limit, []).collect()] == [tuple(r) for r in want]


def test_heavy_keys_shuffle_fewer_rows(spark):
    df = skewed(spark, 600_000).repartition(8)
    path = scratch_path(spark, "t-heavy")
    df.write.parquet(path)
    stored = spark.read.parquet(path)
    plain, pruned = shuffled_rows(questions.top_ips_by_count(stored, 5)), shuffled_rows(heavy.possible(stored, "ip", 5).groupBy("ip").count())
    light = heavy.possible(stored, "ip", 5).select("ip").distinct().count()
    assert light < 1000 and plain > 600_000
    assert pruned < plain / 2  # at most the fixed table of buckets, once per task


def test_heavy_of_few_rows(spark):
    df = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "ip string")
    assert [tuple(r) for r in heavy.top(df, "ip", 10, []).collect()] == [("a", 2), (None, 1), ("b", 1)]
    assert heavy.top(df.limit(0), "ip", 3, []).collect() == []
