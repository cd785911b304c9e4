"""Bronze -> Silver -> Gold job, gold-or-recompute, and I/O helpers."""

import os

import pytest

from logbeam.plans import medallion
from logbeam.session import scratch_path
from logbeam.sources import files

from .conftest import SAMPLE_LINES


def test_run_medallion(spark, text_dir):
    out = scratch_path(spark, "t-medallion")
    res = medallion.run_medallion(spark, text_dir(SAMPLE_LINES + ["junk"]), out, log_format="combined")
    assert res["status"] == "success", res
    assert res["rows"] == {"bronze": 10, "silver": 10}
    assert res["metrics_count"] == 7
    assert res["metrics"]["summary"].first()["total_requests"] == 10
    assert res["metrics"]["peak_error"].collect()[0]["day_name"] == "Friday"
    silver = files.read_silver(spark, res["silver_output"])
    assert dict(silver.dtypes)["date"] == "string"
    # the unparsed line lands in the NULL-date partition and reads back as NULL
    assert silver.where("date IS NULL").count() == 1
    assert sorted(os.listdir(res["silver_output"].replace("file:", ""))).count("date=2024-03-01") == 1


def test_run_medallion_error_dict(spark, text_dir):
    res = medallion.run_medallion(spark, text_dir(SAMPLE_LINES), scratch_path(spark, "t-err"), log_format="bogus")
    assert res["status"] == "error" and "bogus" in res["error"]


def test_gold_or_recompute(spark, sample_silver, text_dir):
    out = scratch_path(spark, "t-gold")
    res = medallion.run_medallion(spark, text_dir(SAMPLE_LINES), out, log_format="combined")
    written = medallion.gold_or_recompute(spark, "top_ips", res["gold_output"], sample_silver)
    recomputed = medallion.gold_or_recompute(spark, "top_ips", scratch_path(spark, "missing"), sample_silver)
    assert sorted(written.collect()) == sorted(recomputed.collect())
    with pytest.raises(ValueError):
        medallion.gold_or_recompute(spark, "nope", None, sample_silver)


def test_silver_partition_pruning_in_plan(spark, sample_silver):
    path = scratch_path(spark, "t-prune")
    files.write_silver(sample_silver, path)
    plan = files.read_silver(spark, path).where("date = '2024-03-01'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_generic_roundtrip_and_append(spark, sample_silver):
    base = scratch_path(spark, "t-rt")
    for fmt in ("csv", "json", "orc", "parquet"):
        opts = {"header": "true"} if fmt == "csv" else None
        files.write(sample_silver.select("ip", "url"), f"{base}/{fmt}", fmt, options=opts)
        back = files.read(spark, f"{base}/{fmt}", fmt, options=opts)
        assert sorted(back.select("ip", "url").collect()) == sorted(sample_silver.select("ip", "url").collect())
    files.write_parquet(sample_silver, f"{base}/app")
    files.write_parquet(sample_silver, f"{base}/app", mode="append")
    assert files.read_parquet(spark, f"{base}/app").count() == 18
    assert files.path_exists(spark, f"{base}/app") and not files.path_exists(spark, f"{base}/none")


def test_jdbc_argument_checks(spark, sample_silver):
    with pytest.raises(ValueError):
        files.read_jdbc(spark, "jdbc:none", table="t", query="select 1")
    with pytest.raises(ValueError):
        files.read_jdbc(spark, "jdbc:none", table="t", partition_column="id")
    with pytest.raises(ValueError):
        files.write_jdbc(sample_silver, None, "t")


def test_write_gold_skips_failing_jdbc(spark, sample_silver):
    from logbeam.operators import gold

    # no JDBC driver for this url: every table fails, is logged and skipped
    failures = medallion.write_gold({"summary": gold.summary(sample_silver)}, None, "jdbc:nosuchdb://x", {"driver": "no.such.Driver"})
    assert set(failures) == {"summary"}


def test_write_gold_fills_jdbc_from_the_written_table(spark, sample_silver, monkeypatch):
    from logbeam.operators import gold

    seen = []
    monkeypatch.setattr(files, "write_jdbc", lambda df, url, table, **_: seen.append((table, df.inputFiles() != [])))
    assert medallion.write_gold({"summary": gold.summary(sample_silver)}, scratch_path(spark, "t-jdbc"), "jdbc:x") == {}
    assert seen == [("gold_summary_metrics", True)]


def test_missing_driver_is_found_out_once(spark, text_dir):
    res = medallion.run_medallion(spark, text_dir(SAMPLE_LINES), scratch_path(spark, "t-drv"), "combined", jdbc_url="jdbc:nosuchdb://x",
                                  jdbc_properties={"driver": "no.such.Driver"})
    assert res["status"] == "success" and res["db_available"] is False
    assert res["db_save_attempted"] is False and res["db_failures"] == {}
    assert medallion.jdbc_driver_available(spark, {"driver": "java.lang.String"}) and medallion.jdbc_driver_available(spark)


def test_gold_answers_honour_top_n_and_need_a_finished_write(spark, sample_silver):
    import shutil

    from logbeam.operators import gold

    out = scratch_path(spark, "t-ans")
    medallion.write_gold(gold.gold_tables(sample_silver, top_n=2), out)
    rows = medallion.top_ips_answer(spark, out, sample_silver, 2).collect()
    assert [r.asDict() for r in rows] == [{"ip": "198.51.100.23", "count": 3}, {"ip": "203.0.113.8", "count": 3}]
    assert medallion.top_ips_answer(spark, out, sample_silver, 1).count() == 1
    assert medallion.top_ips_answer(spark, out, sample_silver, 4).count() == 4  # more than stored: recomputed
    assert medallion.summary_metric_answer(spark, out, sample_silver, "median_bytes").first()["metric_value"] == 105.5
    assert medallion.summary_metric_answer(spark, None, sample_silver, "max_bytes").first()["metric_value"] == 7000.0
    # a folder without a finished write does not count
    shutil.copytree(f"{out}/top_ips", f"{out}/top_endpoints", dirs_exist_ok=True)
    unfinished = scratch_path(spark, "t-unf")
    sample_silver.limit(0).write.parquet(f"{unfinished}/top_ips")
    files.delete_path(spark, f"{unfinished}/top_ips/_SUCCESS")
    assert medallion.top_ips_answer(spark, unfinished, sample_silver, 3).count() == 3


def test_files_per_date_are_bounded_without_adaptive_execution(spark, sample_silver):
    from pathlib import Path

    many = sample_silver.crossJoin(spark.range(200).withColumnRenamed("id", "n")).repartition(16)
    for adaptive in ("true", "false"):
        before = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        try:
            path = scratch_path(spark, "t-split")
            files.write_silver(many, path, splits=3)
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", before)
        parts = list(Path(path.removeprefix("file:")).glob("date=2024-03-01/*.parquet"))
        assert 1 <= len(parts) <= 3, adaptive
        assert adaptive == "true" or len(parts) > 1  # a hot date is dealt over several tasks
        assert files.read_silver(spark, path).count() == 1800


def test_analyze_logs_registers_view_and_writes(spark, sample_silver):
    tables = medallion.analyze_logs(sample_silver)
    assert set(tables) == {"summary", "top_ips", "top_endpoints", "error_analysis", "peak_traffic", "peak_error", "summary_kv"}
    assert spark.sql("SELECT count(*) FROM logs").first()[0] == 9
    out = scratch_path(spark, "t-analyze")
    written = medallion.analyze_logs(sample_silver, output_path=out)
    assert files.path_exists(spark, f"{out}/peak_traffic")
    assert written["peak_traffic"].collect()[0]["requests"] == 4


def test_silver_dynamic_partition_overwrite(spark, lines_df):
    from logbeam.operators.layers import to_bronze, to_silver

    day = '10.0.0.1 - - [{d}/Mar/2025:10:00:00 +0000] "GET /x HTTP/1.1" 200 {n} "-" "c"'
    first = to_silver(to_bronze(lines_df([day.format(d="14", n=1), day.format(d="15", n=2)]), "combined"))
    again = to_silver(to_bronze(lines_df([day.format(d="15", n=5)]), "combined"))
    path = scratch_path(spark, "t-dyn")
    files.write_silver(first, path)
    files.write_silver(again, path, dynamic_overwrite=True)
    got = sorted((r["date"], r["bytes_sent_int"]) for r in files.read_silver(spark, path).collect())
    assert got == [("2025-03-14", 1), ("2025-03-15", 5)]
    files.write_silver(again, path)  # static overwrite replaces the whole table
    assert files.read_silver(spark, path).count() == 1


def test_silver_write_rebalance_flag(spark, sample_silver):
    def written_rows(rebalance):
        path = scratch_path(spark, "t-reb")
        df = sample_silver
        files.write_silver(df, path, rebalance=rebalance)
        return files.read_silver(spark, path).count()

    assert written_rows(True) == written_rows(False) == 9


def test_auto_reads_the_text_once(spark, text_dir, monkeypatch):
    """Detection looks at the first lines only; the pass that parses counts."""
    from logbeam.operators import layers

    common = ['10.0.0.1 - - [14/Mar/2025:10:00:00 +0000] "GET /x HTTP/1.1" 200 5'] * 9
    detect, asked = layers.detect_format, []
    monkeypatch.setattr(layers, "detect_format", lambda lines, n=None, **k: asked.append(n) or detect(lines, n, **k))
    for lines, guess, want in ((SAMPLE_LINES, 1000, "apache_combined"), (common, 1000, "apache_common"),
                               (SAMPLE_LINES[:2] + common, 2, "apache_common"), (["# h"] * 3 + SAMPLE_LINES, 2, "apache_combined"), (["junk"], 5, "apache_common")):
        path = scratch_path(spark, "t-auto")
        src = text_dir(lines)
        assert layers.write_bronze(spark, src, path, "auto", guess_lines=guess) == (want, len(lines))
        got = files.read_parquet(spark, path)
        plain = layers.to_bronze(files.read_text(spark, src), want)
        assert got.columns == plain.columns and sorted(got.collect(), key=repr) == sorted(plain.collect(), key=repr)
    assert asked == [1000, 1000, 2, 2, 5]
