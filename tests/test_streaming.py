"""Streaming results equal batch results."""


from logbeam.operators.layers import to_bronze, to_silver
from logbeam.session import scratch_path
from logbeam.sources import files
from logbeam.streaming import traffic

from .conftest import SAMPLE_LINES, line_at

LATE = [line_at("14/Mar/2025:12:10:00 +0000", 500), line_at("14/Mar/2025:12:20:00 +0000")]


def test_stream_silver_equals_batch(spark, text_dir, lines_df):
    src = text_dir(SAMPLE_LINES + ["junk"])
    out = scratch_path(spark, "t-ss")
    traffic.stream_silver(spark, src, out, scratch_path(spark, "t-ss-ck"), "apache_combined")
    got = files.read_silver(spark, out).drop("parsed_timestamp")
    want = to_silver(to_bronze(lines_df(SAMPLE_LINES + ["junk"]), "apache_combined")).drop("parsed_timestamp")
    cols = sorted(want.columns)
    assert sorted(got.select(cols).collect(), key=repr) == sorted(want.select(cols).collect(), key=repr)


def test_stream_windows_equal_batch_over_several_batches(spark, lines_df):
    import tempfile
    from pathlib import Path

    d = Path(tempfile.mkdtemp(prefix="logbeam-win-"))
    (d / "a.txt").write_text("\n".join(SAMPLE_LINES) + "\n")
    (d / "b.txt").write_text("\n".join(LATE) + "\n")
    out = scratch_path(spark, "t-win")
    traffic.stream_windowed_traffic(spark, str(d), out, scratch_path(spark, "t-win-ck"), "apache_combined",
                                    max_files_per_trigger=1)
    got = traffic.read_windowed_traffic(spark, out).collect()
    batch = traffic.windowed_traffic(to_silver(to_bronze(lines_df(SAMPLE_LINES + LATE), "apache_combined"))).collect()
    assert sorted(got) == sorted(batch)
    assert [r["window_start"] for r in got] == [
        "2024-02-29 22:00:00", "2024-02-29 23:00:00", "2024-03-01 00:00:00", "2025-03-14 12:00:00"]


def test_error_threshold(sample_silver):
    rows = traffic.error_threshold_windows(sample_silver, threshold=0.5).collect()
    assert rows == []
    rows = traffic.error_threshold_windows(sample_silver, threshold=0.4).collect()
    assert [(r["window_start"], r["errors"], r["error_ratio"]) for r in rows] == [
        ("2024-02-29 22:00:00", 1, 0.5), ("2024-03-01 00:00:00", 2, 0.5)]


def test_window_length_parameter(sample_silver):
    rows = traffic.windowed_traffic(sample_silver, minutes=30).collect()
    assert [r["requests"] for r in rows] == [2, 1, 2, 2, 2]
    assert rows[0]["window_end"] == "2024-02-29 23:00:00"


def _unordered(spark, n=6):
    """Files whose lines jump to and fro over two days."""
    import tempfile
    from pathlib import Path

    d = Path(tempfile.mkdtemp(prefix="logbeam-unordered-"))
    lines = []
    for k in range(n):
        hours = [(7 * k + 5 * i) % 48 for i in range(9)]
        own = [line_at(f"{14 + h // 24}/Mar/2025:{h % 24:02d}:0{i}:00 +0000", 200 + 100 * (i % 4)) for i, h in enumerate(hours)]
        (d / f"{k}.txt").write_text("\n".join(own) + "\n")
        lines += own
    return str(d), lines


def test_stream_windows_over_unordered_files_equal_batch(spark, lines_df):
    src, lines = _unordered(spark)
    out = scratch_path(spark, "t-unord")
    run = traffic.stream_windowed_traffic(spark, src, out, scratch_path(spark, "t-unord-ck"), "apache_combined", max_files_per_trigger=1)
    batch = sorted(traffic.windowed_traffic(to_silver(to_bronze(lines_df(lines), "apache_combined"))).collect())
    assert sorted(traffic.read_windowed_traffic(spark, out).collect()) == batch
    assert run.dropped_rows() == 0
    assert len(files.children(spark, out, "batch_id=")) >= 6
    traffic.compact_windowed_traffic(spark, out)
    assert len(files.children(spark, out, "batch_id=")) == 1
    assert sorted(traffic.read_windowed_traffic(spark, out).collect()) == batch


def test_a_watermark_counts_what_it_drops(spark):
    src, lines = _unordered(spark)
    out = scratch_path(spark, "t-late")
    run = traffic.stream_windowed_traffic(spark, src, out, scratch_path(spark, "t-late-ck"), "apache_combined",
                                          watermark="2 hours", max_files_per_trigger=1)
    kept = sum(r["requests"] for r in traffic.read_windowed_traffic(spark, out).collect())
    assert 0 < run.dropped_rows() and kept + run.dropped_rows() == len(lines)


def test_windows_of_a_clock_set_back_stay_apart(spark):
    """Two instants with one wall-clock time are two windows."""
    import tempfile
    from pathlib import Path

    d = Path(tempfile.mkdtemp(prefix="logbeam-dst-"))
    lines = [line_at(f"26/Oct/2025:{h}:30:00 +0000") for h in ("00", "01")]
    (d / "a.txt").write_text("\n".join(lines) + "\n")
    out = scratch_path(spark, "t-dst")
    traffic.stream_windowed_traffic(spark, str(d), out, scratch_path(spark, "t-dst-ck"), "apache_combined", tz="Europe/Berlin")
    got = [(r["window_start"], r["requests"]) for r in traffic.read_windowed_traffic(spark, out, tz="Europe/Berlin").collect()]
    assert got == [("2025-10-26 02:00:00", 1)] * 2


def test_stream_silver_is_clustered_by_date(spark, text_dir):
    from pathlib import Path

    src, lines = _unordered(spark, 12)
    out = scratch_path(spark, "t-clus")
    traffic.stream_silver(spark, src, out, scratch_path(spark, "t-clus-ck"), "apache_combined", splits=1)
    per_date = {p.name: len(list(p.glob("*.parquet"))) for p in Path(out.removeprefix("file:")).glob("date=*")}
    assert set(per_date.values()) == {1} and files.read_silver(spark, out).count() == len(lines)


def test_stream_silver_restart_from_checkpoint_is_exactly_once(spark):
    """Stop after the first file, add a second, restart with the same
    checkpoint: every line lands once (no reprocessing, no loss)."""
    import tempfile
    from pathlib import Path

    d = Path(tempfile.mkdtemp(prefix="logbeam-restart-"))
    (d / "a.txt").write_text("\n".join(SAMPLE_LINES) + "\n")
    out, ck = scratch_path(spark, "t-restart"), scratch_path(spark, "t-restart-ck")
    traffic.stream_silver(spark, str(d), out, ck, "apache_combined")
    assert files.read_silver(spark, out).count() == 9
    (d / "b.txt").write_text("\n".join(LATE) + "\n")
    traffic.stream_silver(spark, str(d), out, ck, "apache_combined")
    got = files.read_silver(spark, out)
    assert got.count() == 11 and got.select("value").distinct().count() == 11


def _final(spark, parts, **options):
    """Run the final-window stream after each part landed; the runs, the
    folders and every line."""
    import tempfile
    from pathlib import Path

    d = Path(tempfile.mkdtemp(prefix="logbeam-final-"))
    out, ck = scratch_path(spark, "t-final"), scratch_path(spark, "t-final-ck")
    runs = []
    for i, lines in enumerate(parts):
        (d / f"{i}.txt").write_text("\n".join(lines) + "\n")
        runs.append(traffic.stream_final_windows(spark, str(d), out, ck, "apache_combined", watermark="1 hour", **options))
    return runs, out, ck, str(d)


def hour(day, h, status=200, minute=5):
    return line_at(f"{day}/Mar/2025:{h:02d}:{minute:02d}:00 +0000", status)


def test_final_windows_are_emitted_once_and_late_rows_counted(spark, lines_df):
    ontime = [[hour(14, 1), hour(14, 1, 500), hour(14, 2)], [hour(14, 4), "junk"], [hour(14, 8)]]
    late = [hour(14, 1), hour(14, 2), hour(14, 7, 404), hour(14, 8, 404)]
    runs, out, ck, _ = _final(spark, [*ontime, late])
    final, still = traffic.final_windows(spark, out), traffic.open_windows(spark, ck)
    # 07:05 comes when the watermark stands at 07:05: its window is open
    want = [line for part in ontime for line in part] + late[2:]
    batch = traffic.windowed_traffic(to_silver(to_bronze(lines_df(want), "apache_combined"))).collect()
    assert sorted(final.collect() + still.collect()) == sorted(batch)
    assert [r.window_start[11:13] for r in final.collect()] == ["01", "02", "04"]
    assert [r.window_start[11:13] for r in still.collect()] == ["07", "08"]
    assert traffic.late_rows(runs, final, still).first()[0] == 2
    emitted = spark.read.parquet(out)
    assert emitted.count() == emitted.select("start").distinct().count()


def test_state_is_in_rocksdb_and_let_go(spark):
    from pathlib import Path

    runs, out, ck, _ = _final(spark, [[hour(14, h) for h in range(20)], [hour(15, 3)]])
    assert [r.window_start for r in traffic.open_windows(spark, ck).collect()] == ["2025-03-15 03:00:00"]
    state = Path(ck.removeprefix("file:")) / "state"
    assert list(state.rglob("*.zip")) or list(state.rglob("*.changelog"))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_alerts_are_final_and_a_retry_repeats_nothing(spark):
    from pathlib import Path

    parts = [[hour(14, 1, 500), hour(14, 1), hour(14, 2)], [hour(14, 5), hour(14, 6, 503)], [hour(14, 12)]]
    runs, out, ck, src = _final(spark, parts, threshold=0.4)
    alerts = [(r.window_start[11:13], r.errors) for r in traffic.final_windows(spark, out).collect()]
    assert alerts == [("01", 1), ("06", 1)]
    commits = Path(ck.removeprefix("file:")) / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for p in (commits / str(last), commits / f".{last}.crc"):
        p.unlink(missing_ok=True)  # as if the driver was lost before it noted the batch as done
    traffic.stream_final_windows(spark, src, out, ck, "apache_combined", watermark="1 hour", threshold=0.4)
    assert [(r.window_start[11:13], r.errors) for r in traffic.final_windows(spark, out).collect()] == alerts
