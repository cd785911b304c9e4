from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"

# Nine Apache Combined lines over midnight, one edge rule each: a query string in front of a name, no
# size, an offset into the day before (twice), an upper-case extension, a static file, the same with a
# query string and a decimal size, client errors on both days, an extension outside the static list.
# The golden values are derived by hand from them.
SAMPLE_LINES = [
    '198.51.100.23 - - [29/Feb/2024:22:47:31 +0000] "GET /reports/2024?fmt=pdf HTTP/2.0" 200 900 "-" "curl/8.5"',
    '203.0.113.8 - maria [29/Feb/2024:22:51:02 +0000] "DELETE /cart/9 HTTP/1.1" 503 - "https://shop.test/cart" "Opera/9.8"',
    '203.0.113.8 - maria [01/Mar/2024:01:20:40 +0200] "GET /img/LOGO.PNG HTTP/1.1" 200 3300 "https://shop.test/" "Opera/9.8"',
    '192.0.2.77 - - [29/Feb/2024:23:58:59 +0000] "GET /theme.css HTTP/1.1" 304 0 "https://shop.test/" "Safari/17"',
    '192.0.2.77 - - [01/Mar/2024:00:03:08 +0000] "GET /theme.css?v=5 HTTP/1.1" 200 150.9 "https://shop.test/" "Safari/17"',
    '203.0.113.8 - maria [01/Mar/2024:00:15:26 +0000] "POST /cart HTTP/1.1" 422 61 "https://shop.test/cart" "Opera/9.8"',
    '198.51.100.23 - - [01/Mar/2024:05:44:13 +0545] "GET /cart/9 HTTP/2.0" 404 61 "-" "curl/8.5"',
    '203.0.113.250 - - [01/Mar/2024:00:59:59 +0000] "HEAD /fonts/a.woff2 HTTP/1.1" 200 7000 "-" "Probe/1"',
    '198.51.100.23 - - [01/Mar/2024:00:30:00 +0000] "GET /cart/9 HTTP/2.0" 404 44 "-" "curl/8.5"',
]


def line_at(stamp: str, status: int = 200, size: int = 10) -> str:
    """A combined line of one time, as ``14/Mar/2025:10:00:00 +0000``."""
    return f'10.0.0.9 - - [{stamp}] "GET /home HTTP/1.1" {status} {size} "-" "curl/8.5"'


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    s = (
        SparkSession.builder.master("local[*]")
        .appName("logbeam-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    # spark.checkpoint.dir is read from the session; logbeam registers its
    # own folder only when the session has none (checkpoint_root).
    yield s


@pytest.fixture
def lines_df(spark):
    def make(lines):
        return spark.createDataFrame([(v,) for v in lines], "value string")

    return make


@pytest.fixture
def sample_silver(spark, lines_df):
    from logbeam.operators.layers import to_bronze, to_silver

    return to_silver(to_bronze(lines_df(SAMPLE_LINES), "apache_combined"))


@pytest.fixture
def text_dir(spark):
    """Write lines as a text file in a fresh folder; return the folder."""

    def make(lines, name="in"):
        d = Path(tempfile.mkdtemp(prefix=f"logbeam-{name}-"))
        (d / "part-0.txt").write_text("\n".join(lines) + ("\n" if lines else ""))
        return str(d)

    return make
