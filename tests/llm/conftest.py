from __future__ import annotations

import pytest

from ..conftest import *  # noqa: F403  the shared session

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names clash with ones the operators use inside.
EXTRA = "rep string, key string, label string, pos string, size string, target string, words string"


@pytest.fixture
def docs(spark):
    """Documents from texts (ids by place) or (doc_id, text) pairs."""

    def make(texts, extra=False):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(d, t, "en", f"s{(d or 0) % 3}", None if t is None else len(t)) + ("x",) * (7 * extra) for d, t in pairs]
        return spark.createDataFrame(rows, DOCS + (", " + EXTRA if extra else ""))

    return make


def rows_by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}
