"""The entry module with and without the training-data subpackage."""

import importlib.util

import __spark_entry__ as E
from logbeam.plans import catalog, oracle


def test_entry_works_without_the_training_data_operators(monkeypatch):
    real = importlib.util.find_spec
    monkeypatch.setattr(importlib.util, "find_spec", lambda name, *a: None if name in ("logbeam.llm", "corpus_pipeline") else real(name, *a))
    assert set(E.queries()) == set(catalog.queries())
    assert set(E.oracle_sql()) == set(oracle.oracle_sql())


def test_nothing_else_imports_the_subpackage():
    from pathlib import Path

    root = Path(E.__file__).parent
    for path in (root / "logbeam").rglob("*.py"):
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path
