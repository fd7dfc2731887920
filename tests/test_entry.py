import importlib

import pytest

import __spark_entry__


def test_without_the_optional_parts(monkeypatch):
    real = importlib.import_module

    def missing(name, *a):
        if name.startswith(("lorebase.llm", "corpus_pipeline")):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name.rpartition(".")[0] or name)
        return real(name, *a)

    monkeypatch.setattr(importlib, "import_module", missing)
    entry = importlib.reload(__spark_entry__)
    assert "search_all" in entry.queries() and not any(q.startswith("op") or q == "pipeline" for q in entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    monkeypatch.undo()
    importlib.reload(__spark_entry__)


def test_other_import_errors_are_not_hidden(monkeypatch):
    def broken(name, *a):
        raise ModuleNotFoundError("No module named 'numpy'", name="numpy")

    monkeypatch.setattr(importlib, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        importlib.reload(__spark_entry__)
    monkeypatch.undo()
    importlib.reload(__spark_entry__)
