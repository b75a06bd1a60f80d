import __spark_entry__ as e


def test_entry_is_stable(spark):
    a, b = e.entry(spark), e.entry(spark)
    assert a.schema == b.schema and a.count() == b.count()


def test_every_oracle_has_a_query():
    assert set(e.oracle_sql()) <= set(e.queries())


def test_core_stands_alone(monkeypatch):
    """Without the llm subpackage the core queries remain."""
    import importlib

    real = importlib.import_module

    def gone(name, *a):
        if name.startswith("difframe.llm"):
            raise ModuleNotFoundError("No module named 'difframe.llm'", name="difframe.llm")
        return real(name, *a)

    monkeypatch.setattr(importlib, "import_module", gone)
    names = e.queries()
    assert "hanawalt_search" in names and "p1_found" in names and "p2_found" not in names and set(e.oracle_sql()) <= set(names)
