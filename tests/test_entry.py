"""The driver's contract."""

import pathlib

import __spark_entry__ as entry


def test_entry_has_a_stable_schema(spark, monkeypatch, data):
    monkeypatch.setattr(entry, "SMOKE", data)
    df = entry.entry(spark)
    assert df.columns == entry.entry(spark).columns and df.count() > 0


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_core_never_imports_the_text_subpackage():
    root = pathlib.Path(entry.__file__).parent / "codexmill"
    core = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts]
    assert core and not any("codexmill.llm" in p.read_text(encoding="utf-8") for p in core)
