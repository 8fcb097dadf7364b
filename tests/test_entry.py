"""The driver contract, and that nothing but the entry knows the llm subpackage."""

from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(__file__).parent.parent


def test_contract(spark):
    queries, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(queries) and len(queries) > 40
    assert entry.entry(spark).columns == ["story", "representative", "members"]


def test_only_the_entry_names_llm():
    others = [p for p in ROOT.glob("millrace/**/*.py") if "llm" not in p.parts] + list(ROOT.glob("tests/*.py"))
    assert [p.name for p in others if "millrace.llm" in p.read_text() and p.name != Path(__file__).name] == []


def test_stored_tables_are_dropped(spark):
    from millrace import tables

    path = tables.stored(spark.range(3)).inputFiles()[0].removeprefix("file://")
    import os

    assert os.path.exists(path)
    tables.drop_stored(spark)
    assert not os.path.exists(path)
