from __future__ import annotations

import __spark_entry__ as entry


def test_contract(spark):
    assert entry.entry(spark).count() > 0
    names = entry.queries()
    assert set(entry.oracle_sql()) <= set(names)
    assert len(names) >= 90


def test_library_does_not_use_the_llm_subpackage():
    import pathlib

    root = pathlib.Path(entry.__file__).parent / "lodestone"
    for path in root.rglob("*.py"):
        if "llm" not in path.parts:
            assert "lodestone.llm" not in path.read_text()
