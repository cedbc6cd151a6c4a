"""Every registered query against its SQL, and those without SQL for rows and a stable schema."""

from __future__ import annotations

import pytest

from tests import oracle
from termloom.plans import catalog, catalog_more  # noqa: F401

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    assert oracle.compare(spark, catalog.QUERIES[name], catalog.ORACLES[name], SMALL) > 0


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)


def test_contract(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["doc_id", "sent_id", "cs", "term", "features"]
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(catalog.QUERIES) <= set(e.queries())


def test_entry_is_imported_without_a_session():
    """The driver, and Python workers, import modules before there is a session, or where there never is one."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(catalog.__file__).parents[2]
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    said = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    queries, oracles = map(int, said.stdout.split()[-2:])
    assert queries > 100 and oracles > 90


def test_nothing_outside_the_subpackage_imports_it():
    from pathlib import Path

    top = Path(catalog.__file__).parents[1]
    for p in top.rglob("*.py"):
        if "llm" not in p.relative_to(top).parts:
            assert "llm" not in p.read_text(), p
