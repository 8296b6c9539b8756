"""Each query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from loomstead.plans import catalog
from tests.conftest import DATA
from tests.oracle import differences

SQL = catalog.oracle_sql()


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, name):
    df = catalog.queries()[name](spark, DATA)
    if name in SQL:
        assert not differences(df, SQL[name], DATA)
    else:
        assert df.count() >= 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "content_hash" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_the_rest_doesnt_need_the_subpackage():
    import pathlib
    import re

    root = pathlib.Path(entry.__file__).parent / "loomstead"
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"(from|import) loomstead\.llm", p.read_text()), p
