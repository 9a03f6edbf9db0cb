from __future__ import annotations

import pytest

from earshot.plans.catalog import core_registry
from earshot.plans.registry import Registry


def test_names_are_unique_and_sql_has_queries():
    r = core_registry()
    assert set(r.sql) <= set(r.queries) and len(r.queries) > 200
    with pytest.raises(ValueError):
        r.update(r)
    assert isinstance(r, Registry)


def test_entry(spark):
    import os

    import __spark_entry__

    if not os.path.isdir("/root/testdata/sf0.001"):
        pytest.skip("no test tables")
    assert __spark_entry__.entry(spark).columns == ["threshold", "recall", "fah"]
