from __future__ import annotations

from types import SimpleNamespace

import pytest

from earshot.session import cut, release, workspace


def fake(master, folder):
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, other=None: folder), sparkContext=SimpleNamespace(master=master))


def test_workspace_is_the_shared_folder():
    assert workspace(fake("spark://host:7077", "file:///shared/x/")) == "file:///shared/x"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace(fake("spark://host:7077", None))


def test_cut_keeps_rows_types_and_nulls_and_is_released(spark):
    df = spark.createDataFrame([(1, "a", [1.5]), (2, None, None)], "i bigint, s string, a array<double>")
    kept = cut(df)
    assert kept.dtypes == df.dtypes and sorted(kept.collect()) == sorted(df.collect()) and cut(df.limit(0)).count() == 0
    assert release(spark) and not release(spark)
    with pytest.raises(Exception, match="exist|FileNotFound"):
        kept.collect()
