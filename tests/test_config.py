from __future__ import annotations

from dataclasses import dataclass

import pytest

from earshot.config import merged, resolved_path, section, with_environment
from earshot.sources.reports import bars, markdown, page


@dataclass
class Training:
    steps: int = 1
    rate: float = 0.1


def test_merge_keeps_its_arguments():
    base = {"a": {"x": 1, "y": [1, 2]}, "b": 2}
    assert merged(base, {"a": {"y": [3], "z": {"q": 1}}, "c": None}) == {"a": {"x": 1, "y": [3], "z": {"q": 1}}, "b": 2, "c": None}
    assert base == {"a": {"x": 1, "y": [1, 2]}, "b": 2}


def test_environment():
    env = {"ROOT": "/data", "EMPTY": ""}
    assert with_environment({"p": ["${ROOT}/x", "${NONE:-d}", "${NONE}", "${EMPTY:-d}", "${NONE:-}"], "n": 3}, env) == {"p": ["/data/x", "d", "${NONE}", "", ""], "n": 3}


def test_paths():
    at = lambda v: resolved_path(v, "/etc/app/presets/a.yaml", "/work")
    assert [at(v) for v in ("./out", "../b.yaml", "config/data.yaml", "/x/y.z", "plain", "https://h/x.y", "and/or")] == ["/work/out", "/etc/app/b.yaml", "/work/config/data.yaml", "/x/y.z", "plain", "https://h/x.y", "and/or"]


def test_unknown_fields():
    with pytest.warns(UserWarning, match="other"):
        assert section(Training, {"steps": 5, "other": 1}) == Training(5)
    with pytest.raises(ValueError, match="other"):
        section(Training, {"other": 1}, strict=True)


def test_reports(spark):
    df = spark.createDataFrame([("a|b", 1.5), ("<c>", float("nan")), (None, None)], "k string, v double")
    assert markdown(df, "T") == "## T\n\n| k | v |\n|-|-|\n| a\\|b | 1.5 |\n| <c> |  |\n|  |  |\n"
    assert "&lt;c&gt;" in page({"t": df}, "x & y") and "x &amp; y" in page({}, "x & y")
    assert bars(df.limit(1), "k", "v", width=4) == "a|b #### 1.5"
    with pytest.raises(ValueError):
        markdown(df, most=2)
