from __future__ import annotations

import os

import pytest

from earshot.llm.queries import REGISTRY

FOLDER = "/root/testdata/sf0.001"
#: The smallest tables have 9 labelled documents, two of them toxic, of which nothing can be learned: there p7 finds nothing.
LARGER = {"p7_found": "/root/testdata/sf0.01"}
FOUND = {
    "p1_found": [("row_id_a", "bigint"), ("row_id_b", "bigint")],
    "p2_found": [("row_id", "bigint")],
    "p3_found": [("score_id", "bigint")],
    "p5_found": [("doc_id", "bigint"), ("item_id", "bigint")],
    "p7_found": [("doc_id", "bigint")],
}


def test_every_query_belongs_to_a_problem():
    assert set(FOUND) <= set(REGISTRY.queries) and all(q[0] == "p" and q[1] in "123567" for q in REGISTRY.queries) and set(REGISTRY.sql) <= set(REGISTRY.queries)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(FOUND))
def test_found_has_the_columns_asked_for(spark, name):
    df = REGISTRY.queries[name](spark, LARGER.get(name, FOLDER))
    assert df.dtypes == FOUND[name] and df.count() > 0
    if name == "p1_found":
        assert df.where("row_id_a >= row_id_b").count() == 0 and df.distinct().count() == df.count()
