"""Beyond the bound on broadcasts the same joins shuffle, with the same rows."""

from __future__ import annotations

import os

import pytest

from plafond.llm import canonical, packing, repeated, scanned
from plafond.llm import queries as q

DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables")
@pytest.mark.parametrize("name", ["p4_regions", "p5_found"])
def test_without_broadcasts(spark, monkeypatch, name):
    want = sorted(map(str, q.QUERIES[name](spark, DATA).collect()))
    for module in (canonical, packing, repeated, scanned):
        monkeypatch.setattr(module, "broadcast_if_small", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = q.QUERIES[name](spark, DATA)
        assert sorted(map(str, df.collect())) == want and "BroadcastHashJoin" not in df._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
