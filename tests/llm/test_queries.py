"""The registered llm queries over the smallest tables, and results that follow from each other."""

from __future__ import annotations

import os

import pytest

from plafond.llm import queries as q

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(DATA), reason="no test tables")
COLUMNS = {
    "p1_found": ["article_id", "block_no"],
    "p3_found": ["src", "item_id", "line_no"],
    "p4_found": ["region_id", "line_no"],
    "p5_found": ["region_id", "line_no", "kind"],
    "p6_ids": ["doc_id", "ids"],
    "p8_found": ["doc_id", "block_no", "lang"],
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_distinct_rows(spark, name):
    df = q.QUERIES[name](spark, DATA)
    rows = [str(r) for r in df.collect()]
    assert df.columns == COLUMNS[name] and rows and (name == "p6_ids" or len(rows) == len(set(rows)))


def test_no_boilerplate_line_is_a_scan_case(spark):
    boiler = {tuple(r) for r in q.p4_found(spark, DATA).collect()}
    cases = {(r.region_id, r.line_no) for r in q.p5_found(spark, DATA).collect()}
    assert boiler and cases and not boiler & cases


def test_changed_lines_are_the_found_ones(spark):
    changed = {(r.src, r.item_id, r.line_no) for r in q.p3_lines(spark, DATA).where("changed").collect()}
    assert changed == {tuple(r) for r in q.p3_found(spark, DATA).collect()}
