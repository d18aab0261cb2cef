"""Link step: zip with last-value padding, maxLinks, blank links, context overlay, profiles."""

import pytest
from pyspark.sql import functions as F

from pagemill.config import parse_config
from pagemill.functions.html import with_dom
from pagemill.operators.links import link_step
from pagemill.sources.tables import responses_from_pages

UNEVEN = """<html><body>
<a class="l" href="/a">A</a><a class="l" href="  ">B</a><a class="l" href="/c">C</a>
<span class="t">first</span><span class="t">second</span></body></html>"""


def _wf(rules, base=None):
    return parse_config({"taskInfo": {"id": 1, "name": "t"}, "workflowSteps": [
        {"id": 1, "type": "request", "config": {"headersMode": "json", "headersJson": '{"UA": "x"}'}},
        {"id": 2, "type": "link_extraction", "config": {"linkExtractionRules": rules}}]})


@pytest.fixture(scope="module")
def resp(spark):
    pages = spark.createDataFrame([(1, "https://h.test/dir/page?q=1", UNEVEN)],
                                  "page_id long, url string, html string")
    ctx = F.create_map(F.lit("task_id"), F.lit("1"), F.lit("title"), F.lit("parent"))
    return with_dom(responses_from_pages(pages, 1, ctx), "body", False)


RULES = [{"fieldName": "link", "expression": "//a[@class='l']/@href"},
         {"fieldName": "title", "expression": "//span[@class='t']/text()"},
         {"fieldName": "none", "expression": "//em/text()"}]


def _rows(resp, wf, profile="worker"):
    out = link_step(resp, wf.steps[1], wf, profile).orderBy("seq").collect()
    return [(r.url, dict(r.meta.context), r.meta.workflow_index, r.dont_filter, dict(r.headers))
            for r in out]


def test_worker_zip_padding_blank_link_and_context(resp):
    rows = _rows(resp, _wf(RULES))
    assert [r[0] for r in rows] == ["https://h.test/a", "https://h.test/dir/page?q=1", "https://h.test/c"]
    assert [r[1]["title"] for r in rows] == ["first", "second", "second"]  # padded with last
    assert all("none" not in r[1] for r in rows)  # an empty list contributes nothing
    assert all(r[1]["task_id"] == "1" for r in rows)  # inherited
    assert {r[2] for r in rows} == {2} and not any(r[3] for r in rows)
    assert rows[0][4] == {"UA": "x"}


def test_spider_drops_blank_links_no_inherit(resp):
    rows = _rows(resp, _wf(RULES), "spider")
    assert [r[0] for r in rows] == ["https://h.test/a", "https://h.test/c"]
    assert [r[1] for r in rows] == [{"title": "first"}, {"title": "second"}]
    assert all(r[3] for r in rows) and rows[0][4] == {}


@pytest.mark.parametrize("cap,n", [(None, 3), (0, 3), (2, 2), (-1, 2), (-5, 0)])
def test_max_links_python_slice(resp, cap, n):
    rules = [dict(RULES[0], maxLinks=cap)]
    assert len(_rows(resp, _wf(rules))) == n


def test_no_link_rule_emits_nothing_and_first_link_rule_counts(resp):
    assert _rows(resp, _wf([RULES[1]])) == []
    two = [RULES[0], {"fieldName": "link", "expression": "//span/@x"}]
    assert len(_rows(resp, _wf(two))) == 3


def test_repeated_field_name_last_rule_wins(resp):
    rules = [RULES[0], {"fieldName": "title", "expression": "//span/text()"},
             {"fieldName": "title", "expression": "//a/text()"}]
    assert [r[1]["title"] for r in _rows(resp, _wf(rules))] == ["A", "B", "C"]
