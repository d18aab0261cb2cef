"""Rule kinds as columns: attribute, text, element, (...)[1], count(), CSS, empty, no match."""

import pytest
from pyspark.sql import functions as F

from pagemill.functions import rules as R
from pagemill.functions.css import css_to_xpath
from pagemill.functions.html import with_dom
from pagemill.functions.rules import Rule, classify

PAGE = """<html><head><title>  T &amp; t  </title></head><body>
<div class="a b"><a href="/1" id="x">one</a><a href="/2">two</a></div>
<ul><li>i1</li><li class="last">i2</li></ul><p>para <b>bold</b></p></body></html>"""


@pytest.fixture(scope="module")
def dom(spark):
    return with_dom(spark.createDataFrame([(PAGE,), (None,), ("",)], "html string"), "html", True)


def _vals(dom, rule, multiple=True):
    col = R.values(F.col("dom"), rule) if multiple else R.first(F.col("dom"), rule)
    return [r[0] for r in dom.select(col).collect()]


@pytest.mark.parametrize("expr,kind", [
    ("//a/@href", "value"), ("//title/text()", "value"), ("//a", "element"),
    ("(//div[@class=\"links-container\"]/a/@href)[1]", "value"), ("count(//a)", "number"),
    ("string(//title)", "string"), ("boolean(//a)", "boolean"), ("//a | //li", "element"),
    ("//a/@href | //li/text()", "value"),
])
def test_classify(expr, kind):
    assert classify(expr) == kind


def test_attribute_text_element_number(dom):
    assert _vals(dom, Rule("l", "//a/@href"))[0] == ["/1", "/2"]
    assert _vals(dom, Rule("t", "//title/text()"), False)[0] == "T & t"
    assert _vals(dom, Rule("e", "//ul/li"))[0] == ["<li>i1</li>", '<li class="last">i2</li>']
    assert _vals(dom, Rule("n", "count(//a)"), False)[0] == "2.0"
    assert _vals(dom, Rule("b", "boolean(//ul)"), False)[0] == "1"
    assert _vals(dom, Rule("f", "(//a/@href)[1]"))[0] == ["/1"]


def test_empty_expression_and_no_match(dom):
    assert _vals(dom, Rule("e", ""))[0] == []
    assert _vals(dom, Rule("e", ""), False)[0] == ""
    assert _vals(dom, Rule("m", "//table/@x"))[0] == []
    assert _vals(dom, Rule("m", "//table/@x"), False)[0] is None
    # null and empty pages yield no values
    assert _vals(dom, Rule("l", "//a/@href"))[1:] == [[], []]


def test_attribute_wildcard_hides_node_ids(dom):
    assert _vals(dom, Rule("w", "//a[1]/@*"))[0] == ["/1", "x"]
    assert _vals(dom, Rule("c", "count(//a[1]/@*)"), False)[0] == "2.0"


def test_css_rules(dom):
    assert _vals(dom, Rule("c", "div.a a::attr(href)", "css"))[0] == ["/1", "/2"]
    assert _vals(dom, Rule("c", "li.last::text", "css"))[0] == ["i2"]
    assert _vals(dom, Rule("c", "ul > li:first-child::text", "css"))[0] == ["i1"]
    assert _vals(dom, Rule("c", "a#x::text, p > b::text", "css"))[0] == ["one", "bold"]
    assert _vals(dom, Rule("c", "div.a", "css"))[0][0].startswith('<div class="a b">')


def test_worker_vs_spider_extract_type(dom):
    # worker: only 'css' is CSS (unknown -> XPath); spider: anything but 'xpath' is CSS
    assert R.to_xpath("li", "weird", "worker") == "li"
    assert R.to_xpath("li", "weird", "spider") == css_to_xpath("li")


def test_css_translation_shapes():
    assert css_to_xpath("a") == "descendant-or-self::a"
    assert css_to_xpath("div > p + span").endswith("/following-sibling::*[1][self::span]")
    assert "starts-with(@href, 'http')" in css_to_xpath("a[href^='http']")
    assert css_to_xpath("a::attr(href)").endswith("/@href")


def test_strip_is_unicode_whitespace(spark):
    df = spark.createDataFrame([("　\xa0 x y\t\n ",)], "s string")
    assert df.select(R.strip_ws(F.col("s"))).first()[0] == "x y"
