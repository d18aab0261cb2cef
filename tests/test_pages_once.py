"""Pages are parsed once, and Python workers hold one batch as it comes in and one slice of parsed pages."""

import pyarrow as pa
from pyspark.sql import functions as F

from pagemill.functions import html as H
from pagemill.functions.htmlnorm import normalize
from pagemill.operators.links import link_step
from pagemill.plans.site import site_workflow
from pagemill.sources.tables import responses_from_pages


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_page_is_parsed_once_for_its_links(spark, pages_df):
    wf = site_workflow()
    req = link_step(H.with_dom(responses_from_pages(pages_df), "body", with_spans=False), wf.steps[1], wf)
    assert _plan(req.select("url", "seq")).count("ArrowEvalPython") == 1
    assert _plan(req.select(F.lit(1).alias("one"))).count("ArrowEvalPython") == 1


def test_links_keep_their_places(spark):
    pages = spark.createDataFrame([(1, "http://a.test/", "<nav><a href='/x'>X</a><a href='/y'>Y</a></nav>"),
                                   (2, "http://b.test/", "<p>none</p>"), (3, "http://c.test/", None)],
                                  "page_id long, url string, html string")
    wf = site_workflow()
    req = link_step(H.with_dom(responses_from_pages(pages), "body", with_spans=False), wf.steps[1], wf)
    rows = sorted((r.seq, r.url, r.meta.context) for r in req.collect())
    assert rows == [([1, 1, 0], "http://a.test/x", {"anchor": "X"}), ([1, 1, 1], "http://a.test/y", {"anchor": "Y"})]


def test_pages_leave_the_parser_in_slices():
    html = [None if i % 7 == 0 else f"<h1 class='t'>page {i}</h1><p>{'long ' * i}" for i in range(1000)]
    for spans in (True, False):
        out = list(H._parsed(iter([pa.array(html), pa.array(["x" * (H.SLICE_CHARS + 1)] * 3), pa.array([], pa.string())]), spans))
        assert max(len(a) for a in out) <= H.SLICE_PAGES
        assert [len(a) for a in out[-3:]] == [1, 1, 1]  # a page over the limit is a slice of its own
        rows = [tuple(r.values()) for a in out for r in a.to_pylist()]
        assert rows[:1000] == [normalize(h, spans) if h is not None else (None,) * 4 for h in html]
