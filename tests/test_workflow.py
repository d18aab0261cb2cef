"""End-to-end workflow on a three-level site; generator cycles; profiles; previews; streaming."""

import pytest
from pyspark.sql import functions as F

from pagemill.config import load_config, parse_config, register_generator, seed_request
from pagemill.operators.fetch import page_snapshot
from pagemill.operators.requests import requests_from_rows, seeds_from_urls
from pagemill.plans.preview import extraction_coverage, preview_step, preview_workflow
from pagemill.plans.workflow import run_workflow
from pagemill.streaming.pipeline import scratch_dir, start_extract_stream, start_fetch_stream

from conftest import DESK, HUB, SHOP, all_shelves

AS_OF = "2024-01-01T00:00:00"


@pytest.fixture(scope="module")
def snap(pages_df):
    return page_snapshot(pages_df)


def test_seed_request_strict_and_lenient(tmp_path):
    wf = parse_config(SHOP)
    r = seed_request(wf)
    assert r["url"] == "https://lamps.test/" and r["meta"]["context"] == {"task_id": "41", "task_name": "lamps"}
    assert r["headers"] == {"User-Agent": "lamp-test"}
    bad = parse_config({"taskInfo": {}, "workflowSteps": [{"type": "link_extraction", "config": {}}]})
    with pytest.raises(ValueError):
        seed_request(bad)
    assert seed_request(bad, strict=False) is None
    with pytest.raises(FileNotFoundError):
        load_config(str(tmp_path / "missing.json"))
    p = tmp_path / "c.json"
    p.write_text('{"taskInfo": {}}')
    with pytest.raises(ValueError):
        load_config(str(p))


def test_dispatch_lenient_and_strict():
    wf = parse_config({"taskInfo": {}, "workflowSteps": [
        {"type": "request"}, {"type": "mystery"}, {"type": "link_extraction"}, {"type": "data_extraction"}]})
    assert [wf.dispatch(i) for i in range(5)] == [2, 2, 2, 3, None]
    assert [wf.dispatch(i, "strict") for i in range(5)] == [None, None, 2, 3, None]


def test_three_levels_worker(spark, snap):
    wf = parse_config(SHOP)
    res = run_workflow(wf, requests_from_rows(spark, [seed_request(wf)]), snap, as_of=AS_OF)
    arts = {r.link: r for r in res.saved.articles.collect()}
    assert set(arts) == {"https://lamps.test/item/arc", "https://lamps.test/item/reed"}  # the first shelf alone
    arc = arts["https://lamps.test/item/arc"]
    assert arc.title == "Arc lamp" and arc.task_id == "41"  # no data.title: context title
    assert '"title":"Arc lamp"' in arc.extra and '"task_id":"41"' in arc.extra
    contents = {r.article_id: r.content for r in res.saved.contents.collect()}
    assert contents[arc.id] == '<section itemprop="about" lang="en"><em>Arc &amp; marble</em></section>'
    reed = contents[arts["https://lamps.test/item/reed"].id]
    assert reed == '<section itemprop="about"><em>Reed<br>and paper</em></section>'
    assert res.rounds == 3 and res.complete and res.frontier.count() == 0


def test_a_capped_run_returns_its_frontier(spark, snap):
    wf = parse_config(SHOP)
    res = run_workflow(wf, requests_from_rows(spark, [seed_request(wf)]), snap, max_rounds=2, as_of=AS_OF)
    assert not res.complete and res.items.count() == 0
    left = {r.url for r in res.frontier.collect()}
    assert left == {"https://lamps.test/item/arc", "https://lamps.test/item/reed"}
    rest = run_workflow(wf, res.frontier, snap, as_of=AS_OF)
    assert rest.complete and rest.items.count() == 2


def test_workflow_of_links_alone_ends_well(spark, snap):
    wf = parse_config(dict(SHOP, workflowSteps=SHOP["workflowSteps"][:2]))
    res = run_workflow(wf, requests_from_rows(spark, [seed_request(wf)]), snap, as_of=AS_OF)
    assert res.items.count() == 0 and res.saved.articles.count() == 0


def test_second_shelf_and_failed_fetch_still_saved(spark, snap):
    wf = parse_config(all_shelves())
    res = run_workflow(wf, requests_from_rows(spark, [seed_request(wf)]), snap, as_of=AS_OF)
    arts = {r.link: r for r in res.saved.articles.collect()}
    # the reed lamp is on both shelves: first wins; the owl page has no such section;
    # the missing page is still saved with empty content (failed fetches are extracted)
    assert set(arts) == {f"https://lamps.test/item/{x}" for x in ("arc", "reed", "owl", "gone")}
    assert '"title":"Reed lamp"' in arts["https://lamps.test/item/reed"].extra
    with_content = {r.article_id for r in res.saved.contents.collect()}
    assert arts["https://lamps.test/item/gone"].id not in with_content
    drop = run_workflow(wf, requests_from_rows(spark, [seed_request(wf)]), snap, as_of=AS_OF,
                        on_failed_fetch="drop")
    assert "https://lamps.test/item/gone" not in {r.link for r in drop.saved.articles.collect()}


def test_spider_profile_title_and_extra(spark, snap):
    wf = parse_config(SHOP)
    res = run_workflow(wf, requests_from_rows(spark, [seed_request(wf)]), snap, profile="spider", as_of=AS_OF)
    arc = {r.link: r for r in res.saved.articles.collect()}["https://lamps.test/item/arc"]
    assert arc.title == "Arc lamp"                       # meta title first
    assert arc.extra.startswith('{"content":"<section')  # extra = data


def test_odd_pages_cost_no_other(spark):
    pages = spark.createDataFrame([
        (1, "https://lamps.test/", "<!-- --- nav --- --->" + HUB.replace("floor.html", "http://[x")),
        (2, "https://lamps.test/desk.html", DESK),
    ], "page_id long, url string, html string")
    wf = parse_config(all_shelves())
    res = run_workflow(wf, requests_from_rows(spark, [seed_request(wf)]), page_snapshot(pages), as_of=AS_OF)
    assert {r.link for r in res.saved.articles.collect()} == {f"https://lamps.test/item/{x}" for x in ("reed", "owl", "gone")}
    dead = res.dead_letters.collect()
    assert [(d.stage, d.error) for d in dead] == [("links", "link cannot be resolved")] and "http://[x" in dead[0].payload


def test_generator_cycle_is_bounded(spark, snap):
    calls = []

    def paginate(body, url, data):
        calls.append(url)
        return [{"url": url, "meta": {"workflow_index": 3}}]  # same page again: a cycle

    register_generator("paginate", paginate)
    cfg = {"taskInfo": {"id": 1, "name": "g"}, "workflowSteps": [
        {"id": 1, "type": "data_extraction", "config": {
            "extractionRules": [{"fieldName": "title", "expression": "//title/text()"}]}},
        {"id": 2, "type": "data_extraction", "config": {
            "extractionRules": [{"fieldName": "content", "expression": "//em/text()", "multiple": True}],
            "nextRequestCustomCode": "paginate"}},
        {"id": 3, "type": "request", "config": {}},
        {"id": 4, "type": "data_extraction", "config": {
            "extractionRules": [{"fieldName": "content", "expression": "//em/text()", "multiple": True}],
            "nextRequestCustomCode": "paginate"}},
    ]}
    wf = parse_config(cfg)
    seeds = requests_from_rows(spark, [{"url": "https://lamps.test/item/arc", "meta": {"workflow_index": 1}}])
    res = run_workflow(wf, seeds, snap, max_rounds=4, as_of=AS_OF)
    assert res.rounds == 4
    routes = [r.route for r in res.items.collect()]
    assert len(routes) == 4 and set(routes) == {"queue"}  # generator steps route to the queue


def test_previews(spark, pages_df, snap):
    wf = parse_config(SHOP)
    index = pages_df.filter(F.col("page_id") == 1)
    rows = preview_workflow(index, wf, snapshot=snap).orderBy("step_id").collect()
    assert [r.step_type for r in rows] == ["request", "link_extraction", "link_extraction", "data_extraction"]
    assert rows[1].result["link"] == ["floor.html"]
    assert rows[2].result == {"link": [], "title": []}  # same page (no fetch between link steps)
    assert rows[3].result is not None and rows[3].error is None  # followed floor.html from the snapshot
    out = preview_workflow(index, wf, snapshot=snap, link_index=5).filter("step_type = 'data_extraction'").first()
    assert out.error == "link index 5 out of range (0-0)"
    st = preview_step(pages_df.filter("page_id = 2"), wf.steps[2]).first()
    assert st.result["title"] == ["Arc lamp", "Reed lamp"]
    unk = preview_step(pages_df.limit(1), parse_config({"taskInfo": {}, "workflowSteps": [
        {"id": 9, "type": "mystery"}]}).steps[0]).first()
    assert unk.warning.startswith("Unsupported step type")
    cov = {(r.step_id, r.field): (r.values, r.pages) for r in extraction_coverage(pages_df, wf).collect()}
    assert cov[("30", "link")] == (5, 2) and cov[("40", "content")] == (2, 2)


def test_streaming_equals_batch(spark, pages_df, snap):
    wf = parse_config(SHOP)
    root = scratch_dir(spark, "wf-stream")
    reqs = requests_from_rows(spark, [seed_request(wf)])
    reqs.write.parquet(f"{root}/start/batch=seed")
    from pagemill.operators.store import ArticleStore

    store = ArticleStore(spark, f"{root}/store")
    for rnd in range(5):
        start_fetch_stream(spark, f"{root}/start", f"{root}/resp", snap, f"{root}/ck_fetch",
                           as_of=AS_OF).awaitTermination()
        start_extract_stream(spark, wf, f"{root}/resp", f"{root}/start", f"{root}/ck_extract",
                             store=store, as_of=AS_OF).awaitTermination()
    streamed = {r.link for r in store.load().articles.collect()}
    batch = run_workflow(wf, reqs, snap, as_of=AS_OF).saved.articles
    assert streamed == {r.link for r in batch.collect()}


def test_seeds_from_table(spark, pages_df):
    s = seeds_from_urls(pages_df, "url", "page_id").orderBy("seq").collect()
    assert [list(r.seq) for r in s][:2] == [[0, 1], [0, 2]] and s[0].meta.workflow_index == 0


def test_url_dupe_filter_respects_dont_filter(spark, snap):
    wf = parse_config(all_shelves())
    seeds = requests_from_rows(spark, [seed_request(wf), seed_request(wf)])
    plain = run_workflow(wf, seeds, snap, as_of=AS_OF)
    deduped = run_workflow(wf, seeds, snap, as_of=AS_OF, dedup_urls=True)
    # two identical seeds double every fetched page and the second shelf repeats an item:
    # without the filter 2 x 5 items are fetched, with it each of the four once
    assert plain.items.count() == 10 and deduped.items.count() == 4
    assert {r.link for r in plain.saved.articles.collect()} == {r.link for r in deduped.saved.articles.collect()}


def test_replayed_micro_batch_is_idempotent(spark, pages_df):
    from pagemill.operators.store import ArticleStore
    from pagemill.sources.tables import responses_from_pages
    from pagemill.streaming.pipeline import extract_batch

    wf = parse_config(SHOP)
    root = scratch_dir(spark, "replay")
    store = ArticleStore(spark, f"{root}/store")
    # shelves at workflow index 2 (the second link step) and items at index 3 (data step)
    lists = responses_from_pages(pages_df.filter("page_id in (2, 3)"), 2)
    posts = responses_from_pages(pages_df.filter("page_id in (4, 5)"), 3)
    batch = lists.unionByName(posts).drop("page_id")
    for _ in range(2):  # the same batch delivered twice (restart before the commit)
        extract_batch(wf, batch, 7, f"{root}/requests", f"{root}/items", store, as_of=AS_OF)
    assert spark.read.parquet(f"{root}/requests").count() == 5
    # items of the last step are saved, not queued, as in a batch run
    assert store.load().articles.count() == 2


def test_a_client_in_place_of_a_snapshot(spark):
    pages = {"https://lamps.test/": HUB, "https://lamps.test/desk.html": DESK}

    def client(url, method, headers, params, data, json):
        if url not in pages:
            return 404, {}, b""
        assert headers["X-Shop"] == "lamps" and headers["User-Agent"] == "lamp-test"
        return 200, {"Content-Type": "text/html; charset=gbk"}, pages[url].encode("gbk")

    wf = parse_config(all_shelves())
    res = run_workflow(wf, requests_from_rows(spark, [seed_request(wf)]), None, as_of=AS_OF, fetcher=client,
                       session_headers={"X-Shop": "lamps", "User-Agent": "session"}, retry_delay_s=0.0, max_rounds=2)
    assert {r.url for r in res.frontier.collect()} == {f"https://lamps.test/item/{x}" for x in ("reed", "owl", "gone")}
