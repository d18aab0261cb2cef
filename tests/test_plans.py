"""Physical-plan properties the scale design relies on."""

import re

from pyspark.sql import functions as F

from pagemill.operators import queries as Q
from pagemill.operators.dedup import first_wins
from pagemill.operators.store import ArticleStore, save_articles
from pagemill.streaming.pipeline import scratch_dir


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_is_one_shuffle_with_map_side_aggregation(spark):
    df = spark.createDataFrame([("a", [0, i], "x" * 10) for i in range(50)], "k string, seq array<bigint>, v string")
    plan = _plan(first_wins(df, "k", "seq", bypass_empty=True))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "partial_min_by" in plan


def test_store_anti_join_reads_only_the_link_hash(spark):
    store = ArticleStore(spark, scratch_dir(spark, "plan-store"))
    rows = [("t", "A", f"https://h/{i}", "c", "s", "{}", [0, i]) for i in range(5)]
    cols = "task_id string, title string, link string, content string, source_url string, extra string, seq array<bigint>"
    store.append(save_articles(store.load(), spark.createDataFrame(rows, cols), batch_id=0), 0)
    res = save_articles(store.load(), spark.createDataFrame(rows, cols), batch_id=1)
    scans = re.findall(r"FileScan parquet [^\n]*ReadSchema: (struct<[^>]*>)", _plan(res.rows))
    assert scans and all(s == "struct<link_hash:string>" for s in scans)


def test_page_scan_is_pruned_and_articles_stay_in_the_jvm(spark, pages_df):
    path = scratch_dir(spark, "plan-pages")
    pages_df.withColumn("extra_col", F.lit("x" * 100)).write.parquet(path)
    from pagemill.functions import rules as R
    from pagemill.functions.html import with_dom
    from pagemill.functions.rules import Rule

    pages = spark.read.parquet(path)
    q = with_dom(pages.select("page_id", "html"), "html", False).select(
        "page_id", R.first(F.col("dom"), Rule("t", "//title/text()")))
    schema = re.findall(r"ReadSchema: (struct<[^>]*>)", _plan(q))
    assert schema == ["struct<page_id:bigint,html:string>"]
    store = ArticleStore(spark, scratch_dir(spark, "plan-store2")).load()
    page = Q.get_articles_by_task(store, "t", include_content=True, limit=5)
    assert "ArrowEvalPython" not in _plan(page) and "BatchEvalPython" not in _plan(page)


def test_fetch_broadcasts_a_small_frontier_and_never_the_pages(spark):
    from pagemill.operators.fetch import fetch, page_snapshot
    from pagemill.operators.requests import seeds_from_urls

    pages = spark.range(4000).selectExpr("id AS page_id", "concat('https://h/', id) AS url", "repeat('x', 4000) AS html")
    root = scratch_dir(spark, "plan")
    pages.write.parquet(root)
    pages = spark.read.parquet(root)
    asked = seeds_from_urls(pages.filter("page_id < 3"), "url", "page_id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 200_000)
    try:
        got = fetch(asked, page_snapshot(pages, unique_urls=True), as_of="2024-01-01T00:00:00", charset=False)
        rows = got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(rows) == 3 and all(r.status == 200 and len(r.body) == 4000 for r in rows)
    final = plan.split("== Initial Plan ==")[0]
    assert "BroadcastHashJoin" in final
    # pages are moved by no exchange: the only exchanges above a scan with html are none
    for line in final.split("\n"):
        if "Exchange" in line:
            assert "html" not in line


def test_a_snapshot_of_unique_urls_moves_no_page(spark):
    from pagemill.operators.fetch import page_snapshot

    pages = spark.range(2000).selectExpr("id AS page_id", "concat('https://h/', id % 1999) AS url", "repeat('x', 500) AS html")
    root = scratch_dir(spark, "plan")
    pages.write.parquet(root)
    rows = page_snapshot(spark.read.parquet(root)).collect()
    assert len(rows) == 1999 and len({r.url for r in rows}) == 1999
