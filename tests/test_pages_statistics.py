"""Deep pages by fences, statistics by partial results."""

import datetime as dt
import re

import pytest

from pagemill.operators import queries as Q
from pagemill.operators.pages import PageIndex
from pagemill.operators.statistics import TaskStatistics
from pagemill.operators.store import ArticleStore, save_articles
from pagemill.streaming.pipeline import scratch_dir

COLS = ("task_id string, title string, link string, content string, source_url string, extra string, "
        "created_at timestamp_ntz, seq array<bigint>")


def rows(spark, n, tasks=3, start=0):
    t0 = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(f"t{i % tasks}" if i % 11 else "t0", f"T{i}", f"https://h/{i}", f"c{i}" if i % 5 else "", "s", "{}",
                                   t0 + dt.timedelta(seconds=i // 4), [0, i]) for i in range(start, start + n)], COLS)


@pytest.fixture(scope="module")
def store(spark):
    store = ArticleStore(spark, scratch_dir(spark, "pages"))
    store.append(save_articles(store.load(), rows(spark, 400), batch_id=0), 0)
    return store.load()


@pytest.mark.parametrize("content", [False, True])
def test_pages_equal_offset_and_limit(spark, store, content):
    every = PageIndex(spark, scratch_dir(spark, "ix"), include_content=content).build(store)
    tasks = PageIndex(spark, scratch_dir(spark, "ix"), by_task=True, include_content=content).build(store)
    for offset, limit in ((0, 10), (195, 30), (390, 50), (400, 5), (7, 0), (-3, 4)):
        got = every.page(offset, limit)
        want = Q.get_all_articles(store, content, limit, max(0, offset)).collect()
        assert [tuple(r)[1:] for r in got.collect()] == [tuple(r) for r in want]
        want = Q.get_articles_by_task(store, "t0", content, limit, max(0, offset)).collect()
        assert [tuple(r)[1:] for r in tasks.page(offset, limit, "t0").collect()] == [tuple(r) for r in want]
    assert tasks.page(0, 5, "nobody").count() == 0


def test_a_deep_page_reads_its_ranges_alone(spark, store):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as many ranges as for a large table
    try:
        index = PageIndex(spark, scratch_dir(spark, "ixplan"), include_content=True).build(store)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    plan = index.page(200, 10)._jdf.queryExecution().executedPlan().toString()
    parts = re.search(r"PartitionFilters: \[([^\]]*)\]", plan)[1]
    assert len(re.findall(r"_part#\d+ (?:=|IN)", parts)) == 1 and "Window" not in plan
    held = spark.read.parquet(f"{index.root}/fences").count()
    named = re.findall(r"\d+", re.search(r"_part#\d+ (?:= |IN \()([\d,]+)", parts)[1])
    assert held > 4 and len(named) <= 2
    assert [r.place for r in index.page(200, 10).collect()] == list(range(200, 210))


def test_statistics_fold_and_resets(spark):
    stats = TaskStatistics(spark, scratch_dir(spark, "stats"), buckets=2, fanout=3)
    tables = ArticleStore(spark, scratch_dir(spark, "statstore"))
    for b in range(4):
        new = save_articles(tables.load(), rows(spark, 60, start=40 * b), batch_id=b).materialized()
        tables.append(new, b)
        stats.add(new.articles, b)
        assert stats.add(new.articles, b) is None

    def check():
        want = {r.task_id: (r.article_count, r.latest_created_at) for r in Q.task_statistics(tables.load().articles).collect()}
        got = stats.statistics().collect()
        assert {r.task_id: (r.article_count, r.latest_created_at) for r in got} == want
        assert all(abs(r.distinct_links - r.article_count) <= 0.08 * r.article_count for r in got)

    check()
    tables.delete_task("t1")
    stats.drop_task("t1", 4)
    check()
    newest = Q.get_articles_by_task(tables.load(), "t2", limit=1).first()
    tables.delete_article(newest.id)
    stats.recount("t2", tables.load().articles, 5)
    check()
    stats.fold()
    assert len(stats.runs()) < 6
    check()
    again = save_articles(tables.load(), rows(spark, 60), batch_id=9).materialized()
    tables.append(again, 9)
    stats.add(again.articles, 9)
    check()
    tables.delete_task("t2")
    stats.recount("t2", tables.load().articles, 10)
    check()
