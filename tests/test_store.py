"""First-wins de-dup, save/rerun outcomes, deletes, document form, persistence, queries."""

import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemill.operators import queries as Q
from pagemill.operators.dedup import first_wins
from pagemill.operators.store import (ArticleStore, ArticleTables, apply_save, delete_article,
                                      delete_by_task, save_articles, save_documents, to_documents)
from pagemill.streaming.pipeline import scratch_dir

COLS = "task_id string, title string, link string, content string, source_url string, extra string, seq array<bigint>"


def _batch(spark, rows):
    return spark.createDataFrame(rows, COLS)


def test_first_wins_keeps_smallest_seq_and_bypasses_empty(spark):
    df = spark.createDataFrame(
        [("a", [0, 3]), ("a", [0, 1]), ("b", [1, 0]), ("", [0, 5]), ("", [0, 6]), ("a", [1, 0])],
        "k string, seq array<bigint>")
    got = sorted((r.k, list(r.seq)) for r in first_wins(df, "k", "seq", bypass_empty=True).collect())
    assert got == [("", [0, 5]), ("", [0, 6]), ("a", [0, 1]), ("b", [1, 0])]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from(["x", "y", "z", "", "w"]), min_size=1, max_size=30), st.integers(1, 4))
def test_dedup_idempotent_under_batch_splits(spark, links, parts):
    rows = [("t", "", f"https://h/{l}" if l else "", "c", "s", "{}", [0, i]) for i, l in enumerate(links)]
    one = save_articles(ArticleTables.empty(spark), _batch(spark, rows))
    want = sorted(r.link for r in one.articles.collect())
    store = ArticleTables.empty(spark)
    cuts = sorted(random.Random(len(links)).sample(range(1, len(rows) + 1), min(parts, len(rows))))
    start = 0
    for b, end in enumerate(cuts + [len(rows)]):
        if end <= start:
            continue
        res = save_articles(store, _batch(spark, rows[start:end]), batch_id=b)
        store = apply_save(store, res)
        start = end
    assert sorted(r.link for r in store.articles.collect()) == want
    # a re-run inserts nothing new except rows without a link
    again = save_articles(store, _batch(spark, rows), batch_id=99)
    assert all(r.link == "" for r in again.articles.collect())


def test_save_outcomes_content_rows_and_global_key(spark):
    rows = [("t1", "A", "https://h/1", "body", "s", '{"k":"v"}', [0, 1]),
            ("t2", "B", "https://h/1", "other", "s", "{}", [0, 2]),   # same link, other task
            ("t1", "C", "https://h/2", "", "s", None, [0, 3]),          # empty content: no content row
            ("t1", "D", "", "x", "s", "{}", [0, 4])]                     # no link: never de-duplicated
    res = save_articles(ArticleTables.empty(spark), _batch(spark, rows))
    arts = {r.title: r for r in res.articles.collect()}
    assert set(arts) == {"A", "C", "D"} and arts["C"].extra == "{}"
    assert {r.article_id for r in res.contents.collect()} == {arts["A"].id, arts["D"].id}
    out = {tuple(r.seq): (r.article_id, r.status) for r in res.outcomes.collect()}
    assert out[(0, 2)] == (arts["A"].id, "existing") and out[(0, 1)][1] == "inserted"


def test_deletes_and_counts(spark):
    rows = [(f"t{i % 2}", f"T{i}", f"https://h/{i}", f"c{i}", "s", "{}", [0, i]) for i in range(6)]
    store = apply_save(ArticleTables.empty(spark), save_articles(ArticleTables.empty(spark), _batch(spark, rows)))
    after, deleted = delete_by_task(store, "t0")
    assert deleted.first()[0] == 3 and after.articles.count() == 3 and after.contents.count() == 3
    one_id = after.articles.first().id
    after2, d2 = delete_article(after, one_id)
    assert d2.first()[0] == 1 and after2.contents.filter(F.col("article_id") == one_id).count() == 0
    assert Q.count_articles_by_task(store.articles, "t1").first()[0] == 3
    assert Q.count_articles_by_task(store.articles, "nope").first()[0] == 0
    assert Q.count_all_articles(store.articles).first()[0] == 6


def test_listing_order_whitelist_and_content_join(spark):
    rows = [("t", f"T{i}", f"https://h/{i}", "" if i == 2 else f"c{i}", "s", None, [0, i]) for i in range(5)]
    b = _batch(spark, rows).withColumn("created_at", F.expr("timestamp_ntz'2024-01-01 00:00:00'") +
                                       F.make_dt_interval(secs=F.element_at("seq", 2).cast("decimal(18,6)")))
    store = apply_save(ArticleTables.empty(spark), save_articles(ArticleTables.empty(spark), b))
    page = Q.get_articles_by_task(store, "t", include_content=True, limit=2, offset=1).collect()
    assert [r.title for r in page] == ["T3", "T2"] and page[1].content == "" and page[0].extra == "{}"
    bad = Q.get_all_articles(store, order_by="nope", order_direction="up", limit=1).collect()
    assert bad[0].title == "T4"
    asc = Q.get_all_articles(store, order_by="title", order_direction="asc", limit=2).collect()
    assert [r.title for r in asc] == ["T0", "T1"]
    aid = asc[0].id
    assert Q.get_article_by_id(store, aid).first().content == "c0"
    assert Q.get_article_by_id(store, 12345).count() == 0
    stats = Q.task_statistics(store.articles).collect()
    assert stats[0].article_count == 5


def test_document_form(spark):
    rows = [("t", "A", "https://h/1", "x", "s", '{"tags": ["a", "b"]}', [0, 1]),
            ("t", "B", "https://h/1", "y", "s", "{}", [0, 2])]
    docs, outcomes = save_documents(to_documents(ArticleTables.empty(spark)), _batch(spark, rows))
    d = docs.collect()
    assert len(d) == 1 and d[0].content == "x"
    assert [o.status for o in outcomes.orderBy("seq").collect()] == ["inserted", "existing"]
    assert Q.get_document_by_id(docs, d[0].id).count() == 1
    assert Q.get_document_by_id(docs, "not-an-id").count() == 0


def test_article_store_append_is_idempotent_per_batch(spark):
    store = ArticleStore(spark, scratch_dir(spark, "store-test"))
    rows = [("t", "A", "https://h/1", "x", "s", "{}", [0, 1])]
    res = save_articles(store.load(), _batch(spark, rows), batch_id=0)
    assert store.append(res, 0) is True
    assert store.append(res, 0) is False  # replayed batch is skipped
    assert store.load().articles.count() == 1
    tables, _ = delete_by_task(store.load(), "t")
    store.replace(tables)
    assert store.load().articles.count() == 0


def test_crash_between_the_two_writes_loses_nothing(spark):
    store = ArticleStore(spark, scratch_dir(spark, "crash"))
    rows = [("t", "A", "https://h/1", "x", "s", "{}", [0, 1]), ("t", "B", "https://h/2", "y", "s", "{}", [0, 2])]
    res = save_articles(store.load(), _batch(spark, rows), batch_id=0)
    store._write("articles", res.articles, "0")  # and then the job dies
    assert store.load().articles.count() == 0
    again = save_articles(store.load(), _batch(spark, rows), batch_id=0)
    assert store.append(again, 0)
    assert store.load().articles.count() == 2 and store.load().contents.count() == 2


def test_replay_after_a_delete_brings_nothing_back(spark):
    store = ArticleStore(spark, scratch_dir(spark, "replay"))
    rows = [("t", "A", "https://h/1", "x", "s", "{}", [0, 1]), ("u", "B", "https://h/2", "y", "s", "{}", [0, 2])]
    store.append(save_articles(store.load(), _batch(spark, rows), batch_id=0), 0)
    tables, _ = delete_by_task(store.load(), "t")
    store.replace(tables)
    assert store.committed(0)
    assert store.append(save_articles(store.load(), _batch(spark, rows), batch_id=0), 0) is False
    assert [r.title for r in store.load().articles.collect()] == ["B"]


def test_outcomes_of_content_duplicates_name_the_row_that_holds_them(spark):
    first = [("t", "A", "https://h/1", "same", "s", "{}", [0, 1])]
    more = [("t", "B", "https://h/2", "same", "s", "{}", [1, 1]), ("t", "C", "https://h/3", "new", "s", "{}", [1, 2]),
            ("t", "D", "https://h/4", "new", "s", "{}", [1, 3])]
    one = save_articles(ArticleTables.empty(spark), _batch(spark, first), dedup_on="content_hash")
    store = apply_save(ArticleTables.empty(spark), one)
    two = save_articles(store, _batch(spark, more), batch_id=1, dedup_on="content_hash")
    ids = {r.title: r.id for r in apply_save(store, two).articles.collect()}
    got = {tuple(r.seq): (r.article_id, r.status) for r in two.outcomes.collect()}
    assert got == {(1, 1): (ids["A"], "existing"), (1, 2): (ids["C"], "inserted"), (1, 3): (ids["C"], "existing")}


def test_one_bad_extra_costs_no_other_document(spark):
    from pagemill.operators.store import document_dead_letters

    rows = [("t", "A", "https://h/1", "x", "s", "{not json", [0, 1]), ("t", "B", "https://h/2", "y", "s", "{}", [0, 2])]
    docs, outcomes = save_documents(to_documents(ArticleTables.empty(spark)), _batch(spark, rows))
    assert [r.title for r in docs.collect()] == ["B"] and outcomes.count() == 1
    dead = document_dead_letters(_batch(spark, rows)).collect()
    assert [d.error for d in dead] == ["extra is not JSON"] and "{not json" in dead[0].item


def test_dedup_on_content_hash_and_document_delete(spark):
    from pagemill.operators.store import delete_documents_by_task

    rows = [("t", "A", "https://h/1", "same", "s", "{}", [0, 1]),
            ("t", "B", "https://h/2", "same", "s", "{}", [0, 2]),
            ("u", "C", "https://h/3", "other", "s", "{}", [0, 3])]
    res = save_articles(ArticleTables.empty(spark), _batch(spark, rows), dedup_on="content_hash")
    assert sorted(r.title for r in res.articles.collect()) == ["A", "C"]
    docs, _ = save_documents(to_documents(ArticleTables.empty(spark)), _batch(spark, rows))
    after, deleted = delete_documents_by_task(docs, "t")
    assert deleted.first()[0] == 2 and [r.title for r in after.collect()] == ["C"]


def test_sink_router_fallback_and_dead_letters(spark):
    from pagemill.operators.store import DocumentStore, save_to_targets

    root = scratch_dir(spark, "router")
    rows = [("t", "A", "https://h/1", "x", "s", '{"tags": ["a"]}', [0, 1])]
    docs = DocumentStore(spark, f"{root}/docs")
    rel = ArticleStore(spark, f"{root}/rel")
    assert save_to_targets(_batch(spark, rows), [docs, rel], batch_id=0) == "DocumentStore"
    assert docs.load().first().title == "A"

    class Broken(DocumentStore):
        def save(self, *a, **k):
            raise RuntimeError("store down")

    broken = Broken(spark, f"{root}/broken")
    assert save_to_targets(_batch(spark, rows), [broken, rel], batch_id=1) == "ArticleStore"
    assert rel.load().articles.count() == 1
    out = save_to_targets(_batch(spark, rows), [broken, rel], batch_id=2, fallback=False,
                          dead_letter_path=f"{root}/dead")
    assert out == "dead_letter"
    dead = spark.read.json(f"{root}/dead").first()
    assert "store down" in dead.error and '"title":"A"' in dead.item


def test_header_value(spark):
    from pagemill.functions.charset import header_value

    df = spark.createDataFrame([({"DATE": "Mon", "x": "1"},), (None,)], "h map<string,string>")
    assert [r[0] for r in df.select(header_value(F.col("h"), "date")).collect()] == ["Mon", None]


def test_bucketed_store_reads_stored_keys_without_shuffle(spark):
    root = scratch_dir(spark, "bucketed")
    store = ArticleStore(spark, root, buckets=4, table_prefix="pm_test")
    rows = [("t", f"T{i}", f"https://h/{i}", f"c{i}", "s", "{}", [0, i]) for i in range(20)]
    assert store.append(save_articles(store.load(), _batch(spark, rows[:10]), batch_id=0), 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)  # as for a store that is not small
    try:
        res = save_articles(store.load(), _batch(spark, rows[5:]), batch_id=1)
        plan = res.rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = [line for line in plan.split("\n") if "pm_test_articles" in line]
    assert scan and "Bucketed: true" in scan[0]
    assert store.append(res, 1) and store.load().articles.count() == 20
    assert store.append(res, 1) is False
    # a new handle over the same folder (as in a new session) sees the data
    again = ArticleStore(spark, root, buckets=4, table_prefix="pm_test_reopen")
    assert again.load().contents.count() == 20
    tables, _ = delete_by_task(again.load(), "t")
    again.replace(tables)
    assert again.load().articles.count() == 0
