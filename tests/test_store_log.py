"""Stores with a log: tombstones, replays and crashes."""

import pytest
from pyspark.sql import functions as F

from pagemill.operators import store as St
from pagemill.operators.store import ArticleStore, DocumentStore, save_articles
from pagemill.sources.files import names, write_text
from pagemill.streaming.pipeline import scratch_dir

COLS = "task_id string, title string, link string, content string, source_url string, extra string, seq array<bigint>"


def batch(spark, *rows, start=0):
    return spark.createDataFrame([(t, n, f"https://h/{n}", c, "s", "{}", [0, i + start]) for i, (t, n, c) in enumerate(rows)], COLS)


def save(store, df, number):
    return store.append(save_articles(store.load(), df, batch_id=number), number)


def titles(store):
    tables = store.load()
    ids = {r.id: r.title for r in tables.articles.collect()}
    assert {r.article_id for r in tables.contents.collect()} <= set(ids)
    return sorted(ids.values()), sorted(r.content for r in tables.contents.collect())


def files(spark, store):
    """Data files with their times."""
    found = {}
    for table in store.TABLES:
        for seq in names(spark, store._dir(table)):
            fs, p = St.delete.__globals__["file_system"](spark, f"{store._dir(table)}/{seq}")
            for s in fs.listStatus(p):
                found[s.getPath().toString()] = s.getModificationTime()
    return found


@pytest.mark.parametrize("buckets", [None, 4])
def test_deletes_rewrite_no_file_and_rows_come_back(spark, buckets):
    store = ArticleStore(spark, scratch_dir(spark, "tomb"), buckets=buckets, table_prefix=f"pm_log_{buckets}")
    rows = [("t", "A", "a"), ("t", "B", ""), ("u", "C", "c"), ("u", "D", "d")]
    save(store, batch(spark, *rows), 0)
    before = files(spark, store)
    assert store.delete_task("t") == 2 and store.delete_task("t") == 0 and store.delete_task("nobody") == 0
    gone = store.load().articles.where("title = 'C'").first().id
    assert store.delete_article(gone) and not store.delete_article(gone)
    assert titles(store) == (["D"], ["d"]) and files(spark, store) == before
    assert save(store, batch(spark, *rows), 0) is False  # the replay of a batch brings nothing back
    assert titles(store) == (["D"], ["d"])
    save(store, batch(spark, ("v", "A", "a2"), ("u", "C", "c2"), ("u", "D", "d2")), 1)
    assert titles(store) == (["A", "C", "D"], ["a2", "c2", "d"])
    assert {r.title: r.task_id for r in store.load().articles.collect()}["A"] == "v"
    assert store.delete_task("u") == 2
    assert store.compact() == 1 and titles(store) == (["A"], ["a2"])
    save(store, batch(spark, ("u", "C", "c3")), 2)
    assert titles(store) == (["A", "C"], ["a2", "c3"]) and store.delete_task("v") == 1
    assert titles(store) == (["C"], ["c3"])


def test_a_crash_before_or_after_the_log_entry(spark):
    store = ArticleStore(spark, scratch_dir(spark, "crash"))
    save(store, batch(spark, ("t", "A", "a")), 0)
    new = save_articles(store.load(), batch(spark, ("t", "B", "b")), batch_id=1)
    store._write("articles", new.articles, 1)  # dies before the log entry; then something else takes place
    assert titles(store) == (["A"], ["a"])
    write_text(spark, f"{store.root}/v0/tombstones/{1:012d}.json", '{"kind": "task", "value": "t", "at": 1}\n')
    assert titles(store) == (["A"], ["a"])  # a delete that died as well
    save(store, batch(spark, ("t", "C", "c")), 2)
    assert titles(store) == (["A", "C"], ["a", "c"])
    version = store._version()
    store._write("articles", new.articles, 2)
    store._write("article_contents", new.contents.withColumn("task_id", F.lit("t")), 2)
    store._publish(version, 2, {"batch": "1"})  # dies before its marker
    assert titles(store) == (["A", "B", "C"], ["a", "b", "c"])
    assert store.committed(1) and save(store, batch(spark, ("t", "B", "b")), 1) is False
    with pytest.raises(RuntimeError):
        store._publish(version, 2, {"batch": "other"})


def test_deletes_are_folded_before_they_are_many(spark, monkeypatch):
    monkeypatch.setattr(St, "MAX_TOMBSTONES", 2)
    store = ArticleStore(spark, scratch_dir(spark, "many"))
    save(store, batch(spark, *[(f"t{i}", f"T{i}", "x") for i in range(6)]), 0)
    for i in range(4):
        store.delete_task(f"t{i}")
    assert store._version() == 1 and len(names(spark, f"{store.root}/v1/tombstones")) == 1
    assert titles(store)[0] == ["T4", "T5"]


def test_document_store_deletes(spark):
    store = DocumentStore(spark, scratch_dir(spark, "docs"))
    store.save(batch(spark, ("t", "A", "a"), ("u", "B", "b")), 0)
    assert store.save(batch(spark, ("t", "A", "a")), 0) is None
    assert store.delete_task("t") == 1
    kept = store.load().collect()
    assert [r.title for r in kept] == ["B"] and store.delete_document(kept[0].id) and store.load().count() == 0
    store.save(batch(spark, ("t", "A", "a")), 1)
    assert [r.title for r in store.load().collect()] == ["A"]


def test_readers_broadcast_tombstones_only(spark):
    store = ArticleStore(spark, scratch_dir(spark, "plan"))
    save(store, batch(spark, ("t", "A", "a"), ("u", "B", "b")), 0)
    store.delete_task("t")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = store.load().contents._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    for line in plan.split("\n"):  # what is exchanged are the few tombstones
        if "Exchange hashpartitioning" in line:
            assert "value" in line


@pytest.mark.parametrize("few", [0, 10_000])
def test_saves_match_brute_force_whichever_rows_move(spark, monkeypatch, few):
    monkeypatch.setattr(St, "FEW", few)
    store = ArticleStore(spark, scratch_dir(spark, "moves"))
    held: dict = {}
    for number in range(3):
        rows = [(f"t{i % 3}", f"L{(i * 7 + number * 11) % 40}" if i % 9 else "", f"c{number}-{i}") for i in range(60)]
        df = spark.createDataFrame([(t, n, f"https://h/{n}" if n else "", c, "s", "{}", [0, i]) for i, (t, n, c) in enumerate(rows)], COLS)
        got = save_articles(store.load(), df.repartition(4), batch_id=number)
        want = []
        for i, (t, n, c) in enumerate(rows):
            new = not n or n not in held
            want.append("inserted" if new else "existing")
            if new:
                held[n or f"none-{number}-{i}"] = c
        assert [r.status for r in got.outcomes.orderBy("seq").collect()] == want
        store.append(got, number)
    assert sorted(r.content for r in store.load().contents.collect()) == sorted(held.values())
