"""Log-structured runs, the filter of requested urls and the clustered page snapshot."""

import re

import pytest
from pyspark.sql import functions as F

from pagemill.operators import snapshot as S
from pagemill.operators.fetch import fetch, page_snapshot
from pagemill.operators.requests import seeds_from_urls
from pagemill.operators.seen import SeenUrls
from pagemill.operators.snapshot import ClusteredSnapshot
from pagemill.plans.workflow import REQUEST_COLS
from pagemill.sources.files import names, publish_text, read_text
from pagemill.sources.runs import BucketedRuns
from pagemill.streaming.pipeline import scratch_dir

AS_OF = "2024-01-01T00:00:00"


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def keys(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "key string")


def test_publish_is_exclusive(spark):
    path = f"{scratch_dir(spark, 'publish')}/a.json"
    assert publish_text(spark, path, "one") and not publish_text(spark, path, "two")
    assert read_text(spark, path) == "one" and names(spark, path.rsplit("/", 1)[0]) == ["a.json"]


def test_runs_append_replay_and_fold(spark):
    table = BucketedRuns(spark, scratch_dir(spark, "runs"), "key string", "key", buckets=4, fanout=3)
    assert table.read().count() == 0 and table.next_id() == 0
    for k in range(3):
        assert table.append(keys(spark, f"a{k}", "same"), k).rows == 2
    assert table.append(keys(spark, "again"), 1) is None
    with pytest.raises(ValueError):
        BucketedRuns.append(table, keys(spark, "x"), -1)
    made = table.fold()
    assert [r.name for r in made] == ["r0-2"] and made[0].rows == 4  # 'same' once
    assert table.append(keys(spark, "again"), 1) is None  # folded away, and still known
    assert {r["key"] for r in table.read().collect()} == {"a0", "a1", "a2", "same"}
    assert len(names(spark, f"{table.root}/data")) == 4  # replaced runs stay for readers until the next fold
    table.fold()
    assert names(spark, f"{table.root}/data") == ["run=r0-2"]
    again = BucketedRuns(spark, table.root, "key string", "key", buckets=4, fanout=3)
    assert again.read().count() == 4


def test_a_large_run_is_not_rewritten_for_small_ones(spark):
    table = BucketedRuns(spark, scratch_dir(spark, "tiers"), "key string", "key", buckets=2, fanout=3)
    table.append(spark.range(100).selectExpr("cast(id AS string) AS key"), 0)
    for k in range(1, 30):
        table.append(keys(spark, f"n{k}"), k)
        table.fold()
    runs = table.runs()
    assert runs[0].name == "r0-0" and runs[0].rows == 100 and len(runs) <= 3 + 5
    assert sum(r.rows for r in runs) == 129 and table.read().count() == 129


def test_a_dead_writer_leaves_nothing_visible(spark):
    table = BucketedRuns(spark, scratch_dir(spark, "dead"), "key string", "key", buckets=2)
    table.append(keys(spark, "a"), 0)
    table._write(keys(spark, "lost"), 1, 1)  # and then the job dies
    assert [r["key"] for r in table.read().collect()] == ["a"]
    table.append(keys(spark, "b"), 1)
    assert sorted(r["key"] for r in table.read().collect()) == ["a", "b"]


# --- requested urls -------------------------------------------------------------
def requests(spark, urls, start=0, free=False):
    df = spark.createDataFrame([(u, i + start) for i, u in enumerate(urls)], "url string, n long")
    return seeds_from_urls(df, "url", "n").select(*REQUEST_COLS).withColumn("dont_filter", F.lit(free))


def test_admit_first_wins_and_repeats(spark):
    seen = SeenUrls(spark, scratch_dir(spark, "seen"), buckets=4)
    first = seen.admit(requests(spark, ["a", "b", "a", None, ""]), 0)
    assert sorted((r.url, r.seq[1]) for r in first.collect()) == [("a", 0), ("b", 1)]
    again = requests(spark, ["b", "c"], 10)
    for _ in range(2):  # a round that is repeated admits the same
        assert [r.url for r in seen.admit(again, 1).collect()] == ["c"]
    assert [r.url for r in seen.admit(requests(spark, ["a"], 20, free=True), 2).collect()] == ["a"]
    assert seen.contains(["a", "c", "zzz"]) == {"a", "c"}
    assert sorted(r.rows for r in seen.runs()) == [0, 1, 2]


def test_bytes_written_follow_the_new_keys(spark):
    seen = SeenUrls(spark, scratch_dir(spark, "bytes"), buckets=2)
    many = spark.range(200_000).selectExpr("concat('https://h/', id) AS url", "id")
    seen.admit(seeds_from_urls(many, "url", "id").select(*REQUEST_COLS), 0)
    seen.admit(requests(spark, ["https://h/5", "https://new/1"]), 1)
    big, small = seen.runs()
    assert (big.rows, small.rows) == (200_000, 1)
    assert small.bytes < 4000 < 1_000_000 < big.bytes  # one key costs its file's frame, not the set


def test_stored_keys_are_not_moved(spark, no_broadcast):
    seen = SeenUrls(spark, scratch_dir(spark, "seenplan"), buckets=4)
    seen.admit(requests(spark, ["a", "b"]), 0)
    fresh = seen.placed(spark.createDataFrame([("x",)], "k string"), "k")
    plan = fresh.join(seen.read(), fresh["k"] == F.col("key"), "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and plan.count("Exchange") == 1


# --- the clustered snapshot -------------------------------------------------------
def pages(spark, n, tag="p", start=0):
    return spark.range(start, start + n).selectExpr("id AS page_id", "concat('https://h/', id) AS url", f"concat('{tag}', id) AS html")


def outcome(df):
    return sorted((r.url, tuple(r.seq), r.status, r.http_status, r.body, r.error) for r in df.collect())


def test_clustered_fetch_equals_the_plain_one(spark):
    stored = pages(spark, 50).unionByName(pages(spark, 5, "newer").withColumn("page_id", F.col("page_id") + 100))
    odd = spark.createDataFrame([(None, "https://h/1", "no version"), (7, None, "no url")], "page_id long, url string, html string")
    stored = stored.unionByName(odd)
    stored = stored.withColumn("status", F.when(F.col("page_id") == 9, 404).otherwise(200))
    snapshot = ClusteredSnapshot(spark, scratch_dir(spark, "snap"), buckets=4)
    snapshot.merge(stored, 0)
    asked = requests(spark, [f"https://h/{i}" for i in range(0, 70, 3)] * 2 + ["https://h/9"])
    plain = fetch(asked, page_snapshot(stored.where("url IS NOT NULL")), as_of=AS_OF)
    assert outcome(fetch(asked, snapshot, as_of=AS_OF)) == outcome(plain)


def test_later_rounds_answer_and_a_fold_keeps_them(spark):
    snapshot = ClusteredSnapshot(spark, scratch_dir(spark, "rounds"), buckets=4, fanout=3)
    snapshot.merge(pages(spark, 10), 0)
    snapshot.merge(pages(spark, 3, "new", 2), 1)
    snapshot.merge(pages(spark, 1, "last", 3), 2)
    assert snapshot.merge(pages(spark, 1, "replay", 3), 2) is None
    asked = requests(spark, [f"https://h/{i}" for i in range(6)])
    want = {"https://h/0": "p0", "https://h/1": "p1", "https://h/2": "new2", "https://h/3": "last3", "https://h/4": "new4",
            "https://h/5": "p5"}
    for _ in range(2):
        assert {r.url: r.body for r in fetch(asked, snapshot, as_of=AS_OF).collect()} == want
        snapshot.merge(pages(spark, 10, "p", 100), snapshot.next_id())
        snapshot.fold()
    folded = snapshot.runs()[0]
    assert folded.name == "r0-3" and folded.rows == 20  # one page a url
    assert snapshot.read([folded]).select("url").distinct().count() == 20


def test_no_exchange_above_the_pages(spark, no_broadcast):
    snapshot = ClusteredSnapshot(spark, scratch_dir(spark, "plan"), buckets=4)
    snapshot.merge(pages(spark, 100), 0)
    snapshot.merge(pages(spark, 10, "new"), 1)
    got = fetch(requests(spark, ["https://h/1", "https://h/x"]), snapshot, as_of=AS_OF, charset=False)
    plan = got._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert len(scans) == 2 and all("Bucketed: true" in line for line in scans)
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1  # the frontier
    narrow = [line for line in scans if "html" not in line.split("ReadSchema")[1]]
    assert len(narrow) == 1  # the newest version of a url is found without its body
    assert sorted((r.url, r.status) for r in got.collect()) == [("https://h/1", 200), ("https://h/x", 0)]


def test_a_url_that_most_requests_ask_for_is_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(S, "MANY", 20)
    snapshot = ClusteredSnapshot(spark, scratch_dir(spark, "crowd"), buckets=4)
    snapshot.merge(pages(spark, 30), 0)
    urls = ["https://h/1"] * 500 + ["https://gone/"] * 400 + [f"https://h/{i}" for i in range(40)]
    asked = requests(spark, urls)
    assert sorted(snapshot._crowded(asked)) == ["https://gone/", "https://h/1"]
    plain = fetch(asked, page_snapshot(pages(spark, 30)), as_of=AS_OF)
    assert outcome(fetch(asked, snapshot, as_of=AS_OF)) == outcome(plain)


def test_raw_bytes_are_decoded(spark):
    snapshot = ClusteredSnapshot(spark, scratch_dir(spark, "raw"), buckets=2, with_content=True)
    raw = spark.createDataFrame([(1, "https://h/1", bytearray("né".encode("latin-1")), {"Content-Type": "text/html; charset=latin-1"})],
                                "page_id long, url string, content binary, headers map<string,string>")
    snapshot.merge(raw, 0)
    got = fetch(requests(spark, ["https://h/1"]), snapshot, as_of=AS_OF).first()
    assert got.body == "né" and got.encoding_source == "Content-Type header"


def test_an_empty_snapshot_answers_nothing(spark):
    snapshot = ClusteredSnapshot(spark, scratch_dir(spark, "none"), buckets=2)
    assert [r.status for r in fetch(requests(spark, ["https://h/1"]), snapshot, as_of=AS_OF).collect()] == [0]
