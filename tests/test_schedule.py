"""Slots of hosts, retries in rounds, delivery after a crash, shared queues."""

import time

import pytest
from pagemill.operators.requests import seeds_from_urls
from pagemill.operators.schedule import due_slots, fetch_scheduled, places
from pagemill.plans.workflow import REQUEST_COLS
from pagemill.streaming.consumers import QueueGroup
from pagemill.streaming.ledger import AT_MOST_ONCE, EXACTLY_ONCE, Ledger
from pagemill.streaming.pipeline import scratch_dir


def asked(spark, urls):
    df = spark.createDataFrame([(u, i) for i, u in enumerate(urls)], "url string, n long")
    return seeds_from_urls(df, "url", "n").select(*REQUEST_COLS)


def test_places_match_brute_force_and_deal_a_large_key(spark):
    rows = [("hot" if i % 3 else f"h{i % 7}", (i * 37) % 1000) for i in range(1000)] + [(None, 5), (None, 1), ("", 3)]
    df = spark.createDataFrame(rows, "key string, n long").repartition(5)
    got = places(df, "key", "n").collect()
    by = {}
    for k, n in rows:
        by.setdefault(k, []).append(n)
    assert sorted((r.key or "", r.key is None, r.place, r.n) for r in got) == sorted(
        (k or "", k is None, i, n) for k, ns in by.items() for i, n in enumerate(sorted(ns)))


def test_slots(spark):
    urls = [f"https://{'big' if i % 4 else 'small'}.test/{i}" for i in range(40)] + ["no host"]
    got = {r.url: (r.host, r.slot, r.due) for r in due_slots(asked(spark, urls), interval_s=2, parallel=3).collect()}
    big = [u for u in urls if "big" in u]
    assert [got[u][1] for u in big] == list(range(30)) and got[big[7]] == ("big.test", 7, 4.0)
    assert got["no host"] == ("", 0, 0.0)


def make_client():
    def client(url, method, headers, params, data, json, attempt):
        kind = url.rsplit("/", 1)[1]
        if kind == "broken":
            raise ValueError("not a page")
        if kind.startswith("late") and attempt < int(kind[4:]):
            raise TimeoutError("slow")
        return (404 if kind == "gone" else 200), {"n": attempt}, url.encode()

    return client  # a function within one goes to the workers by value


def test_retries_are_later_slots_with_the_next_attempt(spark):
    urls = [f"https://h/{k}" for k in ("ok", "late2", "late3", "late4", "gone", "broken")] + ["https://i/late2", ""]
    calls = fetch_scheduled(asked(spark, urls), make_client(), interval_s=1, clock=False).collect()
    by = {}
    for r in sorted(calls, key=lambda r: r.attempt):
        by.setdefault(r.url, []).append(r)
    assert {u: [(c.attempt, c.slot, c.final) for c in cs] for u, cs in by.items()} == {
        "https://h/ok": [(1, 0, True)], "https://h/late2": [(1, 1, False), (2, 6, True)],
        "https://h/late3": [(1, 2, False), (2, 7, False), (3, 9, True)],
        "https://h/late4": [(1, 3, False), (2, 8, False), (3, 10, True)],
        "https://h/gone": [(1, 4, True)], "https://h/broken": [(1, 5, True)], "https://i/late2": [(1, 0, False), (2, 1, True)]}
    last = {u: cs[-1] for u, cs in by.items()}
    assert last["https://h/late2"].status == 200 and last["https://h/late2"].error is None
    assert last["https://h/late4"].error == "request failed: slow" and last["https://h/late4"].status == 0
    assert (last["https://h/gone"].status, last["https://h/gone"].http_status, bytes(last["https://h/gone"].content)) == (0, 404, b"")
    assert last["https://h/broken"].error == "unexpected error: not a page"


def test_the_driver_waits_for_the_waves(spark):
    started = time.monotonic()
    calls = fetch_scheduled(asked(spark, [f"https://h/{i}" for i in range(5)]), make_client(), interval_s=1, window_s=2).collect()
    assert len(calls) == 5 and time.monotonic() - started >= 4  # slots 4 and later open with the third window
    assert fetch_scheduled(asked(spark, []), make_client()).count() == 0


def test_ledger(spark):
    root = scratch_dir(spark, "ledger")
    done = []

    def die():
        done.append("half")
        raise RuntimeError

    for delivery, again in ((EXACTLY_ONCE, True), (AT_MOST_ONCE, False)):
        ledger = Ledger(spark, f"{root}/{delivery}", delivery)
        assert ledger.run(0, lambda: done.append(0)) and not ledger.run(0, lambda: done.append("twice"))
        with pytest.raises(RuntimeError):
            ledger.run(1, die)
        assert ledger.run(1, lambda: done.append(1)) is again
        assert ledger.finished() == (["0", "1"] if again else ["0"])
    assert done == [0, "half", 1, 0, "half"]
    with pytest.raises(ValueError):
        Ledger(spark, root, "sometimes")


# --- queues -----------------------------------------------------------------------
def messages(spark, rows):
    return spark.createDataFrame([(q, f"m{n}", str(n), [n]) for q, n in rows], "queue string, value string, key string, seq array<bigint>")


def values(batch):
    return [r.value for r in batch.orderBy("place").collect()]


def test_one_member_takes_queues_in_order(spark):
    group = QueueGroup(spark, scratch_dir(spark, "q"), ["high", "low"], shards=4)
    group.lease("a", 1)
    assert group.take("a", 3) is None
    group.put(messages(spark, [("low", 1), ("high", 2), ("low", 3), ("low", 4)]))
    assert values(group.take("a", 3)) == ["m2", "m1", "m3"]
    group.put(messages(spark, [("high", 9), ("low", 0)]))  # arrives later: before the rest of the low queue, and after it
    assert values(group.take("a", 10)) == ["m9", "m4", "m0"]
    assert group.take("a", 3) is None
    with pytest.raises(ValueError):
        group.put(messages(spark, [("unknown", 1)]))


def test_members_share_and_survive_a_restart(spark):
    root = scratch_dir(spark, "q2")
    group = QueueGroup(spark, root, ["only"], shards=4)
    assert sorted(group.lease("a", 2) + group.lease("b", 2)) == [0, 1, 2, 3]
    assert group.lease("a", 2) == QueueGroup(spark, root, ["only"], shards=4).lease("a", 2) and group.lease("c", 2) == []
    group.put(messages(spark, [("only", n) for n in range(200)]))
    got = []
    for member in ("a", "b", "a", "b", "a", "b", "c"):
        group = QueueGroup(spark, root, ["only"], shards=4)  # as after a restart
        batch = group.take(member, 60)
        got += values(batch) if batch is not None else []
    assert sorted(got) == sorted(f"m{n}" for n in range(200))
    shards = {r.value: r.shard for r in spark.read.parquet(f"{root}/messages").collect()}
    assert len(set(shards.values())) == 4
