import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from pagemill.llm import resampling
from pagemill.llm.resampling import Head, _slices, resample


def words_of(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text):
    w = words_of(text)
    return Counter(zlib.crc32(" ".join(w[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(w) - n + 1))


def brute(docs, target):
    each = [features(t) for _, t in docs]
    s, t = sum(each, Counter()), sum((features(x) for x in target), Counter())
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000)))) for b in range(10000)}
    out = []
    for (doc, text), f in zip(docs, each):
        h = int(hashlib.sha256(f"42:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        weight = sum(n * gain[b] for b, n in f.items())
        out.append([doc, sum(f.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((-r[3], r[0] is not None, r[0] or 0, i) for i, (r, (_, x)) in enumerate(zip(out, docs)) if len(words_of(x)) >= 20)
    rank = {i: k + 1 for k, (*_, i) in enumerate(fit) if k < 5 * len(fit) // 100}
    return sorted((tuple(r) + (rank.get(i),) for i, r in enumerate(out)), key=str)


VOCAB = [f"w{i}" for i in range(50)] + ["Été", "naïve", "日本", "x" * 60, "ÀB"]
RNG = np.random.default_rng(7)
DOCS = [(i, " ".join(RNG.choice(VOCAB, RNG.integers(1, 60)))) for i in range(300)] + [
    (1000, None), (1001, ""), (1002, ".,;"), (1003, "once"), (None, "w1 " * 30), (1005, "tail" + "é" * 40 + " w1-w2 w3 W4"),
    (1006, " ".join(f"rare{i}" for i in range(50)))]
TARGET = [" ".join(RNG.choice(VOCAB[:12], 40)) for _ in range(10)] + [None, ""]


def run(spark, docs, target, **more):
    d = spark.createDataFrame([(i, t, "w", 5) for i, t in docs], "doc_id long, text string, weight string, __at int")
    t = spark.createDataFrame([(x,) for x in target], "text string")
    return sorted(((r["id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in resample(d.repartition(3), t, **more)
                   .collect()), key=str)


def test_matches_brute_force(spark):
    want = brute(DOCS, TARGET)
    assert run(spark, DOCS, TARGET) == want
    assert sum(r[4] is not None for r in want) >= 5


@pytest.mark.parametrize("change", [{"HEAD": 6, "PAIR_SLOTS": 4, "SUMMARY": 8}, {"HEAD": 0}, {"HEAD_BYTES": 2}, {"PIECE": 64}])
def test_head_and_pieces_change_no_result(change, monkeypatch):
    for name, value in change.items():
        monkeypatch.setattr(resampling, name, value)
    texts = [(t or "").encode() for _, t in DOCS] + [b"a" * 500 + b" " + b"b" * 70 + b" c" * 40]
    head = Head([w.lower().encode() for w in VOCAB[:resampling.HEAD]], [(b"w1", b"w2"), (b"w2", b"w3"), (b"w1", b"w1")])

    class Batch:
        def column(self, _):
            class One:
                def __init__(self, x):
                    self.x = x

                def as_py(self):
                    return self.x
            return [One(x) for x in texts]

    got = [Counter() for _ in texts]
    for _, _, segments in _slices([Batch()], 0):
        for rows, buckets in head.buckets(segments):
            for r, b in zip(rows.tolist(), buckets.tolist()):
                got[r][b] += 1
    assert got == [features(t.decode()) for t in texts]


def test_summaries_miss_no_frequent_word(monkeypatch):
    monkeypatch.setattr(resampling, "SUMMARY", 10)
    counts = Counter()
    for i in range(1000):
        counts.update(["hot", f"once{i}"])
        counts = resampling._trim(counts)
    assert "hot" in counts and len(counts) <= 11


def test_ties_fall_to_the_smaller_id_and_ranks_are_gapless(spark):
    docs = [(i % 40, "w1 " * 30) for i in range(400)]  # ten equal rows an id
    got = run(spark, docs, ["w1"])
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 21))
    by_score = {r[0]: r[3] for r in got}
    first = sorted(by_score, key=lambda i: (-by_score[i], i))[:2]
    assert {r[0] for r in got if r[4]} == set(first)


def test_empty_inputs(spark):
    assert run(spark, [], ["w1"]) == []
    docs = [(i, "w1 w2 " * 15) for i in range(30)]
    assert run(spark, docs, []) == brute(docs, [])
