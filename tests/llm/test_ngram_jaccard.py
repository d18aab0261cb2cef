import random
import re
from itertools import combinations

import numpy as np
import pytest

from pagemill.llm import ngram_jaccard as nj

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        a, b = sets[i], sets[j]
        both = len(a & b)
        if a and b and 100 * both >= 80 * (len(a) + len(b) - both):
            parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def family(rng, n, copies, start):
    words = [f"w{rng.randrange(5000)}" for _ in range(n)]
    out = []
    for k in range(copies):
        own = list(words)
        for _ in range(rng.randrange(0, max(1, n // 12))):
            own[rng.randrange(n)] = f"x{rng.randrange(10 ** 6)}"
        out.append((start + k, " ".join(own)))
    return out


def rows_of(seed):
    rng = random.Random(seed)
    rows = [(1, None), (2, ""), (3, " \t "), (4, "one two"), (5, "ONE Two"), (6, "one two three"), (None, "null id here ok yes no"),
            (8, "null id here ok yes no"), (9, "same same same same same same"), (9, "same same same same same same"),
            (10, "ÀB c d e f g"), (11, "àb c d e f g")]
    for f in range(6):
        rows += family(rng, rng.choice([6, 12, 40, 150, 600]), rng.choice([2, 5, 40]), 1000 * (f + 1))
    common = " ".join(f"p{i}" for i in range(30))
    rows += [(90_000 + i, " ".join(f"u{i}x{j}" for j in range(25)) + " " + common) for i in range(60)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed, monkeypatch):
    rows = rows_of(seed)
    if seed == 2:  # small leaves and chunks, so that trees and chunked blocks are used
        monkeypatch.setattr(nj, "LEAF", 4)
        monkeypatch.setattr(nj, "BLOCK", 16)
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, sid int, component string")
    got = nj.near_duplicates(df.repartition(4)).select("id", "n_shingles", "component_id").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(rows)))


def test_bound_is_an_upper_bound():
    rng = random.Random(3)
    for _ in range(50):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(5, 400))]
        other = words[rng.randrange(0, 20):] + [f"y{rng.randrange(99)}" for _ in range(rng.randrange(30))]
        texts = [" ".join(words), " ".join(other)]
        d, h = nj.shingle_sets(texts)
        points = []
        for i in (0, 1):
            own = h[d == i]
            g = nj._resolution(np.array([len(own)]))[0]
            points.append(np.bincount((own >> np.uint64(64 - g)).astype(np.int64), minlength=1 << g).astype(np.uint8).tobytes())
        assert nj.overlap_bound(*points) >= len(np.intersect1d(h[d == 0], h[d == 1]))


def test_tree_finds_every_pair_that_may_link():
    rng = np.random.default_rng(5)
    n = np.sort(rng.integers(20, 200, 150))
    points = [rng.multinomial(k, np.ones(64) / 64).astype(np.uint8).tobytes() for k in n]
    points[10] = b""
    found = {(int(i), int(j)) for a, b in nj._Tree(n, points).pairs(80) for i, j in zip(a, b)}
    want = {(i, j) for i in range(150) for j in range(i + 1, 150)
            if nj._may_link(n[i], n[j], nj.overlap_bound(points[i], points[j]), 80)}
    sized = {(i, j) for i, j in want if 80 * n[j] <= 100 * n[i]}
    assert sized <= found


def test_drop_keeps_one_of_each_group(spark):
    rows = rows_of(4)
    df = spark.createDataFrame([(d, t, "c") for d, t in rows], "doc_id long, text string, __hash string")
    out = nj.drop_near_duplicates(df)
    assert out.columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in out.collect()]
    want = brute(rows)
    groups = {w[2] for w in want if w[1]}
    assert len(kept) == len(groups) + sum(1 for w in want if not w[1])
    assert {d for d, t in kept if shingles(t)} == groups


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert nj.near_duplicates(df).count() == 0 and nj.drop_near_duplicates(df).count() == 0
