import numpy as np
from pyspark.sql import functions as F

from pagemill.llm import ann


def exact(ids, vectors, q, k):
    s = ann.cosine(np.broadcast_to(vectors[q], vectors.shape), vectors)
    order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]]
    return [(int(ids[i]), s[i]) for i in order[:k]]


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((4000, 32)).astype(np.float32).astype(float)
    ids = np.arange(4000)
    df = spark.createDataFrame([(int(i), v.tolist(), 1.0) for i, v in zip(ids, vectors)],
                               "vec_id long, embedding array<float>, score double").repartition(5)
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    assert set(got) == set(range(0, 4000, 50))
    hits = 0
    for q, rows in got.items():
        rows.sort()
        assert [r for r, _, _ in rows] == [1, 2, 3, 4, 5]
        assert all(a[2] > b[2] or a[2] == b[2] and a[1] < b[1] for a, b in zip(rows, rows[1:]))
        want = exact(ids, vectors, q, 5)
        hits += len({i for _, i, _ in rows} & {i for i, _ in want})
        for _, i, s in rows:
            assert s == ann.cosine(vectors[[q]], vectors[[i]])[0]
    assert hits / (5 * len(got)) >= 0.9


def test_ties_copies_and_unusable_rows(spark):
    inf, nan = float("inf"), float("nan")
    same = [(i, [1.0, 2.0, 3.0]) for i in range(10, 200)]
    odd = [(300, None), (301, [0.0, 0.0, 0.0]), (302, [1.0, None, 2.0]), (303, [inf, 1.0, 1.0]), (304, [nan, 1.0, 1.0]), (305, []),
           (None, [1.0, 2.0, 3.0]), (306, [1.0, 1.0]), (10, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(same + odd, "vec_id long, embedding array<float>")
    rows = ann.nearest(df, F.col("vec_id").isin(50, 300, 301, 306)).collect()
    assert [(r["query_id"], r["rank"], r["id"]) for r in sorted(rows, key=lambda r: r["rank"])] == [
        (50, k + 1, i) for k, i in enumerate([10, 11, 12, 13, 14])]
    assert len({r["score"] for r in rows}) == 1


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [-1.0, 0.0])], "vec_id long, embedding array<double>")
    rows = ann.nearest(df, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r["id"] for r in rows] == [1, 2] and rows[1]["score"] == -1.0
    assert ann.nearest(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert ann.nearest(df, F.lit(False)).count() == 0
