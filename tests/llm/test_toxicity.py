import random

import numpy as np

from pagemill.llm import toxicity as tox

CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}


def corpus(seed, n):
    rng = random.Random(seed)
    plain = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    bad = ["grumpf", "snarl", "vileness", "vilest", "vilething"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(5, 80))]
        toxic, low = rng.random() < 0.15, rng.random() < 0.2
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        if low:
            words += ["lorem", "ipsum"]
        docs.append((i, " ".join(words)))
        labels.append((i, int(not low), int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, p string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_held_out_accuracy(spark):
    docs, labels = corpus(1, 900)
    d, l = frames(spark, docs, labels[:600] + [(None, 1, 1), (5, None, 1), (6, 1, None)])
    chain = tox.fit_chain(d, l, CATEGORIES)
    assert [k.category for k in chain.links] == ["low_quality", "toxic"] and len(chain.links[1].earlier) == 1
    got = {r["id"]: r for r in tox.scores(d, chain).collect()}
    truth = np.array([t for _, _, t in labels[600:]])
    said = np.array([got[i]["rejected"] for i in range(600, 900)])
    assert (said == truth).mean() > 0.98 and said[truth == 0].sum() <= 2
    low = np.array([got[i]["p_low_quality"] > 0.5 for i in range(600, 900)])
    assert (low == np.array([1 - q for _, q, _ in labels[600:]])).mean() > 0.95


def test_bounded_sample_is_stable(spark):
    docs, labels = corpus(2, 300)
    d, l = frames(spark, docs, labels)
    a = tox.fit_chain(d, l, CATEGORIES, max_labelled=120)
    b = tox.fit_chain(d.repartition(7), l.repartition(3), CATEGORIES, max_labelled=120)
    assert a == b


def test_edges(spark):
    docs, labels = corpus(3, 200)
    d, l = frames(spark, docs, labels)
    chain = tox.fit_chain(d, l, CATEGORIES)
    odd = spark.createDataFrame([(None, None, 1), (1, "", 1), (1, "", 1), (2, "grumpf snarl " * 50_000, 1)],
                                "doc_id long, text string, rejected int")
    assert tox.scores(odd, chain).count() == 4
    kept = tox.drop_toxic(odd, chain)
    assert kept.columns == odd.columns and sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "None"]
    one_class = tox.fit_chain(d, l.where("toxic = 0"), CATEGORIES)
    none = tox.fit_chain(d, l.limit(0), CATEGORIES)
    for c in (one_class, none):
        assert tox.drop_toxic(d, c).count() == 200
    assert tox.scores(d.limit(0), chain).count() == 0 and tox.drop_toxic(d.limit(0), chain).count() == 0


def test_products_match_sums_over_places():
    rng = np.random.default_rng(4)
    for n, k, share in [(200, 40, 0.3), (500, 300, 0.01), (3, 1, 0.0), (0, 5, 0.0)]:
        full = rng.random((n, k)) < share * 2 * rng.random(k)
        rows, cols = np.nonzero(full)
        for most in (0, 7, 512):
            held, w, r = tox.Incidence(rows, cols, n, k, most), rng.normal(size=k), rng.normal(size=n)
            assert np.allclose(held.dot(w), full @ w) and np.allclose(held.back(r), r @ full)


def test_whole_settings_of_the_classifier(spark):
    """Of 40 texts 5 hold a word, 2 of them among the 6 toxic ones: 13.9, above 12 and below 15."""
    steps = tox.fit_logistic.__defaults__[-1]
    assert (tox.MAX_TERMS, tox.MIN_CHI, steps) == (8_192, 12.0, 200)
    texts = [(i, f"w{'abcdefghij'[i % 10]}x{'abcdefghij'[i // 10]}" + (" grumpf" if i in (0, 1, 10, 11, 12) else "")) for i in range(40)]
    d, l = frames(spark, texts, [(i, 1, int(i < 6)) for i in range(40)])
    assert tox.fit_chain(d, l, CATEGORIES).links[1].weights.get("grumpf", 0) > 0


def test_equal_texts_with_different_labels_count_as_the_largest(spark):
    """The order of the rows decides nothing: a text labelled both ways is toxic."""
    docs, labels = corpus(3, 300)
    docs += [(1000 + i, docs[i][1]) for i in range(300)]
    labels += [(1000 + i, 1, 0) for i in range(300)]
    chains = []
    for order in (1, -1):
        d, l = frames(spark, docs[::order], labels[::order])
        chains.append(tox.fit_chain(d, l, CATEGORIES))
    texts = [t for _, t in docs[:40]]
    for t in texts:
        assert np.allclose(chains[0].probabilities(t), chains[1].probabilities(t), atol=1e-9)
    told = [chains[0].probabilities(t)[1] > 0.5 for t in texts]
    assert sum(a == bool(y[2]) for a, y in zip(told, labels)) >= 36
