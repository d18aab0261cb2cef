import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pagemill.llm import registry
from pagemill.llm.spelling import near_pairs, plan_passes, variants, vocabulary

WORDS = {"letter": 500, "leter": 40, "lettter": 60, "better": 100, "batter": 20, "bitter": 20, "bbitter": 4, "ketter": 3,
         "éclair": 30, "eclair": 5, "éclairs": 6, "aaaaaa": 9, "aaaaaaa": 50, "aaaaaaaa": 251, "alone": 1,
         "x" * 200: 8, "x" * 199: 1, "x" * 100 + "y" + "x" * 99: 2, "straße": 7, "strasse": 7}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=5):
    out = {}
    for w, n in counts.items():
        found = sorted((-m, v) for v, m in counts.items() if near(w, v))
        form = found[0][1] if found and -found[0][0] >= ratio * n else None
        out[w] = [form, n, len(found), counts[form] if form else None]
    for w in out:
        root = w
        while out[root][0]:
            root = out[root][0]
        out[w].insert(1, root)
    return {w: tuple(v) for w, v in out.items()}


def found(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_matches_brute_force_in_one_pass_and_in_many(spark):
    words = spark.createDataFrame(list(WORDS.items()), "word string, n long").repartition(3)
    want = brute(WORDS)
    assert found(variants(words)) == want
    assert want["bbitter"][0] == "bitter" and want["bitter"][:2] == ("better", "letter")  # a chain
    assert found(variants(words, most_bytes=8)) == want  # 8 bytes a pass: lengths and slices of lengths apart


def test_passes_hold_every_word_once_within_the_bound():
    counts = {6: 1000, 7: 50_000, 8: 3, 64: 10}
    passes = plan_passes(counts, 4096)
    assert all(sum(p.blocks for p in parts.values()) * 8 <= 4096 for parts in passes)
    for shard, n in counts.items():
        mine = [parts[shard] for parts in passes if shard in parts]
        assert sorted(p.index for p in mine) == list(range(mine[0].slices))
        assert sum(p.blocks for p in mine) * 64 >= 20 * n


def test_each_pair_is_given_once_in_each_direction(spark):
    words = spark.createDataFrame(list(WORDS.items()), "word string, n long")
    pairs = Counter((r["word"], r["near"], r["near_n"]) for r in near_pairs(words).collect())
    assert pairs == Counter((a, b, WORDS[b]) for a in WORDS for b in WORDS if near(a, b))


def brute_words(rows):
    import re
    counts = Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


@pytest.fixture(scope="module")
def docs():
    base = "Spelling ÉTUDES variants of lanterns, lantern; naïveté́ ABCDEF-ghijkl ŒUVRES straßen x×yzabc"
    return [(i, f"{base} {'lantern ' * (i % 4)}") for i in range(600)] + [(None, base), (7, None), (8, ""), (9, "Q" * 5000)] * 6


def test_vocabulary_of_the_query_matches_brute_force(spark, docs):
    df = spark.createDataFrame([(d, t, "taken", 1) for d, t in docs], "doc_id long, text string, word string, n int")
    got = {r["word"]: r["n"] for r in vocabulary(df.repartition(4), rewrite=registry._typo).collect()}
    want = brute_words(docs)
    assert got == want and len(want) > 8 and "q" * 5000 in want


def test_query_matches_brute_force(spark, docs, tmp_path):
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.QUERIES["op11_spelling_variants"](spark, str(tmp_path))
    assert set(got.columns) == {"word", "form", "root", "n", "n_near", "form_n"}
    assert found(got) == brute(brute_words(docs))


def test_no_words(spark):
    empty = spark.createDataFrame([(1, None), (2, "a b c")], "doc_id long, text string")
    assert variants(vocabulary(empty)).count() == 0
    assert variants(spark.createDataFrame([], "word string, n long").where(F.lit(True))).count() == 0
