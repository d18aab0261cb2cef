import zlib

import numpy as np
import pytest

from pagemill.llm import language_filters as L
from pagemill.llm import registry

EN = ["the cat sat on the mat and the dog was there with them", "this is what they thought of that thing"]
DE = ["der hund und die katze sind nicht auf der straße", "ich weiß nicht was das für ein ding ist"]
RU = ["это кошка и собака на улице", "что они думали об этом"]


def rows():
    out = [(i, (EN[i % 2] + f" {i}") if i % 3 == 0 else DE[i % 2] if i % 3 == 1 else RU[i % 2], ("en", "de", "ru")[i % 3])
           for i in range(60)]
    return out + [(100, None, "en"), (101, "", "de"), (102, "12 34 !!", "ru"), (103, "the cat", None), (None, "die katze", None),
                  (104, "the dog", "de")]  # a wrong label


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, g, 1.0) for i, t, g in rows()], "doc_id long, text string, lang string, score double")


def test_languages_and_cases(spark, docs):
    got = {r["id"]: r for r in L.predict(docs.repartition(3), L.fit(docs)).collect()}
    for i, text, lang in rows()[:60]:
        assert got[i]["lang_pred"] == lang and 0 <= got[i]["score"] <= 1
    assert [got[i]["lang_pred"] for i in (100, 101, 102, 103, None, 104)] == ["und", "und", "und", "en", "de", "en"]
    assert got[100]["score"] == 0


def grams(text):
    """The windows of one text, by definition."""
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return sorted(f" {w} "[i:i + n] for w in words for n in L.SIZES for i in range(len(w) + 3 - n))


def by_hash(g):
    codes = np.array([ord(c) for c in g], np.uint64)
    h = np.full(1, len(g), np.uint64)
    for c in codes:
        h = h * np.uint64(0x9E3779B97F4A7C15) + c
    return int(L._mixed(h)[0])


@pytest.mark.parametrize("at_once", [1 << 18, 7])
def test_windows_match_their_definition(at_once, monkeypatch):
    monkeypatch.setattr(L, "AT_ONCE", at_once)
    texts = ["Ab, c!", "", "--", "İx ß", "a\0b", "longer words here", "日本語"]
    found = [[] for _ in texts]
    for hashes, owner in L._grams(*L._cleaned(texts)):
        for h, o in zip(hashes.tolist(), owner.tolist()):
            found[o].append(h)
    for text, f in zip(texts, found):
        assert sorted(f) == sorted(by_hash(g) for g in grams(text))


def test_filter_returns_all_languages_of_a_gram(spark, docs):
    filters = L.fit(docs)
    shares = {}
    for _, text, lang in rows():
        if text and lang:
            for g in grams(text):
                shares.setdefault(g, {}).setdefault(lang, 0)
                shares[g][lang] += 1
    totals = {lang: sum(s.get(lang, 0) for s in shares.values()) for lang in filters.languages}
    masks = filters.contained(np.array([by_hash(g) for g in shares], np.uint64))[:, 0]
    extra = 0
    for (g, counts), mask in zip(shares.items(), masks.tolist()):
        rate = {lang: n / totals[lang] for lang, n in counts.items()}
        held = {lang for lang, r in rate.items() if r >= L.SHARE * max(rate.values())}
        found = {lang for i, lang in enumerate(filters.languages) if mask >> i & 1}
        assert held <= found
        extra += len(found - held)
    assert extra <= 0.2 * 3 * len(shares) and (filters.false < 0.2).all()


def test_a_full_filter_is_corrected_for(spark, docs, monkeypatch):
    monkeypatch.setattr(L, "FILTER_BYTES", 1 << 13)  # 1,024 positions, the least
    filters = L.fit(docs)
    assert len(filters.positions) == 1024 and filters.false.max() > 0
    got = {r["id"]: r["lang_pred"] for r in L.predict(docs, filters).collect()}
    assert all(got[i] == lang for i, _, lang in rows()[:60])


def test_more_languages_than_one_mask_holds(spark):
    letters = [chr(0x4E00 + 7 * i) for i in range(70)]
    table = [(i, f"{c}{c}x {c}", f"l{i:02d}") for i, c in enumerate(letters)]
    df = spark.createDataFrame(table, "doc_id long, text string, lang string")
    filters = L.fit(df)
    assert filters.positions.shape[1] == 2
    assert {r["id"]: r["lang_pred"] for r in L.predict(df, filters).collect()} == {i: g for i, _, g in table}


def test_no_training_rows(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert L.predict(df, L.fit(df)).first()["lang_pred"] == "und"
    assert L.predict(df.limit(0), L.fit(df.limit(0))).count() == 0


def test_query_holds_documents_out_and_predicts_them(spark):
    sf = "/root/testdata/sf0.01"
    known = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text").collect()}
    got = registry.QUERIES["op12_language_filters"](spark, sf).collect()
    assert len(got) == len(known)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r["held_out"]]
    right = sum(r["lang_pred"] == known[r["doc_id"]]["lang"] for r in held)
    assert len(held) > 200 and right >= 0.98 * len(held)
