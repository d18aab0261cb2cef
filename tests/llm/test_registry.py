"""The registered queries on the driver's small tables: contract columns, and brute force where there is no SQL."""

import base64
import hashlib
import os

import numpy as np
import pytest
from test_pii import brute as brute_spans

from pagemill.llm.registry import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_op1(spark, texts):
    got = QUERIES["op1_pii"](spark, SF).collect()
    assert {"doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"} <= set(got[0].asDict())
    assert len(got) == len(texts)
    for r in got:
        want = brute_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest()
        assert set(want.split(",")) - {""} <= set(r["spans"].split(","))


def test_op3(spark, texts):
    got = QUERIES["op3_best_fit_packing"](spark, SF).collect()
    assert set(got[0].asDict()) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    total = sum(r["length"] for r in got)
    slots = {}
    for r in got:
        slots.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in slots.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(slots) <= -(-total // 2048) + 1 and {r["doc_id"] for r in got} == set(texts)


def test_op4(spark, texts):
    got = QUERIES["op4_toxicity"](spark, SF).collect()
    assert {r["doc_id"] for r in got} == set(texts) and {"p_low_quality", "p_toxic", "toxic"} <= set(got[0].asDict())


def test_op5(spark, texts):
    P = pytest.importorskip("public_tokenizers")
    tiktoken = pytest.importorskip("tiktoken")
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in QUERIES["op5_byte_bpe"](spark, SF).collect():
        ids = enc.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_op7(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    unit = np.array([r["embedding"] for r in rows], float)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    got = {}
    for r in QUERIES["op7_hash_prefix_forest"](spark, SF).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = r["vec_id"]
    hits = 0
    for q in np.flatnonzero(ids % 50 == 0):
        near = unit @ unit[q]
        near[q] = -2
        hits += len(set(ids[np.argsort(-near)[:5]]) & set(got[ids[q]].values()))
        assert sorted(got[ids[q]]) == [1, 2, 3, 4, 5]
    assert hits >= 0.9 * 5 * len(got)


def test_op10(spark):
    got = QUERIES["op10_main_text"](spark, SF).collect()
    assert set(got[0].asDict()) == {"page_id", "url", "text", "n_chars"}
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(got) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in got)
    for r in got:  # nothing of the menu, the advert or the footer, which has the only copyright sign
        assert "©" not in r["text"] and r["text"].count("\n") + 1 >= 1 and r["text"]
